"""Expressions over nested / JSON-encoded values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orelake.functions.text import py_strip


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nested_to_list(col) -> Column:
    """JSON text -> ``array<string>`` holding each element's raw JSON.

    A JSON list gives its elements, a JSON object gives a one-element list,
    anything else (NULL, blank, broken or scalar text) gives an empty list.
    The whole text must be one strict JSON value: it is parsed as the first
    element of a list whose second, empty element must come out unharmed, so
    single quotes, text after the value or several values are rejected.  Each
    text is stripped and parsed once.
    """
    strict = {"allowSingleQuotes": "false"}

    def lists(t: Column) -> Column:
        parsed = F.from_json(F.concat(F.lit("["), t, F.lit(",[]]")), "array<array<string>>", strict)
        return _bound(parsed, lambda x: F.when((F.size(x) == 2) & (F.size(F.get(x, F.lit(1))) == 0), F.get(x, F.lit(0))))

    def objects(t: Column) -> Column:
        parsed = F.from_json(F.concat(F.lit("["), t, F.lit(",{}]")), "array<string>", strict)
        return _bound(parsed, lambda x: F.when((F.size(x) == 2) & (F.get(x, F.lit(1)) == "{}"), F.array(t)))

    found = _bound(py_strip(_c(col)), lambda t: F.when(t.startswith("["), lists(t)).when(t.startswith("{"), objects(t)))
    return F.coalesce(found, F.array().cast("array<string>"))


def unify_extended(col, wrapper: str) -> Column:
    """Plain value or its extended-JSON wrapper (``{"$oid": ..}``, ``{"$date": ..}``) -> text."""
    c = _c(col)
    # only text that can be a JSON object is parsed; plain values pass through untouched
    maybe_object = F.ltrim(c).startswith("{")
    return F.coalesce(F.when(maybe_object, F.get_json_object(c, f"$['{wrapper}']")), c)
