"""Column expressions (JVM-side, code-generated; no Python UDFs)."""

from orelake.functions.text import (
    capitalize_first,
    digits_only,
    py_strip,
    title_case,
    truthy,
)
from orelake.functions.nested import nested_to_list, unify_extended
from orelake.functions.keys import (
    city_normalized,
    city_part,
    date_key,
    event_key,
    region_key,
    region_part,
    surrogate_key,
)
from orelake.functions.timefmt import iso_z, parse_ts, percent_text

__all__ = [
    "capitalize_first", "city_normalized", "city_part", "date_key",
    "digits_only", "event_key", "iso_z", "nested_to_list", "parse_ts", "percent_text",
    "py_strip", "region_key", "region_part", "surrogate_key", "title_case", "truthy",
    "unify_extended",
]
