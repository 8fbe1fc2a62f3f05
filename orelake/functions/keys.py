"""Surrogate keys, city / region split and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(col) -> Column:
    """``md5`` of the value, with NULL mapped to ``UNKNOWN`` first."""
    return F.md5(F.coalesce(_c(col).cast("string"), F.lit("UNKNOWN")))


def city_normalized(col) -> Column:
    """``REGION, CITY`` text upper-cased and trimmed; only NULL becomes ``UNKNOWN``."""
    return F.upper(F.trim(F.coalesce(_c(col), F.lit("UNKNOWN"))))


def _split(col, part: int) -> Column:
    c = _c(col)
    return F.when(F.instr(c, ",") > 0, F.trim(F.split_part(c, F.lit(","), F.lit(part)))).otherwise(c)


def city_part(normalized) -> Column:
    """Part after the first comma; the whole text when there is no comma."""
    return _split(normalized, 2)


def region_part(normalized) -> Column:
    """Part before the first comma; the whole text when there is no comma."""
    return _split(normalized, 1)


def event_key(student_id, course_id, event_time, fallback) -> Column:
    """Composite enrolment key: md5 of ``student|course|time`` (time falls back to the day key)."""
    return F.md5(F.concat(
        F.coalesce(_c(student_id), F.lit("UNKNOWN")), F.lit("|"),
        F.coalesce(_c(course_id), F.lit("UNKNOWN")), F.lit("|"),
        F.coalesce(_c(event_time).cast("string"), _c(fallback).cast("string")),
    ))


def date_key(date_col) -> Column:
    """``yyyyMMdd`` integer key of a date."""
    return F.date_format(_c(date_col), "yyyyMMdd").cast("int")


def region_key(col) -> Column:
    """Match key for region names: upper case, no blanks, dashes, underscores or quotes."""
    return F.coalesce(F.translate(F.upper(F.trim(_c(col))), "-_' ", ""), F.lit(""))
