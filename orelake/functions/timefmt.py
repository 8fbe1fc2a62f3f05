"""Timestamp parsing / formatting and exact percentage text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col) -> Column:
    """ISO text -> zone-less UTC timestamp; each value parsed on its own, bad text -> NULL."""
    return _c(col).cast("string").try_cast("timestamp").cast("timestamp_ntz")


def iso_z(col, fraction_digits: int = 3) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss[.fff]Z`` text."""
    frac = "." + "S" * fraction_digits if fraction_digits else ""
    return F.date_format(_c(col), f"yyyy-MM-dd'T'HH:mm:ss{frac}'Z'")


def percent_text(numerator, denominator) -> Column:
    """``100 * n / d`` as text with two decimals and ``%``, rounded half-up on the exact ratio.

    Integer arithmetic only, so the text never depends on binary float rounding.
    """
    n = _c(numerator).cast("decimal(38,0)")
    d = _c(denominator).cast("decimal(38,0)")
    hundredths = F.when(d == 0, F.lit(0)).otherwise(F.floor((n * 20000 + d) / (d * 2))).cast("long")
    return F.format_string("%d.%02d%%", F.floor(hundredths / 100).cast("long"), F.pmod(hundredths, F.lit(100)))
