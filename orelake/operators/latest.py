"""Filter to the latest value of a column (the "latest day" of a report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the column's maximum.

    The maximum is a one-row global aggregate, so broadcasting it is
    bounded by construction; the join is an equi-join on ``col``, not a
    cross join, and the large side is never shuffled.
    """
    top = df.agg(F.max(col).alias(col))
    return df.join(F.broadcast(top), on=col, how="left_semi")
