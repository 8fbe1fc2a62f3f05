"""Keyed "latest wins" de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__orelake_rn"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep one row per key: the first by ``order``.

    ``order`` must be a total order inside a key (end it with a unique
    column) so the result never depends on row arrival.  Plain column names
    mean "descending, NULLs last", i.e. newest wins.

    Plan: ``row_number() = 1`` is planned as a partial ``WindowGroupLimit``
    before the shuffle plus a final one after it, so every map task forwards
    at most one row per key; a hot key that holds a third of the input does
    not pile up in one task.
    """
    spec = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*spec)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)
