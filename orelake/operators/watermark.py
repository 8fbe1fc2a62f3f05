"""High-watermark (cursor) scans."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.session import hadoop_path, scratch_path

TOP_K = 10_000  # rows up to which a batch is a per-task top-k, gathered by one task


class Cursor(NamedTuple):
    """Where a scan stands: the last ``(watermark, tie)`` read, and the last tie among rows without a watermark.

    All values are text, so no driver time zone can shift them.
    """

    watermark: str | None = None
    tie: str | None = None
    null_tie: str | None = None


def _typed(value, src: DataFrame, name: str) -> Column:
    """A cursor value as a literal of its column's type; times go by their wall-clock text."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast(src.schema[name].dataType)


def incremental_scan(src: DataFrame, wm_col: str, wm=None, tie: str = "_id", limit: int | None = None,
                     tie_wm=None, until=None, null_tie=None, nulls: bool = False) -> DataFrame:
    """Rows strictly after the cursor ``(wm, tie_wm)`` in ``(wm_col, tie)`` order.

    * ``wm is None``: no lower bound, unless ``null_tie`` is set; NULL cursor
      values sort first.
    * ``tie_wm is None``: plain ``wm_col > wm``.  Otherwise rows equal to
      ``wm`` but with a larger tie value are kept too, so a batch limit never
      strands rows that share the boundary value.
    * ``nulls`` (or ``null_tie``): rows with a NULL cursor value have a cursor
      of their own, their tie value: those after ``null_tie`` (all, if NULL)
      are read as well, so late ones are found and none is read twice.
    * ``until`` optionally bounds the scan from above (inclusive).
    * ``limit`` cuts the scan into batches; ``None`` drains everything after
      the cursor (unordered: the order only decides which rows fill a batch).

    Filter first, then ``orderBy().limit()`` -> ``TakeOrderedAndProject``: each
    task keeps only its ``limit`` best rows, so the batch limit never sorts
    the whole source.  One task gathers them all, so a batch above ``TOP_K``
    rows is a filter by its last key instead (see :func:`_first_rows`).
    """
    out, c, t = src, F.col(wm_col), F.col(tie)
    newer = F.lit(True) if wm is None else c > _typed(wm, src, wm_col)
    if wm is not None and tie_wm is not None:
        newer = newer | ((c == _typed(wm, src, wm_col)) & (t > _typed(tie_wm, src, tie)))
    if until is not None:
        newer = newer & (c <= _typed(until, src, wm_col))
    if nulls or null_tie is not None or wm is None:
        fresh = F.lit(True) if null_tie is None else t > _typed(null_tie, src, tie)
        blank = c.isNull() & fresh if until is None else F.lit(False)
        out = out.filter((c.isNotNull() & newer) | blank)
    else:
        out = out.filter(newer)
    if limit is None:
        # a full drain needs no order: sorting everything would only cost a range shuffle
        return out
    if limit > TOP_K:
        return _first_rows(out, wm_col, tie, limit)
    return out.orderBy(c.asc_nulls_first(), t.asc_nulls_first()).limit(limit)


def _first_rows(src: DataFrame, wm_col: str, tie: str, limit: int) -> DataFrame:
    """The ``limit`` first rows in ``(wm_col, tie)`` order, nulls first, without one task that sees them all.

    The distinct keys with their numbers of rows are written once in ranges;
    the rows of each range (one number each) tell the range the batch ends
    in, and that range alone is added up to the last key.  The batch is then
    a filter.  Only where more rows share the last key than there is room for
    are they cut by a limit, as any of them will do.
    """
    spark, path = src.sparkSession, scratch_path(src.sparkSession, "cursor_keys")
    order = [F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first()]
    keys = src.groupBy(F.col(wm_col).alias("c"), F.col(tie).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    ranged = keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(path)
    try:
        ranged = spark.read.schema(ranged.schema).parquet(path)
        before, last = 0, None
        for r in sorted(ranged.groupBy("part").agg(F.sum("n").alias("n")).collect()):
            if before + r["n"] >= limit:
                last = r["part"]
                break
            before += r["n"]
        if last is None:
            return src
        inside = ranged.filter(F.col("part") == last).withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy(*order)))
        end = inside.filter(F.col("upto") >= limit - before).orderBy("upto").select(
            F.col("c").cast("string").alias("c"), F.col("t").cast("string").alias("t"), "n", "upto").first()
    finally:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)
    c, t = F.col(wm_col), F.col(tie)
    end_c, end_t = _typed(end["c"], src, wm_col), _typed(end["t"], src, tie)
    same = c.eqNullSafe(end_c)
    earlier = F.lit(False) if end["c"] is None else F.coalesce(c < end_c, F.lit(True))
    smaller = F.lit(False) if end["t"] is None else F.coalesce(t < end_t, F.lit(True))
    less, tied = earlier | (same & smaller), same & t.eqNullSafe(end_t)
    room = end["n"] - (end["upto"] - (limit - before))
    if room == end["n"]:
        return src.filter(less | tied)
    return src.filter(less).unionByName(src.filter(tied).limit(room))


def next_watermark(batch: DataFrame, wm_col: str, old=None, tie: str = "_id") -> DataFrame:
    """One-row cursor after a batch: the largest ``(wm_col, tie)`` seen.

    Rows with a NULL cursor value do not move it; an empty or all-NULL batch
    keeps the old value.  A global aggregate: partial maxima per task, one
    tiny final merge.
    """
    best = batch.filter(F.col(wm_col).isNotNull()).agg(
        F.max(F.struct(F.col(wm_col).alias("wm"), F.col(tie).alias("tie"))).alias("m"),
        F.count(F.lit(1)).alias("batch_rows"))
    old_col = _typed(old, batch, wm_col)
    return best.select(
        F.coalesce(F.col("m.wm"), old_col).alias("watermark"),
        F.col("m.tie").alias("watermark_tie"),
        F.col("batch_rows"))


def advance(batch: DataFrame, wm_col: str, tie: str, old: Cursor) -> tuple[Cursor, int]:
    """(cursor after the batch, rows in it), from one global aggregate; values come back as text."""
    c, t = F.col(wm_col), F.col(tie)
    r = batch.agg(F.max(F.when(c.isNotNull(), F.struct(c.alias("wm"), t.alias("tie")))).alias("m"),
                  F.max(F.when(c.isNull(), t)).alias("n"), F.count(F.lit(1)).alias("rows")).select(
        F.col("m.wm").cast("string").alias("wm"), F.col("m.tie").cast("string").alias("tie"),
        F.col("n").cast("string").alias("null_tie"), "rows").first()
    moved = (r["wm"], r["tie"]) if r["wm"] is not None else (old.watermark, old.tie)
    return Cursor(*moved, r["null_tie"] if r["null_tie"] is not None else old.null_tie), r["rows"]
