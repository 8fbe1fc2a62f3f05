"""Helpers the operators share: row guards, word hashes over Arrow buffers, balanced numbering."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.session import scratch_path

SEGMENT = 1 << 20  # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, text, ...) and no other column, so names of further columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in extra])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back with its own schema.

    Cuts the lineage: several consumers share one computation, and a lost
    executor costs a re-read.  Row numbers taken before the cut stay fixed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int, limit: int = SEGMENT) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    col = batch.column(column)
    if not len(col):
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of the hash base, modulo 2^64."""
    have = _POWERS.get(0)
    if have is None or len(have) < n:
        base = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        base[0] = 1
        have = _POWERS[0] = np.multiply.accumulate(base)
    return have


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        h = h ^ np.uint64(seed * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _segment_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word of one byte segment."""
    inside = np.empty(len(raw) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[raw]
    turn = np.flatnonzero(np.diff(inside))
    start, end = turn[::2], turn[1::2]
    if not len(start):
        return start, end, np.empty(0, dtype=np.uint64)
    size = end - start
    with np.errstate(over="ignore"):
        base = powers(int(size.max()) + 1)
        at = np.arange(int(size.sum()), dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        within = at - np.repeat(first, size)
        value = (raw[inside[1:-1].view(bool)].astype(np.uint64) + np.uint64(1)) * base[within]
        return start, end, mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of every word of a UTF-8 byte array of any length.

    Long arrays are hashed in segments cut at white space, so the temporary
    memory follows the segment (or the longest word), not the text.
    """
    if len(raw) <= SEGMENT:
        return _segment_words(raw)
    out, at = [], 0
    while at < len(raw):
        to = min(at + SEGMENT, len(raw))
        while to < len(raw) and not _SPACE[raw[to]]:
            gap = np.flatnonzero(_SPACE[raw[to:to + SEGMENT]])
            to = to + int(gap[0]) if len(gap) else min(to + SEGMENT, len(raw))
        s, e, h = _segment_words(raw[at:to])
        out.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def running_total(df: DataFrame, group: list[str], order: list[str], size: Column, name: str,
                  buckets: int = 1024) -> DataFrame:
    """Add ``name``: the sum of ``size`` over the rows of the same group that come before.

    The order is (bucket of the MD5 of ``order``, ``order``).  One group may
    hold any share of the rows: each is dealt into ``buckets`` parts, summed
    within a part by a window and across the parts by a window over at most
    ``buckets`` totals.  Ties in ``order`` must not matter to the caller.
    """
    from pyspark.sql import Window as W
    b, s, key = fresh(df, "bucket__"), fresh(df, "size__"), [F.col(c) for c in order]
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in key]))
    rows = df.withColumn(b, F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") % buckets).withColumn(s, size.cast("long"))
    inner = W.partitionBy(*group, b).orderBy(*key).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(*group).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    before, keys = f"{name}__before", [*group, b]
    total = (rows.groupBy(*keys).agg(F.sum(s).alias(s))
             .select(*[F.col(c).alias(f"{c}__key") for c in keys], F.coalesce(F.sum(s).over(outer), F.lit(0)).alias(before)))
    on = [F.col(c).eqNullSafe(F.col(f"{c}__key")) for c in keys]
    out = (rows.join(total, reduce(and_, on), "left")
           .withColumn(name, F.col(before) + F.coalesce(F.sum(s).over(inner), F.lit(0))))
    return out.select(*df.columns, name)
