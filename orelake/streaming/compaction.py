"""Compaction of closed days of a landed JSON-lines folder: few large files, swapped in by one commit."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators.health import listed_partitions
from orelake.session import hadoop_path
from orelake.sinks import Commit, partitions, read_current
from orelake.streaming.course_feed import BRONZE_EVENT_SCHEMA

SOURCES = "sources"


def _landed(spark: SparkSession, folder: str, schema: str, day_col: str) -> DataFrame:
    """Rows of the landed files with their day (text) and file name; files that a clean-up has removed are skipped."""
    raw = spark.read.schema(f"{schema}, {day_col} string").option("ignoreMissingFiles", True).json(folder)
    return raw.select("*", F.col("_metadata.file_name").alias("file__"))


def _unpacked(spark: SparkSession, folder: str, root: str, schema: str, day_col: str) -> DataFrame:
    """Rows of files that no commit has packed: those of open days, and late files of packed days."""
    rows, days = _landed(spark, folder, schema, day_col), partitions(spark, root)
    if not days:
        return rows
    packed = F.col(day_col).isin(days)
    sources = read_current(spark, root, table=SOURCES).select(F.col("day").alias(day_col), "file__")
    return rows.filter(~packed).unionByName(rows.filter(packed).join(sources, [day_col, "file__"], "left_anti"))


def compact_closed_days(spark: SparkSession, folder: str, root: str, before: str, target_bytes: int = 128 << 20,
                        schema: str = BRONZE_EVENT_SCHEMA, day_col: str = "ingest_date", keep_s: float = 3600) -> list[str]:
    """Pack the landed files of all days before ``before`` that are not packed yet; returns the days.

    A day becomes about its bytes / ``target_bytes`` files, rows dealt by
    their hash.  The packed files and the list of the files they replace
    become visible by one commit, so a reader (:func:`read_compacted`) sees
    each row once, before and after; the landed files stay until
    :func:`remove_packed`.  Late files of a packed day are packed with it by
    the next run.  All days of a run are one job; of two runs at once one
    raises ``CommitConflict``.
    """
    there = f"{folder.rstrip('/')}/{day_col}=*"  # the folders as they are, not the sink's log of what it once wrote
    size = {r[day_col]: r["total_size_bytes"] for r in
            listed_partitions(spark, there, day_col).filter(F.col(day_col) < before).collect()}
    if not size:
        return []
    with Commit(spark, root, keep_s=keep_s) as c:
        done = {*partitions(spark, root)}
        fresh = _unpacked(spark, folder, root, schema, day_col).filter(F.col(day_col).isin(list(size)))
        files = fresh.select(F.col(day_col).alias("day"), "file__").distinct().collect()
        days = sorted({f["day"] for f in files})
        if not days:
            return []
        rows = fresh.drop("file__")
        again = sorted(done.intersection(days))
        if again:
            rows = rows.unionByName(c.read(parts=again))
        parts = {d: max(1, -(-size[d] // target_bytes)) for d in days}
        share = F.element_at(F.create_map(*[F.lit(x) for d, n in parts.items() for x in (d, n)]), F.col(day_col))
        dealt = F.pmod(F.xxhash64(*[x for x in rows.columns if x != day_col]), share)
        c.replace(rows.repartition(sum(parts.values()), day_col, dealt), day_col, days, exclusive=True)
        c.upsert(spark.createDataFrame([(f["day"], f["file__"]) for f in files], "day string, file__ string"),
                 ["day", "file__"], buckets=8, table=SOURCES)
    return days


def read_compacted(spark: SparkSession, folder: str, root: str, schema: str = BRONZE_EVENT_SCHEMA,
                   day_col: str = "ingest_date") -> DataFrame:
    """All rows of the landed folder, those of packed days from the packed files."""
    open_rows = _unpacked(spark, folder, root, schema, day_col).drop("file__")
    packed = read_current(spark, root)
    return open_rows if packed is None else open_rows.unionByName(packed)


def remove_packed(spark: SparkSession, folder: str, root: str, older_than_s: float = 3600, day_col: str = "ingest_date") -> int:
    """Delete landed files that were packed and are older than any reader that opened them; their number.

    Days whose landed files are gone cost a reader nothing but a listing.
    """
    sources, gone = read_current(spark, root, table=SOURCES), 0
    names: dict[str, set] = {}
    for r in sources.collect() if sources is not None else []:
        names.setdefault(r["day"], set()).add(r["file__"])
    for day, own in names.items():
        fs, p = hadoop_path(spark, f"{folder.rstrip('/')}/{day_col}={day}")
        for s in fs.listStatus(p) if fs.exists(p) else []:
            if s.getPath().getName() in own and time.time() - s.getModificationTime() / 1000 > older_than_s:
                gone += fs.delete(s.getPath(), False)
    return gone
