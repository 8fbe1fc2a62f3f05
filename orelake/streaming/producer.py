"""Course documents -> course change events (the publish side of the feed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import incremental_scan
from orelake.sinks import read_current, scratch_copy, write_version

# Shape of a valid document cursor (24 hex digits).
CURSOR_PATTERN = r"^[0-9a-fA-F]{24}$"


def valid_cursor(cursor: str | None) -> bool:
    """A stored cursor is used only when it looks like a document id; otherwise scan from the start."""
    import re
    return bool(cursor) and re.match(CURSOR_PATTERN, cursor) is not None


def course_change_events(docs: DataFrame, event_time) -> DataFrame:
    """One ``upsert`` event per course document.

    ``event_time`` is the publish time (a literal, so runs are repeatable);
    the event id is derived from document and publish time.  The name is the
    first of ``course_name``, ``title`` and ``name`` that is there; dates fall
    back between snake and camel case.
    """
    ts = F.lit(event_time).cast("timestamp_ntz")
    cols = set(docs.columns)
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in cols], F.lit(None).cast("string"))
    return docs.select(
        F.md5(F.concat_ws("|", F.col("_id"), ts.cast("string"))).alias("event_id"),
        ts.alias("event_time"),
        F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("course_id"),
        pick("course_name", "title", "name").alias("course_name"),
        F.lit("upsert").alias("event_type"),
        F.coalesce(pick("created_at", "createdAt"), F.lit("")).alias("created_at"),
        F.coalesce(pick("updated_at", "updatedAt"), F.lit("")).alias("updated_at"),
    )


def publish_events(events: DataFrame, target: str, fmt: str = "json", options: dict | None = None,
                   partition_by: tuple[str, ...] = ()) -> None:
    """Publish events: ``to_json(struct(*))`` as the record value to a topic (``fmt="kafka"``,
    ``target`` = topic), or as JSON lines appended to a landing folder (one sub-folder per
    value of ``partition_by``)."""
    if fmt == "kafka":
        (events.select(F.col("course_id").cast("string").alias("key"),
                       F.to_json(F.struct(*events.columns)).alias("value"))
         .write.format("kafka").option("topic", target).options(**(options or {})).save())
    else:
        events.write.mode("append").partitionBy(*partition_by).options(**(options or {})).json(target)


def publish_courses(spark: SparkSession, docs: DataFrame, target: str, state_root: str, event_time,
                    fmt: str = "json", options: dict | None = None, batch_size: int | None = None) -> int:
    """Course collection -> topic: everything after the stored id cursor, then the cursor.

    The first run publishes the whole collection; later ones what came since.
    ``batch_size`` cuts a run into commits, repeated until nothing is left.
    A stored cursor that does not look like a document id is ignored.  The
    cursor is stored after the events, so a run cut short in between repeats
    its last commit (same event ids).  Returns the number of events.
    """
    total = 0
    while True:
        state = read_current(spark, state_root)
        row = state.select("cursor").first() if state is not None else None
        cursor = row["cursor"] if row is not None and valid_cursor(row["cursor"]) else None
        with scratch_copy(incremental_scan(docs, "_id", cursor, tie="_id", limit=batch_size), "courses") as batch:
            last, n = batch.agg(F.max("_id"), F.count(F.lit(1))).first()
            if n:
                publish_events(course_change_events(batch, event_time), target, fmt, options)
        total += n
        if n:
            if last is None:
                return total
            write_version(spark.createDataFrame([(last, str(event_time))], "cursor string, published_at string"), state_root)
        if batch_size is None or n < batch_size:
            return total
