"""Course-event feed: topic (or landed files) -> bronze JSON lines -> keyed latest state.

* ``stream_to_bronze``: ``readStream`` -> ingest stamp -> ``writeStream`` JSON
  partitioned by ingest date, offsets in the checkpoint (exactly-once with
  the file sink).  ``fmt="kafka"`` reads a topic where the connector is on
  the class path; ``decode_topic_records`` turns its records into events.
* ``dedupe_stream``: repeated deliveries dropped by ``(course_id,
  updated_at)`` against an index of all keys seen; late first deliveries stay.
* ``upsert_stream``: newest state per course as streaming state -> changed
  courses -> last-delivered-wins merge into a versioned table (a replayed
  batch changes nothing).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orelake.functions import iso_z, parse_ts
from orelake.plans import gold as G
from orelake.plans.silver import course_rows, standardize_courses
from orelake.sinks import upsert

# Schema of one course event as published on the topic.
EVENT_SCHEMA = ("event_id string, event_time string, course_id string, course_name string, title string, "
                "event_type string, created_at string, updated_at string, _topic string, _partition int, "
                "_offset long")
BRONZE_EVENT_SCHEMA = EVENT_SCHEMA + ", _ingested_at string"
# Where streaming state is kept.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def decode_topic_records(records: DataFrame) -> DataFrame:
    """Topic records (``value`` bytes/text, ``topic``, ``partition``, ``offset``) -> event columns."""
    body = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA.rsplit(", _topic", 1)[0])
    return records.select(body.alias("e"), "topic", "partition", "offset").select(
        "e.*", F.col("topic").alias("_topic"), F.col("partition").cast("int").alias("_partition"),
        F.col("offset").cast("long").alias("_offset"))


def read_event_stream(spark: SparkSession, fmt: str, path_or_topic: str, options: dict | None = None) -> DataFrame:
    """Streaming source of course events: landed JSON files, or a topic (``fmt="kafka"``)."""
    options = dict(options or {})
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
        raw = spark.readStream.format("kafka").option("subscribe", path_or_topic).options(**options).load()
        return decode_topic_records(raw)
    options.setdefault("mode", "DROPMALFORMED")
    return spark.readStream.format(fmt).schema(EVENT_SCHEMA).options(**options).load(path_or_topic)


def stamp_ingest(events: DataFrame, ingest_time_col: str | None = None) -> DataFrame:
    """``_ingested_at`` (processing time, or a given column for repeatable runs) and its date."""
    ts = F.current_timestamp() if ingest_time_col is None else parse_ts(F.col(ingest_time_col))
    return events.withColumn("_ingested_at", iso_z(ts, 6)).withColumn(
        "ingest_date", F.date_format(ts, "yyyy-MM-dd"))


def _trigger(writer, trigger: dict | None):
    trigger = trigger or {"availableNow": True}
    return writer.trigger(**trigger)


def stream_to_bronze(spark: SparkSession, source: str, out: str, checkpoint: str, fmt: str = "json",
                     options: dict | None = None, trigger: dict | None = None,
                     ingest_time_col: str | None = None) -> StreamingQuery:
    """Topic / landed files -> bronze JSON lines, one folder per ingest date."""
    events = stamp_ingest(read_event_stream(spark, fmt, source, options), ingest_time_col)
    writer = (events.writeStream.format("json").partitionBy("ingest_date")
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(writer, trigger).start(out)


@contextmanager
def _state_settings(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """State in RocksDB with change-log checkpoints, for the queries started inside; the session's own settings come back after it.

    A query keeps the settings it was started with.  ``partitions`` is the
    number of state partitions of a new checkpoint (default: the session's).
    """
    wanted = dict(STATE_SETTINGS) | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedupe_stream(spark: SparkSession, source: str, out: str, checkpoint: str, options: dict | None = None,
                  trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Drop repeated deliveries: the first of each ``(course_id, updated_at)`` is kept, however late it comes.

    Each publish gets a fresh ``event_id``, so the id cannot detect repeats.
    The keys seen are an index on disk (RocksDB, one instance per state
    partition, hashed by key): a micro-batch looks up its own keys and adds
    the new ones, so its cost follows the batch and not the history, and the
    checkpoint takes the changes only.  No event-time bound applies, so
    nothing is dropped as late.  A micro-batch writes the folder of its
    number; a replayed one overwrites it.
    """
    unique = read_event_stream(spark, "json", source, options).dropDuplicates(["course_id", "updated_at"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    with _state_settings(spark, partitions):
        writer = unique.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return _trigger(writer, trigger).start()


# The merged course state; the last two columns are the delivery order.
STATE_COLUMNS = ["course_id", "course_name", "created_at", "updated_at", "_ingested_ts", "_offset"]


# The order in which a course's last delivery is found.
NEWEST = ["_ingested_ts", "_offset", "updated_at", "course_name"]


def merge_courses(current: DataFrame | None, bronze_batch: DataFrame) -> DataFrame:
    """Last-delivered-wins merge of one bronze micro-batch into the course state.

    Batch and state are stacked and reduced per course by the delivery order
    ``(_ingested_at, _offset)``, which the state carries.  The maximum of an
    order does not depend on how the stream is cut into batches or on their
    sequence, so a replayed batch changes nothing.
    """
    fresh = standardize_courses(bronze_batch, None, keep_order=True).select(*STATE_COLUMNS)
    if current is not None:
        fresh = current.select(*STATE_COLUMNS).unionByName(fresh)
    return G.latest_by_key(fresh, ["course_id"], NEWEST)


def newest_courses(events: DataFrame) -> DataFrame:
    """The last delivered state of each course, as a grouped maximum: also a streaming aggregate (update mode)."""
    rows = course_rows(events).select(*STATE_COLUMNS)
    rest = [c for c in STATE_COLUMNS if c not in NEWEST and c != "course_id"]
    best = rows.groupBy("course_id").agg(F.max(F.struct(*NEWEST, *rest)).alias("best"))
    return best.select("course_id", "best.*").select(*STATE_COLUMNS)


def upsert_stream(spark: SparkSession, bronze_dir: str, table_root: str, checkpoint: str, options: dict | None = None,
                  trigger: dict | None = None, partitions: int | None = None, keep_s: float = 3600) -> StreamingQuery:
    """Bronze course events (stream) -> newest state per course -> versioned course table.

    The newest delivery of each course is streaming state (RocksDB); a
    micro-batch emits just the courses that changed.  They are merged into
    the table in the same order, so late or repeated micro-batches, another
    cut of the stream or a second feed never put back an older state, and a
    replay rewrites no bucket.
    """
    events = (spark.readStream.format("json").schema(BRONZE_EVENT_SCHEMA + ", ingest_date string")
              .options(**dict(options or {})).load(bronze_dir))

    def apply(changed: DataFrame, batch_id: int) -> None:
        upsert(changed.sparkSession, table_root, changed, ["course_id"], newest=NEWEST, keep_s=keep_s)

    with _state_settings(spark, partitions):
        writer = newest_courses(events).writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
        return _trigger(writer, trigger).start()


def dim_course_from_state(state: DataFrame, run_ts) -> DataFrame:
    """The course dimension from the merged course state."""
    return state.select(G.surrogate_key("course_id").alias("course_key"), "course_id",
                        F.coalesce("course_name", F.lit("UNKNOWN")).alias("course_name"),
                        F.lit(run_ts).cast("timestamp_ntz").alias("created_at"))
