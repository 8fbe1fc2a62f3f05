"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the provided tables and runs over all of their rows; the
matching DuckDB statement is in ``orelake.oracle_queries`` (shared CTEs in ``orelake.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.plans import kpi, lake
from orelake.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register a query; it always runs with the session settings the plans assume (UTC, AQE)."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- gold tables
@register("dim_date")
def q_dim_date(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).dim_date


@register("dim_city")
def q_dim_city(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).dim_city


@register("dim_course")
def q_dim_course(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).dim_course


@register("dim_student")
def q_dim_student(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).dim_student


@register("fact_student_daily")
def q_fact_student_daily(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).fact_student_daily


@register("mv_paid_students_daily")
def q_mv_paid(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).mv_paid_students_daily


@register("fact_course_enrollment_event")
def q_fact_enrol(spark, sf_dir):
    return lake.gold(spark, sf_dir, shared=False).fact_course_enrollment_event


@register("mv_course_enrollment_region_daily")
def q_mv_course(spark, sf_dir):
    return lake.gold(spark, sf_dir).mv_course_enrollment_region_daily


# ---------------------------------------------------------------- KPIs
@register("kpi_region_daily_paid")
def q_kpi_region_daily_paid(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.region_daily_paid(g.fact_student_daily, g.dim_date, g.dim_city)


@register("kpi_daily_paid")
def q_kpi_daily_paid(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.daily_paid(g.fact_student_daily, g.dim_date)


@register("kpi_unpaid_region_daily")
def q_kpi_unpaid(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.unpaid_region_daily(g.fact_student_daily, g.dim_date, g.dim_city)


@register("kpi_latest_tiles")
def q_kpi_tiles(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.latest_tiles(g.fact_student_daily, g.dim_date)


@register("kpi_region_rank_latest")
def q_kpi_rank(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.region_rank_latest(g.fact_student_daily, g.dim_date, g.dim_city)


@register("kpi_region_table")
def q_kpi_region_table(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.region_table(g.fact_student_daily, g.dim_date, g.dim_city)


@register("kpi_course_enrollment")
def q_kpi_course(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.course_enrollment(g.mv_course_enrollment_region_daily, g.dim_date)


@register("kpi_course_reach_quarter")
def q_course_reach_quarter(spark, sf_dir):
    """Distinct students per quarter, region and course, merged from the daily bitmaps."""
    bitmaps, dates = lake.course_students(spark, sf_dir)
    out = kpi.course_reach(bitmaps, dates, [F.col("year"), F.ceil(F.col("month") / 3).cast("int")], ["region_name", "course_key"])
    return out.withColumnsRenamed({"period_0": "year", "period_1": "quarter"})


@register("kpi_course_reach_year")
def q_course_reach_year(spark, sf_dir):
    """Distinct students per year and course over all regions, merged from the daily bitmaps."""
    out = kpi.course_reach(*lake.course_students(spark, sf_dir), [F.col("year")])
    return out.withColumnRenamed("period_0", "year")


@register("kpi_top_courses_latest")
def q_kpi_top(spark, sf_dir):
    from orelake.sinks import materialize
    g = lake.gold(spark, sf_dir)
    mart = materialize(g.mv_course_enrollment_region_daily, "mart")     # the report reads a stored mart
    return kpi.top_courses_latest(mart, g.dim_date, 12)


@register("kpi_access_mix")
def q_kpi_access(spark, sf_dir):
    return kpi.access_mix(lake.gold(spark, sf_dir, shared=False).fact_course_enrollment_event)


@register("kpi_region_map")
def q_kpi_map(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.region_map(g.fact_student_daily, g.dim_date, g.dim_city, lake.region_boundaries(spark, sf_dir))


@register("gold_run_metrics")
def q_gold_metrics(spark, sf_dir):
    g = lake.gold(spark, sf_dir)
    return kpi.run_metrics(g.fact_student_daily, g.mv_paid_students_daily, g.fact_course_enrollment_event)


# ---------------------------------------------------------------- silver
SILVER_CLEAN_OUT = ["entity_id", "account_id", "full_name", "phone_number", "city", "education_level",
                    "account_status", "technique", "is_contacted", "enrolled_courses_count", "is_paid_student",
                    "created_at", "updated_at", "bronze_batch_id", "silver_batch_id", "processed_at",
                    "_operation", "_source", "_table_name", "_partition_key", "_checksum"]


@register("silver_students_clean")
def q_silver_clean(spark, sf_dir):
    clean, _ = lake.silver_students(spark, sf_dir)
    return clean.select(*SILVER_CLEAN_OUT)


@register("silver_students_quarantine")
def q_silver_quarantine(spark, sf_dir):
    _, quarantine = lake.silver_students(spark, sf_dir)
    return quarantine.select(
        F.get_json_object("raw_payload", "$.entity_id").alias("entity_id"),
        F.get_json_object("raw_payload", "$.bronze_batch_id").alias("bronze_batch_id"),
        "quarantine_reason", "source_table", "bronze_file_path", "quarantined_at", "_partition_key")


@register("silver_title_case")
def q_silver_title_case(spark, sf_dir):
    """The text rules alone (FN-3..5): name title-cased after a strip, city capitalised then stripped."""
    from orelake.functions import capitalize_first, py_strip, title_case
    from orelake.plans.bronze import bronze_students
    b = bronze_students(spark, sf_dir)
    return b.select("doc_seq", title_case(py_strip("name")).alias("full_name"),
                    py_strip(capitalize_first("city")).alias("city"),
                    py_strip(F.lower("status")).alias("account_status"))


@register("silver_courses")
def q_silver_courses(spark, sf_dir):
    return lake.silver_courses(spark, sf_dir)


@register("silver_metrics")
def q_silver_metrics(spark, sf_dir):
    from orelake.plans.silver import run_counts, silver_metrics
    students = run_counts(lake.standardized(spark, sf_dir)).withColumnRenamed("_partition_key", "ds")
    courses = lake.silver_courses(spark, sf_dir).groupBy(F.col("ingest_ds").alias("ds")).agg(
        F.count(F.lit(1)).alias("courses_clean_count"))
    return silver_metrics(students, courses)


# ---------------------------------------------------------------- bronze
BRONZE_WATERMARK = "1998-01-01 00:00:00"
COURSE_CURSOR_KEY = 100


def _cursor_docs(spark, sf_dir):
    from orelake.functions import parse_ts, unify_extended
    from orelake.sources import student_documents
    docs = student_documents(spark, sf_dir)
    return docs.select("doc_seq", unify_extended("_id", "$oid").alias("entity_id"),
                       parse_ts(unify_extended("updatedAt", "$date")).alias("updated_ts"))


@register("bronze_incremental")
def q_bronze_incremental(spark, sf_dir):
    from orelake.operators import incremental_scan
    return incremental_scan(_cursor_docs(spark, sf_dir), "updated_ts", BRONZE_WATERMARK, tie="doc_seq", limit=1000)


@register("bronze_bootstrap")
def q_bronze_bootstrap(spark, sf_dir):
    from orelake.operators import incremental_scan
    return incremental_scan(_cursor_docs(spark, sf_dir), "updated_ts", None, tie="doc_seq", limit=1000)


@register("bronze_next_watermark")
def q_bronze_next_watermark(spark, sf_dir):
    from orelake.operators import incremental_scan, next_watermark
    batch = incremental_scan(_cursor_docs(spark, sf_dir), "updated_ts", BRONZE_WATERMARK, tie="doc_seq", limit=1000)
    return next_watermark(batch, "updated_ts", BRONZE_WATERMARK, tie="doc_seq")


@register("bronze_cursor_drain")
def q_bronze_cursor_drain(spark, sf_dir):
    from orelake.streaming.producer import course_change_events, valid_cursor
    from orelake.operators import incremental_scan
    from orelake.sources import course_documents
    docs = course_documents(spark, sf_dir)
    cursor = f"{COURSE_CURSOR_KEY:024x}"
    after = incremental_scan(docs, "_id", cursor if valid_cursor(cursor) else None, tie="_id", limit=None)
    return course_change_events(after, lake.RUN_TS)


@register("bronze_cursor_poll")
def q_bronze_cursor_poll(spark, sf_dir):
    """One poll of the course collection: the next 50 documents after the stored id cursor."""
    from orelake.operators import incremental_scan
    from orelake.sources import course_documents
    from orelake.streaming.producer import course_change_events, valid_cursor
    cursor = f"{COURSE_CURSOR_KEY:024x}"
    batch = incremental_scan(course_documents(spark, sf_dir), "_id", cursor if valid_cursor(cursor) else None,
                             tie="_id", limit=50)
    return course_change_events(batch, lake.RUN_TS)


@register("bronze_drain")
def q_bronze_drain(spark, sf_dir):
    """All documents drained in several commits; then a run that finds nothing new but late undated documents, whose ids
    lie among those already read."""
    from orelake.plans.daily import DayInputs, bronze_ingest
    from orelake.session import scratch_path
    from orelake.sources import student_documents
    docs = student_documents(spark, sf_dir)
    root = scratch_path(spark, "drain")
    late = (F.col("updatedAt") == "") & (F.col("doc_seq") % 2 == 1)
    step = -(-docs.count() // 3)
    bronze_ingest(spark, DayInputs(docs.filter(~late), tie_col="doc_seq"), "2024-03-01", root, lake.RUN_TS, batch_size=step)
    bronze_ingest(spark, DayInputs(docs, tie_col="doc_seq"), "2024-03-02", root, lake.RUN_TS)
    bronze = spark.read.parquet(f"{root}/bronze/students")
    return bronze.select("doc_seq", "_id", "updatedAt", "_partition_key")


@register("course_publish")
def q_course_publish(spark, sf_dir):
    """Course collection -> topic by a stored id cursor: the first half, then the rest, then nothing."""
    from orelake.session import scratch_path
    from orelake.sources import course_documents
    from orelake.streaming.producer import publish_courses
    docs = course_documents(spark, sf_dir)
    topic, state = scratch_path(spark, "topic"), scratch_path(spark, "cursor")
    half = f"{-(-docs.count() // 2):024x}"
    publish_courses(spark, docs.filter(F.col("_id") <= half), topic, state, lake.RUN_TS)
    for _ in range(2):
        publish_courses(spark, docs, topic, state, lake.RUN_TS)
    out = spark.read.schema("event_id string, event_time string, course_id string, course_name string, "
                            "event_type string").json(topic)
    return out.select("event_id", "course_id", "course_name", "event_type")


@register("bronze_email_lookup")
def q_bronze_email(spark, sf_dir):
    from orelake.operators import lookup_email
    from orelake.plans.bronze import normalize_documents
    from orelake.sources import student_documents, user_documents
    docs = normalize_documents(student_documents(spark, sf_dir).select("doc_seq", "_id", "userId"))
    return lookup_email(docs, user_documents(spark, sf_dir)).select("doc_seq", "userId", "email")


BRONZE_STAMPED_OUT = ["doc_seq", "_id", "userId", "status", "phone", "name", "city", "educationLevel",
                      "isContacted", "enrolledChapters", "boughtBooks", "createdAt", "updatedAt", "__v",
                      "_operation", "_source", "_ingested_at", "_batch_id", "_table_name", "_partition_key",
                      "_quality_flags"]


@register("bronze_stamped")
def q_bronze_stamped(spark, sf_dir):
    from orelake.plans.bronze import bronze_students
    return bronze_students(spark, sf_dir).select(*BRONZE_STAMPED_OUT)


def _listed_and_read(spark, path, name):
    """Per value of a column: rows, and whether the files listed are those the rows come from, with their bytes."""
    from orelake.operators.health import list_files
    listed = list_files(spark, path)
    rows = spark.read.parquet(path).select(F.col(name), F.col("_metadata.file_path").alias("file_path"),
                                           F.col("_metadata.file_size").alias("read_size"))
    files = rows.groupBy(name, "file_path").agg(F.count(F.lit(1)).alias("n"), F.max("read_size").alias("read_size"))
    both = listed.select(F.regexp_replace("file_path", "^file:/+", "/").alias("f"), "file_size").join(
        files.select(name, "n", "read_size", F.regexp_replace("file_path", "^file:/+", "/").alias("f")), "f", "full")
    return both.groupBy(name).agg(F.sum("n").cast("long").alias("record_count"),
                                  F.min(F.coalesce(F.col("file_size") == F.col("read_size"), F.lit(False))).alias("files_match"))


@register("bronze_file_sizes")
def q_bronze_file_sizes(spark, sf_dir):
    """Files and bytes per day of the written bronze layer (AGG-12), checked against the rows read back."""
    from orelake.plans.bronze import bronze_students, file_sizes
    from orelake.session import scratch_path
    from orelake.sinks import write_layer
    path = scratch_path(spark, "bronze_students")
    write_layer(bronze_students(spark, sf_dir), path, ["_partition_key"])
    sizes = file_sizes(spark, path, "_partition_key").select(
        "_partition_key", (F.col("file_count") > 0).alias("has_files"), (F.col("total_size_bytes") > 0).alias("has_bytes"))
    checked = _listed_and_read(spark, path, "_partition_key").withColumn("_partition_key", F.col("_partition_key").cast("string"))
    return checked.join(sizes, "_partition_key", "full")


@register("bronze_batch_metadata")
def q_bronze_batch_metadata(spark, sf_dir):
    from orelake.plans.bronze import batch_metadata, bronze_students
    return batch_metadata(bronze_students(spark, sf_dir))


# ---------------------------------------------------------------- streaming
def _land_course_events(spark, sf_dir, root: str, redeliver: bool = False) -> str:
    """Course events as a topic would hold them: JSON lines, one sub-folder per arrival week, in one write.

    With ``redeliver`` every update event is published again (fresh event id)
    a week later, the way an at-least-once producer repeats, and the first
    delivery of every 97th event comes ten weeks late.  Returns the glob of
    the landed folders.
    """
    from orelake.sources import course_events
    from orelake.streaming.producer import publish_events
    ev = course_events(spark, sf_dir).drop("_ingested_at", "ingest_ds")
    boot = F.col("event_id").startswith("boot-")
    week = F.floor(F.datediff(F.to_date(F.substring("event_time", 1, 10)), F.lit("2024-01-01")) / 7).cast("int")
    ev = ev.withColumn("arrival", F.when(boot, F.lit(-1)).otherwise(week))
    if redeliver:
        late = ~boot & (F.pmod("_offset", F.lit(97)) == 0)
        ev = ev.withColumn("arrival", F.col("arrival") + F.when(late, 10).otherwise(0))
        again = (ev.filter(~boot).withColumn("event_id", F.concat(F.lit("re-"), F.col("event_id")))
                   .withColumn("arrival", F.col("arrival") + 1))
        ev = ev.unionByName(again)
    publish_events(ev, root, partition_by=("arrival",))
    return f"{root}/*"


@register("stream_course_events")
def q_stream_course_events(spark, sf_dir):
    from orelake.session import scratch_path
    from orelake.streaming.course_feed import BRONZE_EVENT_SCHEMA, stream_to_bronze
    src = _land_course_events(spark, sf_dir, scratch_path(spark, "topic"))
    out, ckpt = scratch_path(spark, "bronze_stream"), scratch_path(spark, "ckpt")
    stream_to_bronze(spark, src, out, ckpt, options={"maxFilesPerTrigger": 32},
                     ingest_time_col="event_time").awaitTermination()
    bronze = spark.read.schema(BRONZE_EVENT_SCHEMA + ", ingest_date string").json(out)
    return bronze.select("event_id", "course_id", "course_name", "title", "_offset", "_ingested_at", "ingest_date")


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    from orelake.session import scratch_path
    from orelake.streaming.course_feed import dedupe_stream
    src = _land_course_events(spark, sf_dir, scratch_path(spark, "topic"), redeliver=True)
    out, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt")
    dedupe_stream(spark, src, out, ckpt, options={"maxFilesPerTrigger": 32}).awaitTermination()
    return spark.read.parquet(out).select("course_id", "course_name", "title", "updated_at", "_offset")


def _upsert_courses(spark, sf_dir, files_a_batch: int):
    from orelake.session import scratch_path
    from orelake.sinks import read_current
    from orelake.streaming.course_feed import dim_course_from_state, stream_to_bronze, upsert_stream
    src = _land_course_events(spark, sf_dir, scratch_path(spark, "topic"), redeliver=True)
    bronze, table_root = scratch_path(spark, "bronze_stream"), scratch_path(spark, "course_state")
    stream_to_bronze(spark, src, bronze, scratch_path(spark, "ckpt"), ingest_time_col="event_time",
                     options={"maxFilesPerTrigger": 1000}).awaitTermination()
    upsert_stream(spark, bronze, table_root, scratch_path(spark, "ckpt"),
                  options={"maxFilesPerTrigger": files_a_batch}).awaitTermination()
    return dim_course_from_state(read_current(spark, table_root), lake.RUN_TS)


@register("stream_upsert_courses")
def q_stream_upsert(spark, sf_dir):
    return _upsert_courses(spark, sf_dir, 64)


@register("stream_upsert_courses_other_cut")
def q_stream_upsert_other(spark, sf_dir):
    """The same stream cut into other micro-batches: the same dimension."""
    return _upsert_courses(spark, sf_dir, 150)


# ---------------------------------------------------------------- health checks
BUSINESS_COLS = ["_id", "userId", "status", "phone", "name", "city", "educationLevel", "isContacted",
                 "enrolledCourses", "enrolledChapters", "boughtBooks", "createdAt", "updatedAt"]
RETENTION_AS_OF = "2024-02-01"


CHECKSUM_COLS = ["_id", "userId", "status", "phone", "city", "createdAt", "updatedAt"]


@register("row_checksum")
def q_row_checksum(spark, sf_dir):
    from orelake.operators.health import row_checksum
    from orelake.plans.bronze import bronze_students
    return bronze_students(spark, sf_dir).select("doc_seq", row_checksum(CHECKSUM_COLS).alias("_checksum"))


@register("dedupe_checksum")
def q_dedupe_checksum(spark, sf_dir):
    """A slice's batch delivered twice: repeats (every tenth document) collapse, changed ones (every 15th) stay."""
    from orelake.operators.health import dedupe_on, row_checksum
    from orelake.plans.bronze import bronze_students
    b = bronze_students(spark, sf_dir).withColumn("_batch_id", F.concat(F.lit("slice-"), F.col("_partition_key")))
    later = F.lit("2030-01-01T00:00:00Z")
    again = b.filter(F.pmod("doc_seq", F.lit(10)) == 0).withColumn("_ingested_at", later)
    changed = b.filter(F.pmod("doc_seq", F.lit(15)) == 0).withColumns({"_ingested_at": later, "status": F.lit("Changed")})
    rows = b.unionByName(again).unionByName(changed)
    rows = rows.withColumn("_checksum", row_checksum(["doc_seq", *BUSINESS_COLS]))
    return dedupe_on(rows, ["_batch_id", "_checksum"]).select("doc_seq", "_batch_id", "status")


@register("missing_partitions")
def q_missing_partitions(spark, sf_dir):
    from orelake.functions import parse_ts
    from orelake.operators.health import missing_partitions
    from orelake.plans.bronze import bronze_students
    days = bronze_students(spark, sf_dir).select(parse_ts("_ingested_at").alias("ingest_day"))
    return missing_partitions(days, "ingest_day")


@register("missing_partitions_listed")
def q_missing_partitions_listed(spark, sf_dir):
    """Course events written without every fifth day of a month; the gaps are told from the file listing, no row is read."""
    from orelake.operators.health import listed_partitions, missing_partitions
    from orelake.session import scratch_path
    from orelake.sinks import write_layer
    from orelake.sources import course_events
    path = scratch_path(spark, "bronze_courses")
    write_layer(course_events(spark, sf_dir).filter(F.dayofmonth(F.to_date("ingest_ds")) % 5 > 0), path, ["ingest_ds"])
    return missing_partitions(listed_partitions(spark, path, "ingest_ds"), "ingest_ds")


def _written_layers(spark, sf_dir):
    """(path of written bronze students, path of written course events)."""
    from orelake.plans.bronze import bronze_students
    from orelake.session import scratch_path
    from orelake.sinks import write_layer
    from orelake.sources import course_events
    students, courses = scratch_path(spark, "bronze_students"), scratch_path(spark, "bronze_courses")
    write_layer(bronze_students(spark, sf_dir), students, ["_partition_key"])
    write_layer(course_events(spark, sf_dir), courses, ["ingest_ds"])
    return students, courses


@register("file_counts")
def q_file_counts(spark, sf_dir):
    """Files and bytes per collection from the listing, beside the rows that are read from those files."""
    from orelake.operators.health import file_counts, file_stats
    paths = dict(zip(("students", "courses"), _written_layers(spark, sf_dir)))
    parts = [file_counts(file_stats(spark, p, c)).join(_rows_of(spark, p, c), "collection") for c, p in paths.items()]
    return parts[0].unionByName(parts[1]).select(
        "collection", "record_count", (F.col("file_count") == F.col("files_read")).alias("files_match"),
        (F.col("total_size_bytes") == F.col("bytes_read")).alias("bytes_match"))


def _rows_of(spark, path, collection):
    """Rows of a written table, with the number and bytes of the files they are read from."""
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.max("_metadata.file_size").alias("size"), F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").cast("long").alias("record_count"), F.count("f").alias("files_read"),
                     F.sum("size").cast("long").alias("bytes_read")).withColumn("collection", F.lit(collection))


def _padded(rows):
    """(value, ingest_ds) of (line, wide, ingest_ds) rows, dealt and sorted by day before the lines are padded.

    A task holds a whole day's file, so it sorts short rows and pads as it
    writes.  The day is a date: the writer would sort a text once more.
    """
    days = rows.withColumn("ingest_ds", F.to_date("ingest_ds")).repartition("ingest_ds").sortWithinPartitions("ingest_ds")
    return days.select(F.rpad("line", F.when(F.col("wide"), 1023).otherwise(63), ".").alias("value"), "ingest_ds")


def _sized_layers(spark, sf_dir):
    """Files of known sizes: every course event and student document as a padded line, one file per day or slice.

    Lines have 64 bytes, those of the course bootstrap and of every 30th
    slice 1,024, so these files stand out.
    """
    from orelake.operators.health import file_stats
    from orelake.session import scratch_path
    from orelake.sources import course_events, student_documents
    events = course_events(spark, sf_dir).select("ingest_ds", F.col("event_id").alias("line"), F.col("event_id").startswith("boot-").alias("wide"))
    month = F.months_between(F.to_date("ingest_ds"), F.lit("1992-01-01").cast("date"), False)
    docs = student_documents(spark, sf_dir).select("ingest_ds", F.col("doc_seq").cast("string").alias("line"),
                                                   (month.cast("int") % 30 == 0).alias("wide"))
    out = None
    for name, rows in (("courses", events), ("students", docs)):
        path = scratch_path(spark, f"sized_{name}")
        _padded(rows).write.partitionBy("ingest_ds").text(path)
        files = file_stats(spark, path, name)
        out = files if out is None else out.unionByName(files)
    return out.withColumn("ds", F.regexp_extract("file_path", "/ingest_ds=([^/]*)/", 1))


@register("file_size_anomaly")
def q_file_size_anomaly(spark, sf_dir):
    """Every file of two collections of known sizes, with its collection's mean and the alert flag."""
    from orelake.operators.health import file_size_anomalies
    files = _sized_layers(spark, sf_dir)
    judged = file_size_anomalies(files).join(files.select("file_path", "ds"), "file_path")
    return judged.select("collection", "ds", "file_size", F.round("avg_file_size", 6).alias("avg_file_size"), "is_anomaly")


@register("file_sizes_known")
def q_file_sizes_known(spark, sf_dir):
    """Files and bytes per collection from the listing of files of known sizes."""
    from orelake.operators.health import file_counts
    return file_counts(_sized_layers(spark, sf_dir))


@register("retention_tier")
def q_retention_tier(spark, sf_dir):
    from orelake.operators.health import retention_tier
    from orelake.plans.bronze import bronze_students
    from orelake.sources import course_events
    parts = (bronze_students(spark, sf_dir).select(F.lit("students").alias("collection"),
                                                    F.col("_partition_key").alias("ds"))
             .unionByName(course_events(spark, sf_dir).select(F.lit("courses").alias("collection"),
                                                               F.col("ingest_ds").alias("ds")))
             .distinct())
    return retention_tier(parts, "ds", RETENTION_AS_OF)


# ---------------------------------------------------------------- table maintenance and file readers
UPSERT_SPLIT_DS = "1998-01-01"


@register("upsert_dim")
def q_upsert_dim(spark, sf_dir):
    """dim_student by two overlapping keyed upserts: the later slices' is begun first, the earlier slices' committed first."""
    from orelake.plans import gold as G
    from orelake.session import scratch_path
    from orelake.sinks import Commit, materialize, read_current, upsert
    clean = materialize(lake.silver_students(spark, sf_dir)[0], "silver")
    root, later = scratch_path(spark, "dim_student"), F.col("_partition_key") >= UPSERT_SPLIT_DS
    with Commit(spark, root) as c:
        c.upsert(G.dim_student(clean.filter(later), lake.RUN_TS), ["student_key"])
        upsert(spark, root, G.dim_student(clean.filter(~later), lake.RUN_TS), ["student_key"])
    return read_current(spark, root)


@register("replace_partition")
def q_replace_partition(spark, sf_dir):
    """Daily fact written for all days, later days re-run with one of them empty now: replaced in place, nothing left over."""
    from orelake.session import scratch_path
    from orelake.sinks import replace_partition
    fact = lake.gold(spark, sf_dir).fact_student_daily
    path = scratch_path(spark, "fact_student_daily")
    replace_partition(fact, path, "date_key")
    rerun = fact.filter((F.col("date_key") >= 19980101) & (F.col("date_key") != EMPTIED_DAY))
    replace_partition(rerun, path, "date_key", [EMPTIED_DAY])
    out = spark.read.parquet(path)
    return out.select("date_key", "city_key", "student_total_count", "student_paid_count", "paid_rate", "load_ts")


EMPTIED_DAY = 19980301
DAY_RUN_DS = "2024-01-05"


@register("day_run")
def q_day_run(spark, sf_dir):
    """One day end to end on a shared folder: all documents as one slice; every layer is read back and counted, the
    side-car's files and bytes are held against a listing, and the row checksums are counted."""
    from orelake.operators.health import list_files
    from orelake.plans.daily import DayInputs, read_gold, run_day
    from orelake.session import scratch_path
    from orelake.sources import course_events, read_partition, student_documents, user_documents
    root, events = scratch_path(spark, "day"), scratch_path(spark, "events")
    course_events(spark, sf_dir).withColumnRenamed("ingest_ds", "ingest_date").write.partitionBy("ingest_date").json(events)
    run_day(spark, DAY_RUN_DS, root, DayInputs(students=student_documents(spark, sf_dir), users=user_documents(spark, sf_dir),
            course_events_dir=events, tie_col="doc_seq"), as_of=lake.AS_OF, run_ts=lake.RUN_TS)
    g = read_gold(spark, root)

    def rows(layer, df):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), "row_count")
    parts = [rows(layer, read_partition(spark, f"{root}/{layer}", part, DAY_RUN_DS)) for layer, part in (
        ("bronze/students", "_partition_key"), ("silver/students", "_partition_key"),
        ("silver/quarantine", "_partition_key"), ("silver/courses", "ingest_ds"))]
    parts += [rows(f"gold/{n}", g[n]) for n in ("dim_date", "dim_city", "dim_course", "dim_student", "fact_student_daily",
                                                "mv_paid_students_daily")]
    meta = spark.read.json(f"{root}/bronze/_meta/students").select(F.lit("sidecar").alias("layer"), F.col("record_count").alias("row_count"))
    silver = spark.read.json(f"{root}/silver/_metrics").select(F.lit("silver metrics").alias("layer"), F.col("total_clean_count").alias("row_count"))
    gold_ = spark.read.json(f"{root}/gold/_metrics").select(F.lit("gold metrics").alias("layer"), F.col("student_total_count").alias("row_count"))
    sidecar = spark.read.json(f"{root}/bronze/_meta/students").filter("quality_status = 'PASSED_7_POINT_GATE'")
    listed = list_files(spark, f"{root}/bronze/students").agg(F.count("*").alias("file_count"), F.sum("file_size").alias("total_size_bytes"))
    same = rows("sidecar equal to the listing", sidecar.join(listed, ["file_count", "total_size_bytes"]))
    sums = [rows(f"{layer} with checksum", read_partition(spark, f"{root}/{layer}", "_partition_key", DAY_RUN_DS).filter(
        F.col("_checksum").rlike("^[0-9a-f]{8}$"))) for layer in ("bronze/students", "silver/students")]
    out = meta.unionByName(silver).unionByName(gold_).unionByName(same)
    for p in [*parts, *sums]:
        out = out.unionByName(p)
    return out


@register("table_roundtrip")
def q_table_roundtrip(spark, sf_dir):
    """Bronze written as a partitioned layer, read back, every slice checked present, batch side-cars."""
    from orelake.plans.bronze import batch_metadata
    from orelake.sources import require_rows
    students = spark.read.parquet(_written_layers(spark, sf_dir)[0])
    require_rows(students, "bronze students")
    return batch_metadata(students)


@register("jsonl_tolerant_scan")
def q_jsonl_tolerant(spark, sf_dir):
    """Course events as JSON lines with blank and truncated lines mixed in; the scan skips both."""
    from orelake.session import scratch_path
    from orelake.sources import course_events, read_jsonl_tolerant
    from orelake.streaming.course_feed import EVENT_SCHEMA
    ev = course_events(spark, sf_dir).drop("_ingested_at", "ingest_ds")
    line = F.to_json(F.struct(*ev.columns))
    lines = ev.select(line.alias("value"))
    broken = ev.filter(F.pmod("_offset", F.lit(10)) == 0).select(F.substring(line, 1, 25).alias("value"))
    blank = ev.filter(F.pmod("_offset", F.lit(25)) == 0).select(F.lit("   ").alias("value"))
    path = scratch_path(spark, "events_jsonl")
    lines.unionByName(broken).unionByName(blank).write.text(path)
    return read_jsonl_tolerant(spark, path, EVENT_SCHEMA).select("event_id", "course_id", "course_name", "title",
                                                                 "_offset")


@register("extended_json_scan")
def q_extended_json(spark, sf_dir):
    """Student documents as JSON lines where ids / dates are plain or ``$oid`` / ``$date`` objects."""
    from orelake.session import scratch_path
    from orelake.sources import read_extended_json, student_documents
    docs = student_documents(spark, sf_dir)

    def value(c):
        return (F.when(F.col(c).isNull(), F.lit("null"))
                 .when(F.col(c).startswith("{"), F.col(c))
                 .otherwise(F.concat(F.lit('"'), F.col(c), F.lit('"'))))
    line = F.concat(F.lit('{"doc_seq": '), F.col("doc_seq").cast("string"), F.lit(', "_id": '), value("_id"),
                    F.lit(', "createdAt": '), value("createdAt"), F.lit(', "updatedAt": '), value("updatedAt"),
                    F.lit("}"))
    path = scratch_path(spark, "students_json")
    docs.select(line.alias("value")).write.text(path)
    schema = "doc_seq long, _id string, createdAt string, updatedAt string"
    return read_extended_json(spark, path, schema, date_cols=("createdAt", "updatedAt"), multi_line=False)
