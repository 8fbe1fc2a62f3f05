"""One day of the layered pipeline with real writes: bronze -> silver -> gold.

``run_day`` is the Spark form of the nightly batch: every step is a
DataFrame plan, hand-over between steps is partitioned Parquet in ``root``
(a shared folder).  Bronze commits its rows with the cursor, exactly once;
gold commits its eight tables together: dimensions by keyed upsert, facts by
replacing exactly the day's partition (cleared, if the day is empty now), so
re-running a day is idempotent.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.functions import iso_z, parse_ts, unify_extended
from orelake.operators import Cursor, advance, incremental_scan, lookup_email
from orelake.operators.health import list_files, row_checksum
from orelake.plans import gold as G
from orelake.plans import kpi
from orelake.plans.bronze import batch_sidecar, normalize_documents, stamp_bronze
from orelake.plans.silver import (silver_day_metrics, split_clean_quarantine, standardize_courses,
                                  standardize_students)
from orelake.schemas import KEYS, conform, empty_table, schema
from orelake.session import hadoop_path, prepare_session
from orelake.sinks import (Commit, CommitConflict, partitions, read_current, read_tables, replace_partition, scratch_copy, table_exists,
                           write_json_record, write_layer)
from orelake.sources import read_partition, require_rows


KEEP_S = 3600  # seconds that files of a replaced version stay for readers that opened it
# The stored state of the bronze ingest.
STATE = ("watermark string, watermark_tie string, null_tie string, lastPipeline string, ds string, batch string, "
         "attempt string, sidecar string")
SIDECAR = ("batch_id string, collection string, partition string, record_count long, file_count long, "
           "total_size_bytes long, quality_status string, ingested_at string, source string")


@dataclass
class DayInputs:
    """Sources of one run: the student collection, the users, and the bronze course-event folder."""

    students: DataFrame
    users: DataFrame | None = None
    course_events_dir: str | None = None
    tie_col: str = "_id"
    carry_email: bool = False


def _paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    names = ["bronze/students", "bronze/_state/students", "bronze/_meta/students", "silver/students",
             "silver/quarantine", "silver/courses", "gold", "gold/_metrics", "silver/_metrics"]
    return {n: f"{r}/{n}" for n in names}


def _cursor_time(students: DataFrame) -> Column:
    """``updatedAt`` as a zone-less time: typed columns as they are, text parsed value by value."""
    if isinstance(students.schema["updatedAt"].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col("updatedAt").cast("timestamp_ntz")
    return parse_ts(unify_extended("updatedAt", "$date"))


def _cursor(state: DataFrame | None) -> Cursor:
    row = state.select("watermark", "watermark_tie", "null_tie").first() if state is not None else None
    return Cursor(*row) if row is not None else Cursor()


def read_cursor(spark: SparkSession, root: str) -> Cursor:
    """The stored bronze cursor; the empty cursor only where none was ever stored."""
    return _cursor(read_current(spark, _paths(root)["bronze/_state/students"]))


def unread(src: DataFrame, known: DataFrame | None) -> DataFrame:
    """``src`` without the undated documents whose key is in ``known``, the index of those ingested.

    An exact anti-join on the key: no order of ids is assumed, so a late id
    may be of any kind and size.  Dated rows pass by the join.
    """
    if known is None:
        return src
    dated, undated = src.filter(F.col("__wm").isNotNull()), src.filter(F.col("__wm").isNull())
    return dated.unionByName(undated.join(known.select(F.col("key").alias("__key")), "__key", "left_anti"))


def bronze_ingest(spark: SparkSession, inputs: DayInputs, ds: str, root: str, run_ts: str,
                  batch_size: int | None = None, batch_id: str | None = None) -> DataFrame:
    """Drain what was not ingested yet into the day's bronze partition, e-mails, stamps and checksums added.

    Dated documents are those after the stored cursor ``(updatedAt, tie)``;
    undated ones those that the index of undated keys does not hold (the tie,
    or a hash of the row where it has none).  One commit, or several of
    ``batch_size`` documents until none are left.

    Each commit is exactly once: the rows are written to a hidden folder;
    cursor, new index keys and the place of the rows are then committed as
    one pointer, which only one of several runs from the same cursor can
    create (``CommitConflict`` for the others); then the files are shown and
    the side-car written.  A run killed before the pointer leaves nothing that
    a reader sees, one killed after it is completed by the next run
    (:func:`finish_ingest`).  The batch id follows from the cursor, so a
    repeat has the same one.  An empty run has a side-car, too.  Returns the
    rows of this run.
    """
    p = _paths(root)
    finish_ingest(spark, root)
    ingested_at = iso_z(F.lit(run_ts).cast("timestamp"), 6)
    src = inputs.students.withColumn("__wm", _cursor_time(inputs.students))
    src = src.withColumn("__tie", F.col(inputs.tie_col).cast("string"))
    row = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*inputs.students.columns)), 256))
    src = src.withColumn("__key", F.coalesce("__tie", row))
    names, more = [], True
    while more:
        with Commit(spark, p["bronze/_state/students"], keep_s=KEEP_S) as commit:
            cursor = _cursor(commit.read())
            fresh = incremental_scan(unread(src, commit.read("undated")), "__wm", cursor.watermark, tie="__tie",
                                     limit=batch_size, tie_wm=cursor.tie, nulls=True)
            with scratch_copy(fresh, "bronze_batch") as batch:
                moved, n = advance(batch, "__wm", "__tie", cursor)
                if n == 0 and names:
                    break
                identity = f"students|{commit.number}|{cursor.watermark}|{cursor.tie}" + ("" if n else f"|empty|{ds}|{run_ts}")
                name = f"{batch_id}-{len(names):06d}" if batch_id else str(uuid.uuid5(uuid.NAMESPACE_OID, identity))
                names.append(name)
                docs = normalize_documents(batch.drop("__wm", "__tie", "__key"))
                if inputs.users is not None:
                    docs = lookup_email(docs, inputs.users)
                stamped = stamp_bronze(docs, name, "students", ds, ingested_at).withColumn("_checksum", row_checksum(docs.columns))
                if not n:
                    sidecar = batch_sidecar(batch, "students", ds, name, _stamp(run_ts))
                    write_json_record(sidecar, f"{p['bronze/_meta/students']}/ds={ds}/batch={name}")
                    break
                attempt = f"_partition_key={ds}/_attempt-{name}-{uuid.uuid4().hex}"
                write_layer(stamped.drop("_partition_key"), f"{p['bronze/students']}/{attempt}")
                sidecar = batch_sidecar(batch, "students", ds, name, _stamp(run_ts), list_files(spark, f"{p['bronze/students']}/{attempt}"))
                state = (*moved, run_ts, ds, name, attempt, sidecar.select(F.to_json(F.struct("*"))).first()[0])
                commit.overwrite(spark.createDataFrame([state], STATE), exclusive=True)
                keys = batch.filter(F.col("__wm").isNull()).select(F.col("__key").alias("key")).distinct()
                commit.upsert(keys, ["key"], table="undated")
                more = batch_size is not None and n == batch_size
                commit.publish()
        finish_ingest(spark, root)
    if not table_exists(spark, p["bronze/students"]):
        return empty_like(stamped)
    written = read_partition(spark, p["bronze/students"], "_partition_key", ds, schema=stamped.schema)
    return written.filter(F.col("_batch_id").isin(names))


def _stamp(run_ts: str) -> str:
    return run_ts.replace(" ", "T") + "Z"


def finish_ingest(spark: SparkSession, root: str) -> None:
    """Complete the last committed batch: show its rows, write its side-car, clear what other attempts at it left.

    Does nothing where that is done, and goes on where it was cut short: each
    file is moved once.  Attempts from the same cursor cannot be committed any
    more, so their folders go, whatever day they were for.
    """
    p = _paths(root)
    state = read_current(spark, p["bronze/_state/students"])
    row = state.first() if state is not None else None
    if row is None:
        return
    base, meta = p["bronze/students"], p["bronze/_meta/students"]
    sidecar = f"{meta}/ds={row['ds']}/batch={row['batch']}"
    fs, hidden = hadoop_path(spark, f"{base}/{row['attempt']}")
    if fs.exists(hidden):
        for f in fs.listStatus(hidden):
            if f.getPath().getName().startswith("part-"):
                fs.rename(f.getPath(), hidden.getParent())
        fs.delete(hidden, True)
    elif table_exists(spark, f"{sidecar}/_SUCCESS"):
        return
    own = hadoop_path(spark, sidecar)[1].toUri().getPath()
    for pattern in (f"{base}/_partition_key=*/_attempt-{row['batch']}-*", f"{meta}/ds=*/batch={row['batch']}"):
        for s in fs.globStatus(hadoop_path(spark, pattern)[1]) or []:
            if s.getPath().toUri().getPath() != own:
                fs.delete(s.getPath(), True)
    write_json_record(spark.range(1).select(F.from_json(F.lit(row["sidecar"]), SIDECAR).alias("s")).select("s.*"), sidecar)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def silver_day(spark: SparkSession, ds: str, root: str, run_ts: str, course_events_dir: str | None = None,
               carry_email: bool = False) -> DataFrame:
    """Bronze partition of ``ds`` -> silver clean and quarantine (replaced); course events of ``ds`` -> silver courses.

    Writes and returns the day's silver metrics.  A layer that has no rows for
    the day any more is cleared.
    """
    p = _paths(root)
    finish_ingest(spark, root)
    bronze = read_partition(spark, p["bronze/students"], "_partition_key", ds)
    require_rows(bronze, f"bronze students {ds}")
    std = standardize_students(bronze, run_ts, str(uuid.uuid4()),
                               carry_email=carry_email and "email" in bronze.columns)
    clean, quarantine = split_clean_quarantine(std, f"{p['bronze/students']}/_partition_key={ds}", run_ts)
    replace_partition(clean, p["silver/students"], "_partition_key", [ds])
    replace_partition(quarantine, p["silver/quarantine"], "_partition_key", [ds])
    if course_events_dir:
        ev = spark.read.schema("event_id string, event_time string, course_id string, course_name string, "
                               "title string, event_type string, created_at string, updated_at string, "
                               "_topic string, _partition int, _offset long, _ingested_at string, "
                               "ingest_date string").json(course_events_dir)
        day = ev.filter(F.col("ingest_date") == ds)
        replace_partition(standardize_courses(day.withColumnRenamed("ingest_date", "ingest_ds"), "ingest_ds"),
                          p["silver/courses"], "ingest_ds", [ds])

    def count(name: str, part: str) -> DataFrame | None:
        if not table_exists(spark, f"{p[name]}/{part}={ds}"):
            return None
        return read_partition(spark, p[name], part, ds)
    metrics = silver_day_metrics(spark, ds, count("silver/students", "_partition_key"),
                                 count("silver/quarantine", "_partition_key"), count("silver/courses", "ingest_ds"))
    metrics = metrics.withColumn("generated_at", F.lit(run_ts))
    write_json_record(metrics, f"{p['silver/_metrics']}/ds={ds}")
    return metrics


def gold_day(spark: SparkSession, ds: str, root: str, as_of: str, run_ts: str) -> dict:
    """Silver of ``ds`` -> dimensions (upsert) and the day's fact / mart partitions (replace); metrics.

    All tables change by one commit: a reader sees the day before or after,
    never half of it.  Primary keys are checked before the commit.  Should
    another run number new students at the same time, the day is done again
    on its result.
    """
    for attempt in range(5):
        try:
            return _gold_day(spark, ds, root, as_of, run_ts)
        except CommitConflict:
            if attempt == 4:
                raise
    raise AssertionError("unreachable")


def _gold_day(spark: SparkSession, ds: str, root: str, as_of: str, run_ts: str) -> dict:
    p = _paths(root)
    silver = read_partition(spark, p["silver/students"], "_partition_key", ds)
    require_rows(silver, f"silver students {ds}")
    key = int(ds.replace("-", ""))
    with Commit(spark, p["gold"], keep_s=KEEP_S) as c:
        def dim(name: str, rows: DataFrame) -> None:
            c.upsert(conform(rows, name), KEYS[name], table=name)

        def day(name: str, rows: DataFrame) -> DataFrame:
            c.replace(conform(rows, name), "date_key", [key], table=name, keys=KEYS[name])
            return c.read(name, parts=[key])

        dim("dim_date", G.dim_date(silver))
        dim("dim_city", G.dim_city(silver, run_ts))
        if table_exists(spark, f"{p['silver/courses']}/ingest_ds={ds}"):
            dim("dim_course", G.dim_course(read_partition(spark, p["silver/courses"], "ingest_ds", ds), run_ts))
        dim("dim_student", G.dim_student(silver, run_ts))
        fact = day("fact_student_daily", G.fact_student_daily(silver, run_ts))
        mv = day("mv_paid_students_daily", G.mv_paid_students_daily(fact, run_ts))
        enrol = day("fact_course_enrollment_event", G.fact_course_enrollment_event(silver, as_of, run_ts))
        courses = c.read("dim_course")
        courses = empty_table(spark, "dim_course") if courses is None else courses
        day("mv_course_enrollment_region_daily", G.mv_course_enrollment_region_daily(enrol, c.read("dim_city"), courses, run_ts))
        known = c.read("student_number")
        first = 1 + ((known.agg(F.max("number")).first()[0] or 0) if known is not None else 0)
        c.upsert(conform(G.student_numbers(enrol, known, first), "student_number"), ["student_id"], table="student_number", exclusive=True)
        day("mv_course_students_bitmap", G.mv_course_students_bitmap(enrol, c.read("student_number"), c.read("dim_city"), courses))
    metrics = kpi.run_metrics(fact, mv, enrol).withColumn("ds", F.lit(ds))
    write_json_record(metrics, f"{p['gold/_metrics']}/ds={ds}")
    row = metrics.first()
    return row.asDict() if row is not None else {"ds": ds}


def run_day(spark: SparkSession, ds: str, root: str, inputs: DayInputs, as_of: str, run_ts: str,
            batch_size: int | None = None) -> dict:
    """Bronze ingest, silver and gold for one day; returns the gold run metrics."""
    prepare_session(spark)
    bronze_ingest(spark, inputs, ds, root, run_ts, batch_size)
    silver_day(spark, ds, root, run_ts, inputs.course_events_dir, inputs.carry_email)
    return gold_day(spark, ds, root, as_of, run_ts)


def read_fact(spark: SparkSession, root: str, name: str, days: Sequence[int] | None = None) -> DataFrame:
    """A stored fact or mart with its fixed schema; empty where it was never written, any other failure raises.

    ``days`` (date keys) are picked from the commit's partition list: no other folder is listed.
    """
    df = read_current(spark, _paths(root)["gold"], schema(name), name, days)
    return empty_table(spark, name) if df is None else df


def stored_days(spark: SparkSession, root: str, name: str) -> list[int]:
    """Date keys of a stored fact or mart, from the newest commit's partition list."""
    return [int(d) for d in partitions(spark, _paths(root)["gold"], name)]


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored gold tables, all as one commit left them.

    Tables never written are left out; a table that cannot be read raises.
    """
    return read_tables(spark, _paths(root)["gold"], {n: schema(n) for n in KEYS})
