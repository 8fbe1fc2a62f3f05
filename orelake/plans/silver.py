"""Silver layer: standardisation, clean / quarantine split, course events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions import (capitalize_first, digits_only, nested_to_list, parse_ts,
                               py_strip, title_case, truthy)
from orelake.operators import latest_by_key

# Output columns of the silver student table, in order.
SILVER_STUDENT_COLUMNS = [
    "entity_id", "account_id", "full_name", "phone_number", "city", "education_level",
    "account_status", "technique", "is_contacted", "enrolled_courses", "enrolled_courses_count",
    "is_paid_student", "enrolled_chapters", "bought_books", "created_at", "updated_at",
    "bronze_batch_id", "silver_batch_id", "processed_at", "_operation", "_source", "_table_name",
    "_partition_key", "_checksum",
]
QUARANTINE_COLUMNS = ["raw_payload", "quarantine_reason", "source_table", "bronze_file_path", "quarantined_at"]
# The hard-fail checks, in reporting order.
QUALITY_CHECKS = ["missing_pk", "bad_created_at", "bad_updated_at"]


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def col_or_default(df: DataFrame, name: str, default=None, dtype: str = "string") -> Column:
    """The column when present, else a typed default."""
    return F.col(name) if name in df.columns else F.lit(default).cast(dtype)


def standardize_students(bronze: DataFrame, run_ts, silver_batch_id, table_name: str = "students",
                         carry_email: bool = False) -> DataFrame:
    """Bronze student rows -> standardised columns (no rows dropped).

    Keeps ``_ingested_ts`` (parsed ingest time) for the de-duplication order.
    The looked-up e-mail stays in bronze unless ``carry_email`` is set.
    """
    g = lambda n, d=None, t="string": col_or_default(bronze, n, d, t)
    ingested = parse_ts(g("_ingested_at"))
    created = F.coalesce(parse_ts(g("createdAt")), ingested)
    updated = F.coalesce(parse_ts(g("updatedAt")), created, ingested)
    courses = nested_to_list(g("enrolledCourses"))
    count = F.coalesce(F.size(courses), F.lit(0))
    return bronze.select(
        g("_id").cast("string").alias("entity_id"),
        g("userId").cast("string").alias("account_id"),
        title_case(py_strip(g("name"))).alias("full_name"),
        digits_only(g("phone")).alias("phone_number"),
        py_strip(capitalize_first(g("city"))).alias("city"),
        g("educationLevel").cast("string").alias("education_level"),
        py_strip(F.lower(g("status"))).alias("account_status"),
        g("technique").cast("string").alias("technique"),
        truthy(g("isContacted")).alias("is_contacted"),
        courses.alias("enrolled_courses"),
        count.alias("enrolled_courses_count"),
        (count > 0).alias("is_paid_student"),
        nested_to_list(g("enrolledChapters")).alias("enrolled_chapters"),
        nested_to_list(g("boughtBooks")).alias("bought_books"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        g("_batch_id").alias("bronze_batch_id"),
        _lit(silver_batch_id).cast("string").alias("silver_batch_id"),
        _lit(run_ts).cast("timestamp_ntz").alias("processed_at"),
        g("_operation").alias("_operation"),
        g("_source").alias("_source"),
        F.lit(table_name).alias("_table_name"),
        g("_partition_key").alias("_partition_key"),
        g("_checksum").alias("_checksum"),
        ingested.alias("_ingested_ts"),
        *([py_strip(g("email")).alias("email")] if carry_email else []),
    )


def quality_checks(std: DataFrame) -> dict[str, Column]:
    """The hard-fail predicates of one standardised row."""
    return {
        "missing_pk": F.col("entity_id").isNull() | (py_strip(F.col("entity_id")) == ""),
        "bad_created_at": F.col("created_at").isNull(),
        "bad_updated_at": F.col("updated_at").isNull(),
    }


def split_clean_quarantine(std: DataFrame, bronze_file_path, run_ts,
                           slice_cols: tuple[str, ...] = ("_partition_key",)) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): any failed check sends the row to quarantine.

    Clean rows are de-duplicated per slice and entity: newest ``updated_at``,
    then newest ingest, then the larger bronze batch id (a total order).
    Quarantine rows keep the whole row as JSON, the failed check names, and
    the lineage of the file they came from.

    Plan note: the check is folded into the de-duplication order (passing
    rows first) and filtered after the window.  A plain filter before the
    window would be pushed down to the scan with every parsing expression
    copied into it; this way each row is parsed once, after the shuffle.
    """
    checks = quality_checks(std)
    bad = F.lit(False)
    for c in checks.values():
        bad = bad | c
    flagged = std.withColumn("__bad", bad)
    best = latest_by_key(flagged, [*slice_cols, "entity_id"],
                         [F.col("__bad").asc(), "updated_at", "_ingested_ts", "bronze_batch_id"])
    extra = ["email"] if "email" in std.columns else []
    clean = best.filter(~F.col("__bad")).select(*SILVER_STUDENT_COLUMNS, *extra)
    reason = F.concat_ws(",", *[F.when(checks[name], F.lit(name)) for name in QUALITY_CHECKS])
    payload_cols = [c for c in std.columns if c != "_ingested_ts"]
    quarantine = flagged.filter(F.col("__bad")).select(
        F.to_json(F.struct(*payload_cols), {"ignoreNullFields": "false"}).alias("raw_payload"),
        reason.alias("quarantine_reason"),
        F.col("_table_name").alias("source_table"),
        _lit(bronze_file_path).cast("string").alias("bronze_file_path"),
        _lit(run_ts).cast("timestamp_ntz").alias("quarantined_at"),
        *[F.col(c) for c in slice_cols],
    )
    return clean, quarantine


def run_counts(std: DataFrame, slice_cols: tuple[str, ...] = ("_partition_key",)) -> DataFrame:
    """Clean and quarantined rows per slice, in one pass over the standardised rows.

    A slice's clean rows are its distinct entities with a passing row, so two
    aggregates with partial sums replace the de-duplication window.
    """
    bad = F.lit(False)
    for c in quality_checks(std).values():
        bad = bad | c
    each = std.groupBy(*slice_cols, "entity_id").agg(
        F.max(F.when(bad, 0).otherwise(1)).alias("clean"), F.sum(F.when(bad, 1).otherwise(0)).alias("bad"))
    return each.groupBy(*slice_cols).agg(F.sum("clean").cast("long").alias("students_clean_count"),
                                         F.sum("bad").cast("long").alias("students_quarantine_count"))


def silver_metrics(students: DataFrame, courses: DataFrame) -> DataFrame:
    """Run metrics per day: clean / quarantined students, clean courses, totals (AGG-11, SNK-13).

    ``students``: ds and the counts of :func:`run_counts`; ``courses``: ds and courses_clean_count.
    """
    names = ["students_clean_count", "students_quarantine_count", "courses_clean_count"]
    both = students.unionByName(courses, allowMissingColumns=True)
    agg = both.groupBy("ds").agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
    return agg.select("ds", *names,
                      (F.col("students_clean_count") + F.col("courses_clean_count")).alias("total_clean_count"),
                      F.col("students_quarantine_count").alias("total_quarantine_count"))


def silver_day_metrics(spark: SparkSession, ds: str, clean: DataFrame | None, quarantine: DataFrame | None,
                       courses: DataFrame | None) -> DataFrame:
    """The metrics of one day from its written layers; a layer not written counts 0."""
    def rows(df: DataFrame | None, name: str) -> DataFrame:
        n = spark.range(0) if df is None else df
        return n.agg(F.count(F.lit(1)).alias(name)).select(F.lit(ds).alias("ds"), name)
    students = rows(clean, "students_clean_count").unionByName(
        rows(quarantine, "students_quarantine_count"), allowMissingColumns=True)
    return silver_metrics(students, rows(courses, "courses_clean_count"))


def course_rows(events: DataFrame, slice_col: str | None = None) -> DataFrame:
    """Bronze course events with typed columns and their delivery order; rows without an id are dropped.

    Id from ``course_id`` else ``_id``; name from ``course_name``, ``title``
    or ``name``.
    """
    g = lambda n: col_or_default(events, n)
    cid = F.nullif(py_strip(F.coalesce(g("course_id"), g("_id"))), F.lit(""))
    name = py_strip(F.coalesce(g("course_name"), g("title"), g("name")))
    cols = [cid.alias("course_id"), name.alias("course_name"),
            parse_ts(F.coalesce(g("created_at"), g("createdAt"))).alias("created_at"),
            parse_ts(F.coalesce(g("updated_at"), g("updatedAt"))).alias("updated_at"),
            parse_ts(g("_ingested_at")).alias("_ingested_ts"),
            col_or_default(events, "_offset", None, "long").alias("_offset")]
    return events.select(*cols, *([F.col(slice_col)] if slice_col else [])).filter(F.col("course_id").isNotNull())


def standardize_courses(events: DataFrame, slice_col: str | None = "ingest_ds", keep_order: bool = False) -> DataFrame:
    """Bronze course events -> one row per course (and slice): the last delivered wins.

    "Last" is the explicit delivery order ``(_ingested_at, _offset)``, as file
    order is not defined; ``keep_order`` leaves it in as ``_ingested_ts`` and
    ``_offset``.
    """
    keys = [slice_col, "course_id"] if slice_col else ["course_id"]
    out = latest_by_key(course_rows(events, slice_col), keys, ["_ingested_ts", "_offset"])
    return out if keep_order else out.drop("_ingested_ts", "_offset")
