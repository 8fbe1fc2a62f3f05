"""Fixed table schemas of the layers, and the conform step that enforces them (SNK-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The typed layout of every gold and silver table.
DDL = {
    "dim_date": "date_key INT, date_value DATE, year INT, month INT, day INT, day_of_week INT, week_of_year INT",
    "dim_city": "city_key STRING, city_name STRING, region_name STRING, city_normalized STRING, created_at TIMESTAMP_NTZ",
    "dim_student": ("student_key STRING, student_id STRING, account_id STRING, full_name STRING, email STRING, "
                    "phone_number STRING, city_key STRING, city_name STRING, region_name STRING, education_level STRING, "
                    "account_status STRING, is_contacted BOOLEAN, is_paid_student BOOLEAN, enrolled_courses_count INT, "
                    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, processed_at TIMESTAMP_NTZ, "
                    "source_batch_id STRING, last_partition_key STRING, is_active BOOLEAN, load_ts TIMESTAMP_NTZ"),
    "dim_course": "course_key STRING, course_id STRING, course_name STRING, created_at TIMESTAMP_NTZ",
    "fact_student_daily": ("date_key INT, city_key STRING, student_total_count BIGINT, student_paid_count BIGINT, "
                           "paid_rate DOUBLE, load_ts TIMESTAMP_NTZ"),
    "mv_paid_students_daily": ("date_key INT, city_key STRING, student_total_count BIGINT, student_paid_count BIGINT, "
                               "paid_rate DOUBLE, refreshed_at TIMESTAMP_NTZ"),
    "fact_course_enrollment_event": ("event_id STRING, date_key INT, event_time TIMESTAMP_NTZ, student_key STRING, "
                                     "student_id STRING, city_key STRING, course_key STRING, course_id STRING, "
                                     "access_type STRING, end_at TIMESTAMP_NTZ, load_ts TIMESTAMP_NTZ, is_active BOOLEAN"),
    "mv_course_enrollment_region_daily": ("date_key INT, region_name STRING, course_key STRING, course_name STRING, "
                                          "enrolled_students_count BIGINT, refreshed_at TIMESTAMP_NTZ"),
    "student_number": "student_id STRING, number BIGINT",
    "mv_course_students_bitmap": ("date_key INT, region_name STRING, course_key STRING, course_name STRING, bucket BIGINT, "
                                  "students BINARY"),
    "silver_courses": "course_id STRING, course_name STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "quarantine": ("raw_payload STRING, quarantine_reason STRING, source_table STRING, bronze_file_path STRING, "
                   "quarantined_at TIMESTAMP_NTZ"),
}

# The primary key of every gold table, checked when it is written.
KEYS = {
    "dim_date": ["date_key"], "dim_city": ["city_key"], "dim_student": ["student_key"], "dim_course": ["course_key"],
    "fact_student_daily": ["date_key", "city_key"], "mv_paid_students_daily": ["date_key", "city_key"],
    "fact_course_enrollment_event": ["date_key", "event_id"],
    "mv_course_enrollment_region_daily": ["date_key", "region_name", "course_key"],
    "student_number": ["student_id"],
    "mv_course_students_bitmap": ["date_key", "region_name", "course_key", "bucket"],
}


def schema(name: str) -> T.StructType:
    """The fixed ``StructType`` of a table."""
    return T.StructType.fromDDL(DDL[name])


def conform(df: DataFrame, name: str, keep_extra: tuple[str, ...] = ()) -> DataFrame:
    """Select the table's columns in order, cast to their types; missing columns become typed NULLs.

    ``keep_extra`` columns (e.g. a partition column) are appended unchanged.
    """
    cols = []
    for field in schema(name).fields:
        src = F.col(field.name) if field.name in df.columns else F.lit(None)
        cols.append(src.cast(field.dataType).alias(field.name))
    return df.select(*cols, *[F.col(c) for c in keep_extra if c in df.columns])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A typed empty DataFrame of the table (bootstrap before the first load)."""
    return spark.createDataFrame([], schema(name))
