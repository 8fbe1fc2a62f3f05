"""Gold layer: star schema (dates, cities, courses, students) and daily facts.

Every builder works on *all* day slices at once: the slice is a column
(``date_key``), so a back-fill of many days is one job, partitioned by the
day, instead of a driver loop.  Restricting the input to one slice gives
the daily run (see ``orelake.plans.daily``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.functions import (city_normalized, city_part, date_key, event_key,
                               parse_ts, region_part, surrogate_key)
from orelake.operators import latest_by_key

# Alternative keys of one enrolment element, in priority order.
COURSE_ID_KEYS = ["courseId", "course_id", "id", "_id"]
ENROLLED_AT_KEYS = ["enrolledAt", "enrolled_at", "createdAt", "created_at"]
END_AT_KEYS = ["endAt", "end_at", "expiresAt", "expires_at"]
ACCESS_TYPE_KEYS = ["accessType", "access_type", "type"]
# Every alias as a text field: one JSON parse per element reads them all
# (a number or object value arrives as its JSON text, like a path lookup).
ELEMENT_SCHEMA = "struct<" + ", ".join(
    f"`{k}`: string" for k in COURSE_ID_KEYS + ENROLLED_AT_KEYS + END_AT_KEYS + ACCESS_TYPE_KEYS) + ">"


def _ts(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast("timestamp_ntz")


def with_date_key(silver: DataFrame, slice_col: str = "_partition_key") -> DataFrame:
    """Add the integer day key of each row's slice."""
    return silver.withColumn("date_key", date_key(F.to_date(F.col(slice_col))))


def dim_date(slices: DataFrame, slice_col: str = "_partition_key") -> DataFrame:
    """One row per day slice: key, date and its parts (Sunday = 0, ISO week)."""
    d = slices.select(F.to_date(F.col(slice_col)).alias("date_value")).distinct()
    return d.select(
        date_key("date_value").alias("date_key"), "date_value",
        F.year("date_value").alias("year"), F.month("date_value").alias("month"),
        F.dayofmonth("date_value").alias("day"),
        (F.dayofweek("date_value") - 1).alias("day_of_week"),
        F.weekofyear("date_value").alias("week_of_year"))


def dim_city(silver: DataFrame, run_ts) -> DataFrame:
    """Distinct normalised cities with md5 key, city and region parts."""
    norm = silver.select(city_normalized("city").alias("city_normalized")).distinct()
    return norm.select(
        F.md5("city_normalized").alias("city_key"),
        city_part("city_normalized").alias("city_name"),
        region_part("city_normalized").alias("region_name"),
        "city_normalized",
        _ts(run_ts).alias("created_at"))


def dim_course(silver_courses: DataFrame, run_ts, order: tuple[str, ...] = ("ingest_ds",),
               unique: bool = False) -> DataFrame:
    """One row per course id; a later slice replaces an earlier one (upsert by key).

    ``unique=True``: the input already holds one row per course.
    """
    latest = silver_courses if unique else latest_by_key(
        silver_courses, ["course_id"], list(order) + ["updated_at", "course_name"])
    return latest.select(
        surrogate_key("course_id").alias("course_key"), "course_id",
        F.coalesce("course_name", F.lit("UNKNOWN")).alias("course_name"),
        _ts(run_ts).alias("created_at"))


def dim_student(silver: DataFrame, run_ts) -> DataFrame:
    """Type-1 student dimension: the newest row per student over all slices.

    Later slices replace earlier ones; inside a slice the newest
    ``updated_at`` wins, then ``processed_at``, then the batch id.
    E-mail stays NULL (personal data is kept in bronze) unless silver
    carries it (``carry_email`` in the silver step).
    """
    latest = latest_by_key(silver, ["entity_id"],
                           ["_partition_key", "updated_at", "processed_at", "bronze_batch_id"])
    norm = city_normalized("city")
    return latest.select(
        surrogate_key("entity_id").alias("student_key"),
        F.col("entity_id").cast("string").alias("student_id"),
        F.col("account_id").cast("string").alias("account_id"),
        F.col("full_name").cast("string").alias("full_name"),
        (F.col("email").cast("string") if "email" in silver.columns else F.lit(None).cast("string")).alias("email"),
        F.col("phone_number").cast("string").alias("phone_number"),
        F.md5(norm).alias("city_key"),
        city_part(norm).alias("city_name"),
        region_part(norm).alias("region_name"),
        F.col("education_level").cast("string").alias("education_level"),
        F.col("account_status").cast("string").alias("account_status"),
        F.coalesce(F.col("is_contacted").cast("boolean"), F.lit(False)).alias("is_contacted"),
        F.coalesce(F.col("is_paid_student").cast("boolean"), F.lit(False)).alias("is_paid_student"),
        F.coalesce(F.col("enrolled_courses_count").cast("int"), F.lit(0)).alias("enrolled_courses_count"),
        _ts(F.col("created_at")).alias("created_at"),
        _ts(F.col("updated_at")).alias("updated_at"),
        _ts(F.col("processed_at")).alias("processed_at"),
        F.col("bronze_batch_id").cast("string").alias("source_batch_id"),
        F.col("_partition_key").cast("string").alias("last_partition_key"),
        (F.lower(F.coalesce("account_status", F.lit(""))) == "active").alias("is_active"),
        _ts(run_ts).alias("load_ts"))


def fact_student_daily(silver: DataFrame, run_ts) -> DataFrame:
    """Students, paid students and paid rate per (day, city).

    ``groupBy`` with partial aggregation: each task pre-aggregates its
    rows, so only (day, city) partial sums cross the shuffle.
    """
    paid = F.when(F.coalesce(F.col("is_paid_student"), F.lit(False)), 1).otherwise(0)
    agg = with_date_key(silver).groupBy("date_key", F.md5(city_normalized("city")).alias("city_key")).agg(
        F.count(F.lit(1)).alias("student_total_count"),
        F.sum(paid).cast("long").alias("student_paid_count"))
    return agg.select(
        "date_key", "city_key", "student_total_count", "student_paid_count",
        F.when(F.col("student_total_count") == 0, F.lit(0.0))
         .otherwise(F.col("student_paid_count").cast("double") / F.col("student_total_count").cast("double"))
         .alias("paid_rate"),
        _ts(run_ts).alias("load_ts"))


def mv_paid_students_daily(fact: DataFrame, refreshed_at) -> DataFrame:
    """Reporting copy of the daily fact."""
    return fact.select("date_key", "city_key", "student_total_count", "student_paid_count", "paid_rate",
                       _ts(refreshed_at).alias("refreshed_at"))


def fact_course_enrollment_event(silver: DataFrame, as_of, run_ts, dedupe: bool = True) -> DataFrame:
    """One row per (day, enrolment) from the students' enrolment lists.

    The list is exploded (inner: empty or missing lists give no rows); each
    element's fields are read through their alias keys.  The key is
    ``md5(student|course|time)``, unique per day (a repeat inside one day
    keeps the element that expires last).  ``is_active`` compares the end
    time with the explicit ``as_of`` instant, so results are repeatable.

    ``dedupe=False`` leaves repeated keys in (for consumers that count
    distinct students, where a repeat can never change the result).
    """
    keyed = with_date_key(silver).select(
        "_partition_key", "entity_id", "date_key", F.md5(city_normalized("city")).alias("city_key"),
        F.explode(F.transform("enrolled_courses", lambda x: F.from_json(x, ELEMENT_SCHEMA))).alias("e"))
    first = lambda keys: F.coalesce(*[F.col(f"e.{k}") for k in keys])
    norm = keyed.select(
        "_partition_key", "entity_id", "date_key", "city_key",
        F.nullif(F.trim(first(COURSE_ID_KEYS)), F.lit("")).alias("course_id"),
        parse_ts(first(ENROLLED_AT_KEYS)).alias("event_time"),
        parse_ts(first(END_AT_KEYS)).alias("end_at"),
        F.nullif(F.trim(first(ACCESS_TYPE_KEYS)), F.lit("")).alias("access_type"),
    ).filter(F.col("course_id").isNotNull() & (F.col("course_id") != ""))
    events = norm.select(
        "_partition_key", "entity_id",
        event_key("entity_id", "course_id", "event_time", "date_key").alias("event_id"),
        "date_key", "event_time", surrogate_key("entity_id").alias("student_key"),
        F.col("entity_id").alias("student_id"),
        "city_key", surrogate_key("course_id").alias("course_key"), "course_id", "access_type", "end_at",
        _ts(run_ts).alias("load_ts"),
        (F.col("end_at").isNull() | (F.col("end_at") >= _ts(as_of))).alias("is_active"))
    # The key holds the student, and silver has one row per (slice, student): repeats of an
    # enrolment key come from one document.  Keying the de-duplication by (slice, student,
    # event) is therefore the same as by (day, event), and silver's own partitioning on
    # (slice, student) already satisfies it: no extra shuffle when silver is computed inline.
    if not dedupe:
        return events.drop("_partition_key", "entity_id")
    unique = latest_by_key(events, ["_partition_key", "entity_id", "event_id"], ["end_at", "access_type"])
    return unique.drop("_partition_key", "entity_id")


def mv_course_enrollment_region_daily(enrol: DataFrame, cities: DataFrame, courses: DataFrame,
                                      refreshed_at) -> DataFrame:
    """Distinct students per (day, region, course).

    Both dimensions are left-joined (a missing one reads ``UNKNOWN``); AQE
    broadcasts them when their measured size is small and keeps a shuffle
    join otherwise.  ``count(distinct)`` first groups by (keys, student),
    so a hot course is spread over the student ids before the final count.
    """
    e = enrol.select("date_key", "city_key", "course_key", "student_id")
    j = (e.join(cities.select("city_key", "region_name"), "city_key", "left")
          .join(courses.select("course_key", "course_name"), "course_key", "left"))
    agg = j.groupBy("date_key", F.coalesce("region_name", F.lit("UNKNOWN")).alias("region_name"),
                    "course_key", F.coalesce("course_name", F.lit("UNKNOWN")).alias("course_name")).agg(
        F.countDistinct("student_id").alias("enrolled_students_count"))
    return agg.withColumn("refreshed_at", _ts(refreshed_at))


def student_numbers(ids: DataFrame, known: DataFrame | None = None, first: int = 1, buckets: int = 1024) -> DataFrame:
    """(student_id, number) of the ``student_id`` values of ``ids`` that ``known`` does not hold: dense numbers from ``first``.

    Numbers follow (hash bucket, id): each bucket is numbered by itself and
    starts after the ``buckets`` at most totals before it, so no task sees all
    ids and a repeated run gives the same numbers.
    """
    new = ids.filter(F.col("student_id").isNotNull()).select("student_id").distinct()
    if known is not None:
        new = new.join(known.select("student_id"), "student_id", "left_anti")
    new = new.withColumn("bucket", F.pmod(F.xxhash64("student_id"), F.lit(buckets)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = new.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("student_id"))
    return (new.withColumn("rank", rank).join(F.broadcast(start), "bucket")
            .select("student_id", (F.col("start") + F.col("rank") + F.lit(first - 1)).cast("long").alias("number")))


def mv_course_students_bitmap(enrol: DataFrame, numbers: DataFrame, cities: DataFrame, courses: DataFrame) -> DataFrame:
    """The students of each (day, region, course) as bitmaps of their numbers, one row per 32,768 numbers met.

    Bitmaps of any days, regions or courses merge exactly (bitwise or), which
    distinct counts do not, so wider counts need neither the events nor a
    second pass over the students.  A bitmap holds only its words that have
    bits (see :func:`bitmap_words`): most have one student, and a plain one
    would take 4 KB for it in every task, shuffle and sort.
    """
    e = enrol.select("date_key", "city_key", "course_key", "student_id").join(numbers, "student_id")
    j = (e.join(cities.select("city_key", "region_name"), "city_key", "left")
          .join(courses.select("course_key", "course_name"), "course_key", "left"))
    at = F.bitmap_bit_position("number").cast("int")
    keys = ["date_key", "region_name", "course_key", "course_name", "bucket"]
    bits = j.select("date_key", F.coalesce("region_name", F.lit("UNKNOWN")).alias("region_name"), "course_key",
                    F.coalesce("course_name", F.lit("UNKNOWN")).alias("course_name"),
                    F.bitmap_bucket_number("number").alias("bucket"), F.shiftright(at, 6).alias("word"),
                    F.expr("shiftleft(1L, 56 - 8 * (CAST(bitmap_bit_position(number) AS INT) % 64 DIV 8)"
                           " + CAST(bitmap_bit_position(number) AS INT) % 8)").alias("bits"))
    words = bits.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
    text = F.concat(F.lpad(F.hex("word"), 4, "0"), F.lpad(F.hex("bits"), 16, "0"))
    return words.groupBy(*keys).agg(F.unhex(F.array_join(F.array_sort(F.collect_list(text)), "")).alias("students"))


def bitmap_words(bitmaps: DataFrame, *columns: Column | str) -> DataFrame:
    """One row per word with bits of each bitmap ``students``: ``columns``, then word, bits.

    A bitmap is a run of ten bytes a word: its number in two, then the eight
    bytes of the plain bitmap (as ``bitmap_construct_agg`` makes them).  One of
    4,096 bytes is plain; earlier versions stored these.
    """
    def number(at: str, size: int) -> str:
        return f"CAST(conv(hex(substring(students, {at}, {size})), 16, -10) AS BIGINT)"
    plain = "octet_length(students) = 4096"
    at = F.explode(F.expr(f"sequence(0, IF({plain}, 512, octet_length(students) DIV 10) - 1)"))
    parts = bitmaps.select(*columns, "students", at.alias("at"))
    names = [c for c in parts.columns if c not in ("students", "at")]
    return parts.select(*names, F.expr(f"IF({plain}, at, {number('10 * at + 1', 2)})").alias("word"),
                        F.expr(f"IF({plain}, {number('8 * at + 1', 8)}, {number('10 * at + 3', 8)})").alias("bits")).filter("bits != 0")
