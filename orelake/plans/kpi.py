"""Business KPIs over the gold tables.

Each function takes the gold DataFrames it needs and returns a DataFrame;
the latest-day filter, sort and top-k stay inside the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.functions import percent_text, region_key
from orelake.plans.gold import bitmap_words


def _pct(num: Column, den: Column) -> Column:
    """``100 * num / den`` in double, 0 when the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.lit(100.0) * num.cast("double") / den.cast("double"))


def daily_paid(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """KPI-1: students, paid, unpaid and paid % per day (weighted: sum / sum)."""
    j = fact.join(dates.select("date_key", "date_value"), "date_key")
    agg = j.groupBy("date_value").agg(F.sum("student_total_count").cast("long").alias("total_students"),
                                      F.sum("student_paid_count").cast("long").alias("paid_students"))
    return agg.select(
        "date_value", "total_students", "paid_students",
        (F.col("total_students") - F.col("paid_students")).alias("unpaid_students"),
        _pct(F.col("paid_students"), F.col("total_students")).alias("paid_rate_pct")).orderBy("date_value")


def region_daily_paid(fact: DataFrame, dates: DataFrame, cities: DataFrame) -> DataFrame:
    """KPI-2: students, paid and paid % per (day, region)."""
    j = (fact.join(dates.select("date_key", "date_value"), "date_key")
             .join(cities.select("city_key", "region_name"), "city_key"))
    agg = j.groupBy("date_value", "region_name").agg(
        F.sum("student_total_count").cast("long").alias("total_students"),
        F.sum("student_paid_count").cast("long").alias("paid_students"))
    return agg.select("date_value", "region_name", "total_students", "paid_students",
                      _pct(F.col("paid_students"), F.col("total_students")).alias("paid_rate_pct")
                      ).orderBy("date_value", "region_name")


def unpaid_region_daily(fact: DataFrame, dates: DataFrame, cities: DataFrame) -> DataFrame:
    """KPI-11: paid and unpaid counts and rates per (day, region)."""
    r = region_daily_paid(fact, dates, cities)
    unpaid = F.col("total_students") - F.col("paid_students")
    return r.select("date_value", "region_name", "total_students", "paid_students",
                    unpaid.alias("unpaid_students"), "paid_rate_pct",
                    _pct(unpaid, F.col("total_students")).alias("unpaid_rate_pct"))


def course_enrollment(mart: DataFrame, dates: DataFrame) -> DataFrame:
    """KPI-3: enrolled students per (day, region, course), busiest first within a day."""
    j = mart.join(dates.select("date_key", "date_value"), "date_key")
    return j.select("date_value", "region_name", "course_name", "enrolled_students_count").orderBy(
        F.col("date_value"), F.col("enrolled_students_count").desc())


def course_reach(bitmaps: DataFrame, dates: DataFrame, period: Sequence[Column], by: Sequence[str] = ("course_key", "course_name"),
                 ) -> DataFrame:
    """Distinct students per period (expressions over the date columns) and ``by``, from the daily bitmaps.

    Bitmaps of the same numbers are merged by a bitwise or of their words with
    partial aggregation (8 bytes a word that has bits), then the bits are
    counted; equal to ``count(distinct)`` over the enrolments of the whole period.
    """
    names = [f"period_{i}" for i in range(len(period))]
    j = bitmap_words(bitmaps.join(dates, "date_key"), *[p.alias(n) for p, n in zip(period, names)], *by, "bucket")
    merged = j.groupBy(*names, *by, "bucket", "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*names, *by).agg(F.sum(F.bit_count("bits")).cast("long").alias("students_count"))


def access_mix(enrol: DataFrame) -> DataFrame:
    """KPI-4: enrolments and distinct students per access type (NULL -> UNKNOWN)."""
    return enrol.groupBy(F.coalesce("access_type", F.lit("UNKNOWN")).alias("access_type")).agg(
        F.count(F.lit(1)).alias("events_count"),
        F.countDistinct("student_id").alias("students_count")).orderBy(F.col("events_count").desc())


def newest_day(rows: DataFrame, dates: DataFrame, days: Sequence[int] | None = None) -> DataFrame:
    """Rows of the newest ``date_key`` that ``dates`` knows.

    The day is found first (one number comes back), and the rows are filtered
    by it as a constant before anything is aggregated: of a stored table only
    that partition is read.  It is found from the key column alone, or, where
    ``days`` lists the partitions of a stored table, without reading ``rows``.
    """
    if days is not None:
        listed = dates.filter(F.col("date_key").isin(list(days))).agg(F.max("date_key")).first()[0]
        return rows.filter(F.col("date_key") == F.lit(listed).cast("int"))
    day = rows.join(dates.select("date_key"), "date_key", "left_semi").agg(F.max("date_key")).first()[0]
    return rows.filter(F.col("date_key") == F.lit(day).cast("int"))


def latest_tiles(fact: DataFrame, dates: DataFrame, days: Sequence[int] | None = None) -> DataFrame:
    """KPI-5: the latest day's totals, with the paid rate also as ``12.34%`` text."""
    last = daily_paid(newest_day(fact, dates, days), dates)
    return last.withColumn("paid_rate_text", percent_text(F.col("paid_students"), F.col("total_students")))


def region_rank_latest(fact: DataFrame, dates: DataFrame, cities: DataFrame, days: Sequence[int] | None = None) -> DataFrame:
    """KPI-6: regions of the latest day, best paid rate first."""
    last = region_daily_paid(newest_day(fact, dates, days), dates, cities)
    return last.orderBy(F.col("paid_rate_pct").desc(), F.col("region_name"))


# The part of a boundary feature collection the map join reads.
FEATURES_SCHEMA = "struct<features: array<struct<properties: struct<shapeName: string>>>>"


def boundary_features(collections: DataFrame, json_col: str = "geojson") -> DataFrame:
    """Feature collections (JSON text) -> one row per feature with its ``shape_name``."""
    parsed = collections.select(F.from_json(F.col(json_col), FEATURES_SCHEMA).alias("fc"))
    return parsed.select(F.explode("fc.features").alias("f")).select(F.col("f.properties.shapeName").alias("shape_name"))


def region_map(fact: DataFrame, dates: DataFrame, cities: DataFrame, collections: DataFrame) -> DataFrame:
    """KPI-7: latest-day region KPIs matched to boundary features by normalised name.

    ``collections`` holds boundary feature collections as JSON text; their
    features are exploded and keyed like the region names.  Regions without
    a feature are kept (``has_boundary`` false).
    """
    last = region_daily_paid(newest_day(fact, dates), dates, cities)
    feats = boundary_features(collections)
    feats = feats.select(region_key("shape_name").alias("region_key"), "shape_name")
    feats = feats.groupBy("region_key").agg(F.min("shape_name").alias("shape_name"))
    keyed = last.withColumn("region_key", region_key("region_name"))
    out = keyed.join(feats, "region_key", "left")
    return out.select("date_value", "region_name", "region_key", "shape_name", "total_students",
                      "paid_students", "paid_rate_pct", F.col("shape_name").isNotNull().alias("has_boundary"))


def top_courses_latest(mart: DataFrame, dates: DataFrame, k: int = 12, days: Sequence[int] | None = None) -> DataFrame:
    """KPI-8: the ``k`` largest (region, course) enrolments of the latest day.

    Only the latest day's rows are joined and ranked (see :func:`newest_day`);
    ``orderBy().limit(k)`` plans as a per-task top-k.
    """
    j = newest_day(mart, dates, days).join(dates.select("date_key", "date_value"), "date_key")
    top = j.orderBy(F.col("enrolled_students_count").desc(), "course_name", "region_name", "course_key").limit(k)
    return top.select("date_value", "region_name", "course_key", "course_name", "enrolled_students_count")


def region_table(fact: DataFrame, dates: DataFrame, cities: DataFrame) -> DataFrame:
    """KPI-9: the regional KPI table, newest day first, best rate first."""
    return region_daily_paid(fact, dates, cities).orderBy(F.col("date_value").desc(), F.col("paid_rate_pct").desc(),
                                                         F.col("region_name"))


def run_metrics(fact: DataFrame, mv_paid: DataFrame, enrol: DataFrame) -> DataFrame:
    """KPI-10: per day: student and paid totals, unweighted mean city paid rate, enrolments.

    The three inputs are stacked and aggregated once by ``date_key`` (a day
    with only one of them still shows, with zeros); enrolments are counted
    per task before they are stacked.
    """
    names = ["student_total_count", "student_paid_count", "paid_rate", "enrolments"]
    none = {"student_total_count": "long", "student_paid_count": "long", "paid_rate": "double", "enrolments": "long"}

    def rows(df: DataFrame, *own: str) -> DataFrame:
        return df.select("date_key", *[F.col(n) if n in own else F.lit(None).cast(none[n]).alias(n) for n in names])
    counted = enrol.groupBy("date_key").agg(F.count(F.lit(1)).alias("enrolments"))
    stacked = (rows(fact, "student_total_count", "student_paid_count").unionByName(rows(mv_paid, "paid_rate"))
               .unionByName(rows(counted, "enrolments")))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("long")
    return stacked.groupBy("date_key").agg(
        total("student_total_count").alias("student_total_count"), total("student_paid_count").alias("student_paid_count"),
        F.round(F.coalesce(F.avg("paid_rate"), F.lit(0.0)), 9).alias("avg_paid_rate"),
        total("enrolments").alias("student_course_enrollments"))
