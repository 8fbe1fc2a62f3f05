"""A key holding a third of all rows: results stay exact and every keyed step combines before the shuffle."""

from pyspark.sql import functions as F

from orelake.operators import email_by_key
from orelake.plans import gold as G
from orelake.plans import kpi


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_city_and_hot_course(spark):
    n = 30000
    base = spark.range(n).select(
        F.lit("2024-01-01").alias("_partition_key"),
        F.col("id").cast("string").alias("entity_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT, CITY")).otherwise(F.concat(F.lit("R, C"), (F.col("id") % 50).cast("string"))).alias("city"),
        (F.col("id") % 2 == 0).alias("is_paid_student"),
        F.array(F.when(F.col("id") % 3 == 0, F.lit('{"courseId": "hot", "enrolledAt": "2024-01-01T00:00:00Z"}'))
                 .otherwise(F.concat(F.lit('{"courseId": "c'), (F.col("id") % 7).cast("string"), F.lit('"}')))).alias("enrolled_courses"),
    )
    fact = G.fact_student_daily(base, "2024-02-01 00:00:00")
    hot = fact.filter(F.col("city_key") == F.md5(F.lit("HOT, CITY"))).first()
    assert hot.student_total_count == n // 3 and hot.student_paid_count == n // 6
    assert "partial_count" in _plan(fact)
    enrol = G.fact_course_enrollment_event(base, "2024-06-01 00:00:00", "2024-02-01 00:00:00")
    mix = kpi.access_mix(enrol).first()
    assert (mix.events_count, mix.students_count) == (n, n)
    plan = _plan(kpi.access_mix(enrol))
    assert plan.count("HashAggregate") >= 4          # (type, student) partial/final, then count partial/final
    assert enrol.filter(F.col("course_id") == "hot").count() == n // 3


def test_hot_lookup_key(spark):
    users = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("shared")).otherwise(F.col("id").cast("string")).alias("_id"),
        F.lit(None).cast("string").alias("userId"),
        F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.org")).alias("email"),
        F.lit(None).cast("string").alias("mail"))
    m = email_by_key(users)
    assert m.filter(F.col("lookup_key") == "shared").first().email == "u0@x.org"
    assert "partial_min" in _plan(m)
