"""Every gold builder produces exactly the fixed table layout (names, order and types)."""

import pytest

from orelake.plans import lake
from orelake.schemas import DDL, conform, empty_table, schema
from tests.conftest import SF_SMALL

GOLD = ["dim_date", "dim_city", "dim_course", "dim_student", "fact_student_daily", "mv_paid_students_daily",
        "fact_course_enrollment_event", "mv_course_enrollment_region_daily"]


@pytest.mark.parametrize("name", GOLD)
def test_gold_builder_matches_ddl(spark, name):
    df = getattr(lake.gold(spark, SF_SMALL, shared=False), name)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema(name).fields]
    assert got == want


def test_conform_and_empty_table(spark):
    df = spark.createDataFrame([("k", "x", 3)], "city_key string, extra string, date_key long")
    out = conform(df, "fact_student_daily")
    assert out.columns == [f.name for f in schema("fact_student_daily").fields]
    assert out.schema["date_key"].dataType.simpleString() == "int"
    assert out.first().student_total_count is None
    assert set(DDL) >= set(GOLD) and empty_table(spark, "dim_city").count() == 0
