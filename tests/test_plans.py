"""Plan checks: no Python UDF, no cross / nested-loop joins, pushed-down filters, pruned scans."""

import pytest

from orelake.catalog import QUERIES
from tests.conftest import SF_SMALL

PLAN_QUERIES = ["kpi_region_daily_paid", "kpi_course_enrollment", "kpi_top_courses_latest", "kpi_region_rank_latest",
                "dim_student", "fact_course_enrollment_event", "bronze_email_lookup", "silver_students_clean"]


def plan_of(df):
    """The plan that ran: adaptive plans are final only after execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_udf_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_partition_filter_and_pruning(spark, tmp_root):
    from orelake.sinks import write_layer
    from orelake.sources import read_partition
    df = spark.createDataFrame([("2024-01-01", 1, "x"), ("2024-01-02", 2, "y")], "ds string, v int, w string")
    write_layer(df, tmp_root + "/t", ["ds"])
    one = read_partition(spark, tmp_root + "/t", "ds", "2024-01-02").select("v")
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(ds" in plan and "ReadSchema: struct<v:int>" in plan
    assert [r.v for r in one.collect()] == [2]


def test_dedupe_uses_partial_window_limit(spark):
    plan = plan_of(QUERIES["silver_students_clean"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2


def test_no_fixed_partition_numbers(spark):
    for name in ("fact_student_daily", "silver_courses", "bronze_email_lookup"):
        assert "REPARTITION_BY_NUM" not in plan_of(QUERIES[name](spark, SF_SMALL)), name


def test_newest_day_is_pruned_before_the_aggregate(spark, tmp_root):
    from orelake.plans import kpi
    fact = spark.range(3000).selectExpr("CAST(20240101 + id % 20 AS INT) AS date_key", "CAST(id AS STRING) AS city_key",
                                        "id AS student_total_count", "id AS student_paid_count")
    fact.write.partitionBy("date_key").parquet(f"{tmp_root}/fact")
    dates = spark.range(20).selectExpr("CAST(20240101 + id AS INT) AS date_key", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS date_value")
    plan = plan_of(kpi.latest_tiles(spark.read.parquet(f"{tmp_root}/fact"), dates))
    assert "PartitionFilters: [isnotnull(date_key" in plan and "= 20240120)" in plan
    assert kpi.latest_tiles(spark.read.parquet(f"{tmp_root}/fact"), dates).first().total_students == sum(range(19, 3000, 20))


def test_run_metrics_and_lookup_shuffle_little(spark):
    assert plan_of(QUERIES["gold_run_metrics"](spark, SF_SMALL)).count("SortMergeJoin FullOuter") == 0
    lookup = plan_of(QUERIES["bronze_email_lookup"](spark, SF_SMALL))
    assert lookup.count("customer.parquet") <= 2 and lookup.count("orders.parquet") <= 1
    assert "Window" not in plan_of(QUERIES["silver_metrics"](spark, SF_SMALL).filter("students_clean_count > 0")).split("Union")[0]


def test_a_hot_customer_is_split(spark, tmp_root):
    """A third of the orders belong to one customer: the adaptive join splits that partition."""
    from orelake.sources import student_documents
    for t in ("customer", "nation", "region", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_root}/{t}.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    many = orders.selectExpr("*", "explode(sequence(0, 19)) AS copy").selectExpr(
        "o_orderkey + 10000000 * copy AS o_orderkey", "if(o_orderkey % 3 = 0, 1, o_custkey) AS o_custkey",
        "o_orderstatus", "o_orderdate", "o_orderpriority")
    many.write.parquet(f"{tmp_root}/orders.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = plan_of(student_documents(spark, tmp_root))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan, plan


def test_the_latest_day_of_a_stored_mart_is_one_partition(spark, tmp_root):
    """Found from the commit's partition list, or from the key column; then a constant partition filter."""
    from orelake.plans import kpi
    from orelake.plans.daily import read_gold, stored_days
    from orelake.schemas import conform
    from orelake.sinks import Commit
    name = "mv_course_enrollment_region_daily"
    rows = spark.range(60).selectExpr("cast(20240101 + id % 3 as int) date_key", "'r' region_name", "concat('k', id) course_key",
                                      "concat('c', id) course_name", "id enrolled_students_count")
    dates = spark.createDataFrame([(20240101 + i,) for i in range(3)], "date_key int").selectExpr("date_key", "to_date(cast(date_key as string), 'yyyyMMdd') date_value")
    with Commit(spark, f"{tmp_root}/gold") as c:
        c.replace(conform(rows, name), "date_key", [20240101, 20240102, 20240103], table=name)
    mart = read_gold(spark, tmp_root)[name]
    assert stored_days(spark, tmp_root, name) == [20240101, 20240102, 20240103]
    for days in (None, stored_days(spark, tmp_root, name)):
        top = kpi.top_courses_latest(mart, dates, k=4, days=days)
        assert [r.enrolled_students_count for r in top.collect()] == [59, 56, 53, 50]
        plan = plan_of(top)
        assert "(date_key#" in plan and "= 20240103)" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_listed_partitions_read_no_file(spark, tmp_root):
    import os

    from orelake.operators.health import listed_partitions, missing_partitions
    for day in ("2024-01-01", "2024-01-04"):
        os.makedirs(f"{tmp_root}/t/ds={day}")
        for i in range(2):
            with open(f"{tmp_root}/t/ds={day}/part-{i}.parquet", "w") as fh:
                fh.write("no parquet")
    days = listed_partitions(spark, f"{tmp_root}/t", "ds")
    assert sorted(map(tuple, days.collect())) == [("2024-01-01", 2, 20), ("2024-01-04", 2, 20)]
    assert sorted(str(r.ds) for r in missing_partitions(days, "ds").collect()) == ["2024-01-02", "2024-01-03"]
