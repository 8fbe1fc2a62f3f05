"""Silver split / dedupe and gold builders on hand-made dirty rows; invariants on the stand-in tables."""

import datetime as dt

from pyspark.sql import functions as F

from orelake.plans import gold as G
from orelake.plans import lake
from orelake.plans.silver import split_clean_quarantine, standardize_courses, standardize_students

BRONZE_DDL = ("_id string, userId string, name string, phone string, city string, status string, isContacted string, "
              "enrolledCourses string, createdAt string, updatedAt string, _ingested_at string, _batch_id string, "
              "_partition_key string, _operation string, _source string")


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_DDL)


def row(_id, created="2024-01-01T00:00:00Z", updated="2024-01-02T00:00:00Z", ingested="2024-01-03T00:00:00Z",
        batch="b1", courses="[]", city="North, Harbor"):
    return (_id, "u", "o'neil", "+216 20-1", city, " ACTIVE ", "yes", courses, created, updated, ingested, batch,
            "2024-01-03", "UPSERT", "watermark")


def test_quarantine_reasons_and_fallbacks(spark):
    df = bronze(spark, [
        row(None), row("  "), row("a", created="bad", updated="", ingested=None),
        row("b", created="", updated="", ingested="2024-01-05T00:00:00Z"),
        row("c", created="2024-01-01T00:00:00.5Z", updated="bad"),
    ])
    std = standardize_students(df, "2024-02-01 00:00:00", "s1")
    clean, quarantine = split_clean_quarantine(std, "path", "2024-02-01 00:00:00")
    reasons = sorted(r.quarantine_reason for r in quarantine.collect())
    assert reasons == ["bad_created_at,bad_updated_at", "missing_pk", "missing_pk"]
    got = {r.entity_id: (r.created_at, r.updated_at) for r in clean.collect()}
    assert got["b"] == (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5))          # created <- ingested, updated <- created
    assert got["c"] == (dt.datetime(2024, 1, 1, 0, 0, 0, 500000),) * 2              # updated <- created
    assert all(q.raw_payload.startswith("{") and q.bronze_file_path == "path" for q in quarantine.collect())


def test_dedupe_newest_then_ingest_then_batch(spark):
    df = bronze(spark, [
        row("a", updated="2024-01-02T00:00:00Z", batch="b1"),
        row("a", updated="2024-01-04T00:00:00Z", batch="b0"),
        row("b", ingested="2024-01-03T00:00:00Z", batch="b9"),
        row("b", ingested="2024-01-04T00:00:00Z", batch="b1"),
        row("c", batch="b1"), row("c", batch="b2"),
    ])
    clean, _ = split_clean_quarantine(standardize_students(df, "2024-02-01 00:00:00", "s"), "p", "2024-02-01 00:00:00")
    assert {r.entity_id: r.bronze_batch_id for r in clean.collect()} == {"a": "b0", "b": "b1", "c": "b2"}


def test_enrolment_fact_aliases_blank_ids_and_activity(spark):
    courses = ('[{"courseId": "c1", "enrolledAt": "2024-01-01T00:00:00Z", "endAt": "2023-01-01T00:00:00Z", '
               '"accessType": " full "}, {"course_id": "c2", "created_at": "2024-01-02T00:00:00Z", "type": ""}, '
               '{"courseId": "  ", "enrolledAt": "2024-01-01T00:00:00Z"}, {"_id": 7, "expires_at": "2030-01-01T00:00:00Z"}]')
    df = bronze(spark, [row("s1", courses=courses), row("s2", courses='{"id": "c9"}'), row("s3", courses="broken[")])
    clean, _ = split_clean_quarantine(standardize_students(df, "2024-02-01 00:00:00", "s"), "p", "2024-02-01 00:00:00")
    counts = {r.entity_id: (r.enrolled_courses_count, r.is_paid_student) for r in clean.collect()}
    assert counts == {"s1": (4, True), "s2": (1, True), "s3": (0, False)}
    ev = G.fact_course_enrollment_event(clean, "2024-06-01 00:00:00", "2024-02-01 00:00:00")
    got = {(r.student_id, r.course_id): (r.access_type, r.is_active, r.event_time) for r in ev.collect()}
    assert got == {("s1", "c1"): ("full", False, dt.datetime(2024, 1, 1)),
                   ("s1", "c2"): (None, True, dt.datetime(2024, 1, 2)),
                   ("s1", "7"): (None, True, None),
                   ("s2", "c9"): (None, True, None)}


def test_silver_courses_last_delivery_wins(spark):
    ev = spark.createDataFrame([
        ("1", "A", None, "2024-01-01T00:00:00Z", 1, "d1"), ("1", None, "B", "2024-01-01T00:00:00Z", 2, "d1"),
        (" ", "X", None, "2024-01-01T00:00:00Z", 3, "d1"), (None, "Y", None, "2024-01-01T00:00:00Z", 4, "d1"),
    ], "course_id string, course_name string, title string, _ingested_at string, _offset long, ingest_ds string")
    got = [(r.course_id, r.course_name) for r in standardize_courses(ev).collect()]
    assert got == [("1", "B")]


def test_invariants_on_stand_in_tables(spark):
    from tests.conftest import SF_SMALL
    from orelake.plans.bronze import bronze_students
    b = bronze_students(spark, SF_SMALL)
    clean, quarantine = lake.silver_students(spark, SF_SMALL)
    n_in, n_clean, n_q = b.count(), clean.count(), quarantine.count()
    std_ok = n_in - n_q
    assert n_clean <= std_ok and n_q > 0
    # duplicates removed = passing rows that share (slice, entity) with a newer one
    passing = std_ok
    dups = passing - n_clean
    distinct_keys = clean.select("_partition_key", "entity_id").distinct().count()
    assert distinct_keys == n_clean and n_clean + dups + n_q == n_in
    g = lake.gold(spark, SF_SMALL, shared=False)
    fact = g.fact_student_daily
    assert fact.agg(F.sum("student_total_count")).first()[0] == n_clean
    regions = g.dim_city.join(fact, "city_key").groupBy("date_key").agg(F.sum("student_total_count").alias("n"))
    daily = fact.groupBy("date_key").agg(F.sum("student_total_count").alias("n"))
    assert sorted(regions.collect()) == sorted(daily.collect())
    assert g.dim_student.count() == g.dim_student.select("student_key").distinct().count()


def test_region_map_matches_boundary_names(spark):
    import datetime as dt2
    from orelake.plans import kpi
    fact = spark.createDataFrame([(20240101, "k1", 10, 5), (20240101, "k2", 4, 1), (20231201, "k1", 3, 3)],
                                 "date_key int, city_key string, student_total_count long, student_paid_count long")
    dates = spark.createDataFrame([(20240101, dt2.date(2024, 1, 1)), (20231201, dt2.date(2023, 12, 1))],
                                  "date_key int, date_value date")
    cities = spark.createDataFrame([("k1", "MIDDLE EAST"), ("k2", "UNKNOWN")], "city_key string, region_name string")
    geo = spark.createDataFrame(
        [('{"type":"FeatureCollection","features":[{"properties":{"shapeName":"Middle-East"}},'
          '{"properties":{"shapeName":"Port_Saint\'Anne"}}]}',)], "geojson string")
    rows = {r.region_name: r for r in kpi.region_map(fact, dates, cities, geo).collect()}
    assert set(rows) == {"MIDDLE EAST", "UNKNOWN"}
    assert rows["MIDDLE EAST"].has_boundary and rows["MIDDLE EAST"].shape_name == "Middle-East"
    assert rows["MIDDLE EAST"].paid_rate_pct == 50.0 and not rows["UNKNOWN"].has_boundary


def test_carry_email_option(spark):
    rows = [row("a"), row("b")]
    df = bronze(spark, rows).withColumn("email", F.when(F.col("_id") == "a", F.lit(" a@x.org ")))
    for carry, expected in [(False, {"a": None, "b": None}), (True, {"a": "a@x.org", "b": None})]:
        std = standardize_students(df, "2024-02-01 00:00:00", "s", carry_email=carry)
        clean, _ = split_clean_quarantine(std, "p", "2024-02-01 00:00:00")
        assert ("email" in clean.columns) == carry
        got = {r.student_id: r.email for r in G.dim_student(clean, "2024-02-01 00:00:00").collect()}
        assert got == expected


def test_sized_files_are_sorted_before_their_lines_are_padded(spark, tmp_root):
    from pyspark.sql import functions as F

    from orelake import catalog
    rows = spark.createDataFrame([(f"e{i}", i % 2 == 0, f"2024-01-0{1 + i % 2}") for i in range(100)], "line string, wide boolean, ingest_ds string")
    days = catalog._padded(rows)
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("rpad") < plan.index("Sort")
    days.write.partitionBy("ingest_ds").text(f"{tmp_root}/t")
    got = spark.read.text(f"{tmp_root}/t").groupBy(F.col("ingest_ds").cast("string").alias("d"), F.length("value").alias("n")).count().collect()
    assert {tuple(r) for r in got} == {("2024-01-01", 1023, 50), ("2024-01-02", 63, 50)}
