"""The daily run with real writes: drained cursor, idempotent re-runs, emptied days, side-cars."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from orelake.plans.daily import (DayInputs, bronze_ingest, gold_day, read_cursor, read_fact, read_gold, run_day,
                                 silver_day)
from orelake.sinks import read_current
from orelake.sources import student_documents, user_documents
from tests.conftest import SF_SMALL

AS_OF, TS1, TS2 = "1999-01-01 00:00:00", "2024-03-02 02:00:00", "2024-03-03 02:00:00"
DAY1, DAY2 = "2024-03-01", "2024-03-02"


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo"])
def driver_zone(request):
    old = os.environ.get("TZ")
    os.environ["TZ"] = request.param
    time.tzset()
    yield request.param
    if old is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = old
    time.tzset()


def ids(spark, root):
    return sorted(r._id for r in spark.read.parquet(f"{root}/bronze/students").select("_id").collect())


def test_drain_in_commits_under_any_driver_zone(spark, tmp_root, driver_zone):
    """Undated documents more than a commit holds, equal times, microseconds: all read once, late ones found later."""
    rows = [(f"n{i}", None) for i in range(5)] + [(f"d{i}", f"2024-01-01T{i:02d}:00:00Z") for i in range(10, 20)]
    rows += [(f"t{i}", "2024-01-01T12:00:00Z") for i in range(4)] + [("u1", "2024-01-01T12:00:00.123456Z"), ("bad", "soon")]
    docs = spark.createDataFrame(rows, "_id string, updatedAt string")
    bronze_ingest(spark, DayInputs(docs), DAY1, tmp_root, TS1, batch_size=3)
    assert ids(spark, tmp_root) == sorted(r[0] for r in rows)
    late = rows + [("p0", None), ("d20", "2024-01-01T19:00:00.000001Z"), ("d9", "2024-01-01T09:00:00Z")]
    got = bronze_ingest(spark, DayInputs(spark.createDataFrame(late, "_id string, updatedAt string")), DAY2, tmp_root, TS2)
    assert sorted(r._id for r in got.collect()) == ["d20", "p0"]
    assert ids(spark, tmp_root) == sorted([r[0] for r in rows] + ["d20", "p0"])


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_typed_times_with_microseconds(spark, tmp_root, driver_zone, kind):
    docs = spark.sql(f"SELECT * FROM VALUES ('a', CAST('2024-01-01 10:00:00.123456' AS {kind})), "
                     f"('b', CAST('2024-01-01 10:00:00.123457' AS {kind})), ('c', CAST(NULL AS {kind})) AS t(_id, updatedAt)")
    one = bronze_ingest(spark, DayInputs(docs.filter("_id <> 'b'")), DAY1, tmp_root, TS1)
    assert {r._id: r.updatedAt for r in one.collect()} == {"a": "2024-01-01T10:00:00.123456Z", "c": None}
    assert read_cursor(spark, tmp_root).watermark == "2024-01-01 10:00:00.123456"
    two = bronze_ingest(spark, DayInputs(docs), DAY2, tmp_root, TS2)
    assert [r._id for r in two.collect()] == ["b"]


def test_sidecars_count_files_bytes_and_empty_batches(spark, tmp_root):
    docs = spark.createDataFrame([(f"d{i}", f"2024-01-01T10:00:{i:02d}Z") for i in range(9)], "_id string, updatedAt string").repartition(3)
    bronze_ingest(spark, DayInputs(docs), DAY1, tmp_root, TS1)
    bronze_ingest(spark, DayInputs(docs), DAY1, tmp_root, TS2)
    full, none = sorted(spark.read.json(f"{tmp_root}/bronze/_meta/students").collect(), key=lambda r: -r.record_count)
    files = spark.read.format("binaryFile").load(f"{tmp_root}/bronze/students/_partition_key={DAY1}")
    n, size = files.agg(F.count("path"), F.sum("length")).first()
    assert (full.record_count, full.file_count, full.total_size_bytes, full.quality_status) == (9, n, size, "PASSED_7_POINT_GATE")
    assert (none.record_count, none.file_count, none.total_size_bytes, none.quality_status) == (0, 0, 0, "EMPTY_BATCH")
    assert full.ingested_at == "2024-03-02T02:00:00Z" and full.partition == DAY1


def test_nothing_to_ingest_at_all(spark, tmp_root):
    docs = spark.createDataFrame([], "_id string, updatedAt string")
    assert bronze_ingest(spark, DayInputs(docs), DAY1, tmp_root, TS1).count() == 0
    assert spark.read.json(f"{tmp_root}/bronze/_meta/students").first().quality_status == "EMPTY_BATCH"


def test_run_day_idempotent_and_incremental(spark, tmp_root):
    docs = student_documents(spark, SF_SMALL)
    first = DayInputs(students=docs.filter("doc_seq % 3 > 0"), users=user_documents(spark, SF_SMALL), tie_col="doc_seq")
    m1 = run_day(spark, DAY1, tmp_root, first, as_of=AS_OF, run_ts=TS1)
    assert m1["student_total_count"] > 0
    snap = lambda name: sorted(read_gold(spark, tmp_root)[name].drop("load_ts", "refreshed_at").collect())
    fact1, mart1, dims1 = snap("fact_student_daily"), snap("mv_course_enrollment_region_daily"), snap("dim_student")
    # re-running silver and gold of the same day replaces, never doubles
    silver_day(spark, DAY1, tmp_root, TS1)
    gold_day(spark, DAY1, tmp_root, AS_OF, TS1)
    assert snap("fact_student_daily") == fact1
    assert snap("mv_course_enrollment_region_daily") == mart1
    assert snap("dim_student") == dims1
    silver = spark.read.json(f"{tmp_root}/silver/_metrics").first()
    assert silver.students_clean_count == m1["student_total_count"] and silver.students_quarantine_count > 0
    # the next day takes what is newer than the stored cursor, and undated documents not seen yet
    newer = docs.withColumn("updatedAt", F.regexp_replace("updatedAt", "(19|20)[0-9]{2}-", "2031-"))
    run_day(spark, DAY2, tmp_root, DayInputs(newer, user_documents(spark, SF_SMALL), tie_col="doc_seq"), as_of=AS_OF, run_ts=TS2)
    g = read_gold(spark, tmp_root)
    assert g["fact_student_daily"].select("date_key").distinct().count() == 2
    bronze = spark.read.parquet(f"{tmp_root}/bronze/students")
    assert bronze.filter(F.col("_partition_key") == DAY1).count() == docs.filter("doc_seq % 3 > 0").count()
    assert bronze.filter(F.col("email").isNotNull()).count() > 0
    ds = g["dim_student"]
    assert ds.count() == ds.select("student_key").distinct().count()
    assert spark.read.json(f"{tmp_root}/gold/_metrics").count() == 2
    assert read_current(spark, f"{tmp_root}/bronze/_state/students").first().lastPipeline == TS2


def test_a_day_that_is_empty_now_leaves_nothing(spark, tmp_root):
    """A corrected day without enrolments and faults clears the old facts, mart and quarantine of that day only."""
    cols = "_id string, name string, city string, enrolledCourses string, createdAt string, updatedAt string"
    course = '[{"courseId": "c1", "enrolledAt": "2024-01-01T00:00:00Z"}]'
    day = lambda c, key: spark.createDataFrame(
        [("s1", "a", "N, H", c, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z"),
         (key, "b", "N, H", c, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")], cols)
    run_day(spark, DAY1, tmp_root, DayInputs(day(course, "\t")), as_of=AS_OF, run_ts=TS1)
    later = day(course, "s9").withColumn("updatedAt", F.lit("2024-01-09T00:00:00Z"))
    run_day(spark, DAY2, tmp_root, DayInputs(later), as_of=AS_OF, run_ts=TS2)
    g = read_gold(spark, tmp_root)
    assert sorted(r.date_key for r in g["fact_course_enrollment_event"].collect()) == [20240301, 20240302, 20240302]
    assert spark.read.parquet(f"{tmp_root}/silver/quarantine").count() == 1       # the tab is no id
    corrected = spark.read.parquet(f"{tmp_root}/bronze/students").filter(F.col("_partition_key") == DAY1).withColumns(
        {"enrolledCourses": F.lit("[]"), "_id": F.when(F.col("_id") == "\t", "s2").otherwise(F.col("_id"))}).cache()
    corrected.count()
    from orelake.sinks import replace_partition
    replace_partition(corrected, f"{tmp_root}/bronze/students", "_partition_key")
    silver_day(spark, DAY1, tmp_root, TS2)
    gold_day(spark, DAY1, tmp_root, AS_OF, TS2)
    g = read_gold(spark, tmp_root)
    assert sorted(r.date_key for r in g["fact_course_enrollment_event"].collect()) == [20240302, 20240302]
    assert {r.date_key for r in g["mv_course_enrollment_region_daily"].collect()} == {20240302}
    assert not os.path.exists(f"{tmp_root}/silver/quarantine/_partition_key={DAY1}")
    assert {r.date_key: r.student_total_count for r in g["fact_student_daily"].collect()} == {20240301: 2, 20240302: 2}


def test_run_day_with_course_events(spark, tmp_root):
    from orelake.session import scratch_path
    from orelake.sources import course_events
    from orelake.streaming.course_feed import stream_to_bronze
    from orelake.streaming.producer import publish_events
    topic, bronze = scratch_path(spark, "topic"), scratch_path(spark, "bronze_events")
    publish_events(course_events(spark, SF_SMALL).drop("_ingested_at", "ingest_ds"), topic)
    stream_to_bronze(spark, topic, bronze, scratch_path(spark, "ckpt"), ingest_time_col="event_time").awaitTermination()
    inputs = DayInputs(students=student_documents(spark, SF_SMALL), users=user_documents(spark, SF_SMALL),
                       course_events_dir=bronze, tie_col="doc_seq")
    run_day(spark, "2024-01-05", tmp_root, inputs, as_of=AS_OF, run_ts=TS1)
    g = read_gold(spark, tmp_root)
    courses = g["dim_course"]
    day_events = spark.read.json(bronze).filter(F.col("ingest_date") == dt.date(2024, 1, 5))
    expected = day_events.filter(F.trim("course_id") != "").select("course_id").distinct().count()
    assert courses.count() == expected > 0
    assert courses.count() == courses.select("course_key").distinct().count()
    mart = g["mv_course_enrollment_region_daily"]
    assert mart.count() > 0
    named = mart.filter(F.col("course_name") != "UNKNOWN").count()
    assert 0 < named <= mart.count()


def test_an_unreadable_gold_table_raises(spark, tmp_root):
    import glob

    from orelake.schemas import KEYS, empty_table
    from orelake.sinks import Commit
    name = "fact_student_daily"
    with Commit(spark, f"{tmp_root}/gold") as c:
        row = spark.createDataFrame([(20240101, "k")], "date_key int, city_key string")
        c.replace(empty_table(spark, name).unionByName(row, allowMissingColumns=True), "date_key", [20240101], table=name, keys=KEYS[name])
    assert read_gold(spark, tmp_root)[name].count() == 1
    for f in glob.glob(f"{tmp_root}/gold/{name}/*/*/part-*"):
        with open(f, "w") as fh:
            fh.write("not parquet")
    with pytest.raises(Exception):
        read_gold(spark, tmp_root)[name].agg({"student_total_count": "sum"}).collect()


def undated(spark, keys):
    return DayInputs(spark.createDataFrame([(k, None) for k in keys], "_id string, updatedAt string"))


@pytest.mark.parametrize("early,late", [(["98", "99"], ["100", "101"]), (["f81d4fae", "zz"], ["00aa", "b2c3", "F81D"])])
def test_late_undated_documents_are_read_once(spark, tmp_root, early, late):
    """Their ids may sort before the ones already read: an index of keys, not a largest id, tells what was read."""
    bronze_ingest(spark, undated(spark, early), DAY1, tmp_root, TS1)
    got = bronze_ingest(spark, undated(spark, early + late), DAY2, tmp_root, TS2, batch_size=1)
    assert sorted(r._id for r in got.collect()) == sorted(late)
    assert bronze_ingest(spark, undated(spark, late + early), DAY2, tmp_root, TS2).count() == 0
    assert ids(spark, tmp_root) == sorted(early + late)


def test_undated_documents_without_an_id(spark, tmp_root):
    rows = [(None, None, "a"), (None, None, "b"), ("x", None, "c")]
    docs = lambda r: DayInputs(spark.createDataFrame(r, "_id string, updatedAt string, name string"))
    bronze_ingest(spark, docs(rows[:1]), DAY1, tmp_root, TS1)
    bronze_ingest(spark, docs(rows), DAY1, tmp_root, TS2)
    assert sorted(r.name for r in spark.read.parquet(f"{tmp_root}/bronze/students").collect()) == ["a", "b", "c"]


def dated(spark, n):
    return DayInputs(spark.createDataFrame([(f"d{i}", f"2024-01-01T10:00:{i:02d}Z") for i in range(n)] + [("u", None)],
                                           "_id string, updatedAt string"))


def sidecars(spark, root):
    return sorted((r.partition, r.record_count) for r in spark.read.json(f"{root}/bronze/_meta/students").collect())


@pytest.mark.parametrize("day", [DAY1, DAY2])
def test_killed_between_rows_and_cursor(spark, tmp_root, monkeypatch, day):
    """Nobody sees the rows; the repeat, for the same or the next day, with more documents by now, writes them once."""
    from orelake.sinks import tables
    real = tables._point
    monkeypatch.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        bronze_ingest(spark, dated(spark, 5), DAY1, tmp_root, TS1)
    monkeypatch.setattr(tables, "_point", real)
    bronze_ingest(spark, dated(spark, 7), day, tmp_root, TS2)
    rows = spark.read.parquet(f"{tmp_root}/bronze/students")
    assert ids(spark, tmp_root) == sorted([f"d{i}" for i in range(7)] + ["u"])
    assert rows.select("_batch_id", "_checksum").distinct().count() == 8 and sidecars(spark, tmp_root) == [(day, 8)]
    assert not [d for _, ds, _ in os.walk(f"{tmp_root}/bronze/students") for d in ds if d.startswith("_attempt")]


def test_killed_after_the_pointer(spark, tmp_root, monkeypatch):
    """The commit stands: the next step, whichever it is, shows the rows and writes the side-car."""
    from orelake.plans import daily
    real = daily.finish_ingest
    calls = []
    monkeypatch.setattr(daily, "finish_ingest", lambda *a: calls.append(1) if not calls else (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        bronze_ingest(spark, dated(spark, 5), DAY1, tmp_root, TS1)
    monkeypatch.setattr(daily, "finish_ingest", real)
    assert bronze_ingest(spark, dated(spark, 6), DAY2, tmp_root, TS2).count() == 1
    assert ids(spark, tmp_root) == sorted([f"d{i}" for i in range(6)] + ["u"])
    assert sidecars(spark, tmp_root) == [(DAY1, 6), (DAY2, 1)]


def test_two_runs_from_one_cursor(spark, tmp_root, monkeypatch):
    from orelake.sinks import CommitConflict, tables
    real, todo = tables._point, [1]

    def point(*args):
        if todo:
            todo.pop()
            bronze_ingest(spark, dated(spark, 6), DAY1, tmp_root, TS1)
        return real(*args)
    monkeypatch.setattr(tables, "_point", point)
    with pytest.raises(CommitConflict):
        bronze_ingest(spark, dated(spark, 5), DAY1, tmp_root, TS2)
    monkeypatch.setattr(tables, "_point", real)
    bronze_ingest(spark, dated(spark, 6), DAY2, tmp_root, TS2)
    assert ids(spark, tmp_root) == sorted([f"d{i}" for i in range(6)] + ["u"])


def test_a_gold_day_is_all_or_nothing(spark, tmp_root, monkeypatch):
    """Killed after each of its writes, then before the pointer: readers keep the tables of the day before."""
    from orelake.sinks import tables
    cols = "_id string, name string, city string, enrolledCourses string, createdAt string, updatedAt string"
    course = '[{"courseId": "c1", "enrolledAt": "2024-01-01T00:00:00Z"}]'
    day = lambda k, u: DayInputs(spark.createDataFrame([(k, "a", f"N, {k}", course, "2024-01-01T00:00:00Z", u)], cols))
    run_day(spark, DAY1, tmp_root, day("s1", "2024-01-02T00:00:00Z"), as_of=AS_OF, run_ts=TS1)
    snap = lambda: {n: sorted(map(str, df.collect())) for n, df in read_gold(spark, tmp_root).items()}
    before = snap()
    bronze_ingest(spark, day("s2", "2024-01-09T00:00:00Z"), DAY2, tmp_root, TS2)
    silver_day(spark, DAY2, tmp_root, TS2)
    real, point = tables.Commit._stage, tables._point
    for n in range(7):
        left = [n]

        def stage(self, *args, **kw):
            real(self, *args, **kw)
            if not left[0]:
                raise RuntimeError("killed")
            left[0] -= 1
        monkeypatch.setattr(tables.Commit, "_stage", stage)
        with pytest.raises(RuntimeError):
            gold_day(spark, DAY2, tmp_root, AS_OF, TS2)
        assert snap() == before
    monkeypatch.setattr(tables.Commit, "_stage", real)
    monkeypatch.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        gold_day(spark, DAY2, tmp_root, AS_OF, TS2)
    monkeypatch.setattr(tables, "_point", point)
    assert snap() == before
    gold_day(spark, DAY2, tmp_root, AS_OF, TS2)
    assert {len(v) for n, v in snap().items() if n != "dim_course"} == {2}
    assert read_fact(spark, tmp_root, "fact_student_daily", [20240302]).count() == 1
    silver = spark.read.parquet(f"{tmp_root}/silver/students")
    assert silver.filter("_checksum IS NULL").count() == 0
