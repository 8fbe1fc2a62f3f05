"""Operators: keyed latest row, cursor scans, e-mail look-up, latest-day filter, upsert, health."""

import datetime as dt

from pyspark.sql import functions as F

from orelake.operators import email_by_key, incremental_scan, keep_latest, latest_by_key, lookup_email, next_watermark
from orelake.operators import health
from orelake.sinks import merge_upsert, read_current, replace_partition, upsert, write_version


def test_latest_by_key_newest_first_nulls_last(spark):
    df = spark.createDataFrame([
        ("a", 3, "x", 1), ("a", None, "y", 9), ("a", 3, "z", 2),   # tie on o -> larger tie-break wins
        ("b", None, "n", 1), ("b", None, "m", 2),                  # all NULL -> tie-break decides
    ], "k string, o int, v string, t int")
    got = {r.k: r.v for r in latest_by_key(df, ["k"], ["o", "t"]).collect()}
    assert got == {"a": "z", "b": "m"}


def test_latest_by_key_hot_key_plan_limits_before_shuffle(spark):
    df = spark.range(100000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    out = latest_by_key(df, ["k"], ["o"])
    assert sorted((r.k, r.o) for r in out.collect()) == [(0, 99998), (1, 99999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_incremental_scan_cursor_and_ties(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        (t(2020, 1, 1), "a"), (t(2020, 1, 2), "a"), (t(2020, 1, 2), "b"), (t(2020, 1, 2), "c"),
        (t(2020, 1, 3), "d"), (None, "e")], "u timestamp_ntz, id string")
    boot = [r.id for r in incremental_scan(df, "u", None, tie="id", limit=3).collect()]
    assert boot == ["e", "a", "a"]          # NULL cursor values sort first
    plain = [r.id for r in incremental_scan(df, "u", t(2020, 1, 1), tie="id", limit=2).collect()]
    assert plain == ["a", "b"]
    nxt = next_watermark(incremental_scan(df, "u", t(2020, 1, 1), tie="id", limit=2), "u", t(2020, 1, 1), tie="id").first()
    assert (nxt.watermark, nxt.watermark_tie, nxt.batch_rows) == (t(2020, 1, 2), "b", 2)
    # resuming from (2020-01-02, b) does not strand row c that shares the boundary value
    rest = sorted(r.id for r in incremental_scan(df, "u", nxt.watermark, tie="id", limit=None, tie_wm=nxt.watermark_tie).collect())
    assert rest == ["c", "d"]
    upto = sorted(r.id for r in incremental_scan(df, "u", t(2020, 1, 1), tie="id", limit=None, until=t(2020, 1, 2)).collect())
    assert upto == ["a", "b", "c"]
    drain_plan = incremental_scan(df, "u", t(2020, 1, 1), tie="id", limit=None)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in drain_plan.lower()


def test_next_watermark_empty_batch_keeps_old(spark):
    df = spark.createDataFrame([], "u timestamp_ntz, id string")
    r = next_watermark(df, "u", dt.datetime(2020, 5, 1), tie="id").first()
    assert r.watermark == dt.datetime(2020, 5, 1) and r.batch_rows == 0


def test_email_lookup_rules(spark):
    users = spark.createDataFrame([
        ("u1", "acct-1", "one@x.com", None), ("u2", None, None, "two@mail.org"),
        ("u3", None, "   ", "three@mail.org"), ("u4", None, "", "four@mail.org"), ("u5", None, " five@x.com ", None),
    ], "_id string, userId string, email string, mail string")
    students = spark.createDataFrame([("acct-1",), ("u1",), ("u2",), ("u3",), ("u4",), (" u5 ",), ("zz",), (None,)],
                                     "userId string")
    got = {r.userId: r.email for r in lookup_email(students, users).collect()}
    assert got == {"acct-1": "one@x.com", "u1": "one@x.com", "u2": "two@mail.org", "u3": None,
                   "u4": "four@mail.org", " u5 ": "five@x.com", "zz": None, None: None}
    plan = lookup_email(students, users)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert email_by_key(users).count() == 5   # u1, acct-1, u2, u4, u5 (u3: blank e-mail, no fallback)


def test_keep_latest_is_semi_join_not_cross(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "d int, v string")
    out = keep_latest(df, "d")
    assert sorted(r.v for r in out.collect()) == ["b", "c"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_merge_upsert_and_versions(spark, tmp_root):
    t0 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "c"), (3, "C")], "k int, v string")
    root = f"{tmp_root}/dim"
    assert read_current(spark, root) is None
    write_version(t0, root)
    merged = merge_upsert(read_current(spark, root), upd, ["k"], order=["v"])
    write_version(merged, root)
    got = sorted((r.k, r.v) for r in read_current(spark, root).collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]     # 'c' > 'C': newest by order wins inside the batch


def test_undated_rows_have_a_cursor_of_their_own(spark):
    from orelake.operators import Cursor, advance
    t = dt.datetime
    df = spark.createDataFrame([(None, "a"), (None, "b"), (t(2020, 1, 1, 0, 0, 0, 5), "c"), (t(2020, 1, 2), "d")], "u timestamp_ntz, id string")
    cursor, seen = Cursor(), []
    for _ in range(6):
        batch = incremental_scan(df, "u", cursor.watermark, tie="id", limit=1, tie_wm=cursor.tie, null_tie=cursor.null_tie, nulls=True)
        cursor, n = advance(batch, "u", "id", cursor)
        seen += [r.id for r in batch.collect()] if n else []
    assert seen == ["a", "b", "c", "d"] and cursor == Cursor("2020-01-02 00:00:00", "d", "b")


def test_broken_pointer_raises_and_keeps_the_data(spark, tmp_root):
    import glob
    import pytest
    root = f"{tmp_root}/dim"
    write_version(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), root)
    write_version(spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string"), root)
    newest = sorted(glob.glob(f"{root}/_pointers/*"))[-1]
    (part,) = glob.glob(f"{newest}/part-*")
    good = open(part).read()
    open(part, "w").close()
    for crc in glob.glob(f"{newest}/.part-*.crc"):
        open(crc, "w").close()
    with pytest.raises(Exception):
        read_current(spark, root)
    with pytest.raises(Exception):
        upsert(spark, root, spark.createDataFrame([(3, "c")], "k int, v string"), ["k"])
    import os
    for crc in glob.glob(f"{newest}/.part-*.crc"):
        os.remove(crc)
    with open(part, "w") as fh:
        fh.write(good)
    assert sorted(map(tuple, read_current(spark, root).collect())) == [(1, "A"), (2, "B")]


def test_crash_between_data_and_pointer_leaves_the_old_version(spark, tmp_root, monkeypatch):
    import pytest
    from orelake.sinks import tables
    root = f"{tmp_root}/dim"
    upsert(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    real = tables._point
    monkeypatch.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        upsert(spark, root, spark.createDataFrame([(2, "B")], "k int, v string"), ["k"])
    assert sorted(map(tuple, read_current(spark, root).collect())) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(tables, "_point", real)
    upsert(spark, root, spark.createDataFrame([(2, "C")], "k int, v string"), ["k"])
    assert sorted(map(tuple, read_current(spark, root).collect())) == [(1, "a"), (2, "C")]


def test_upsert_rewrites_touched_buckets_only_and_removes_old_files(spark, tmp_root):
    import glob
    import os
    root = f"{tmp_root}/dim"
    rows = [(i, f"v{i}") for i in range(200)]
    upsert(spark, root, spark.createDataFrame(rows, "k int, v string"), ["k"], buckets=8)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/v-*/*/part-*")}
    out = upsert(spark, root, spark.createDataFrame([(5, "new"), (999, "more")], "k int, v string"), ["k"], buckets=8)
    want = {**dict(rows), 5: "new", 999: "more"}
    assert {r.k: r.v for r in out.collect()} == want
    after = glob.glob(f"{root}/v-*/*/part-*")
    assert len(set(before) & set(after)) == len(before) and 1 <= len(set(after) - set(before)) <= 2
    for i in range(4):
        upsert(spark, root, spark.createDataFrame([(5, f"n{i}")], "k int, v string"), ["k"], buckets=8)
    files = glob.glob(f"{root}/v-*/*/part-*")
    assert len(files) <= 8 + 1                       # the current buckets and the one version before
    same = upsert(spark, root, spark.createDataFrame([], "k int, v string"), ["k"], buckets=8)
    assert {r.k: r.v for r in same.collect()} == {**want, 5: "n3"}


def test_replace_partition_clears_a_named_day(spark, tmp_root):
    path = f"{tmp_root}/fact"
    replace_partition(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "d int, v string"), path, "d")
    replace_partition(spark.createDataFrame([(2, "B")], "d int, v string"), path, "d", [2, 3])
    assert sorted((r.d, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B")]


def test_an_appended_table_reads_fully(spark, tmp_root):
    from orelake.session import table
    df = spark.range(3)
    df.write.parquet(f"{tmp_root}/t.parquet")
    assert table(spark, tmp_root, "t").count() == 3
    df.write.mode("append").parquet(f"{tmp_root}/t.parquet")
    assert table(spark, tmp_root, "t").count() == 6


def test_file_listing_reads_no_rows(spark, tmp_root):
    spark.range(100).repartition(4).write.parquet(f"{tmp_root}/t")
    files = health.file_stats(spark, f"{tmp_root}/t", "t")
    assert files.count() == 4 and "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert health.file_counts(files).first().file_count == 4


def test_health_checks(spark):
    present = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-05",)], "d string")
    missing = sorted(str(r.ds) for r in health.missing_partitions(present, "d").collect())
    assert missing == ["2024-01-03", "2024-01-04"]
    parts = spark.createDataFrame([("2024-01-31",), ("2023-12-01",), ("2023-06-01",), ("2020-01-01",)], "ds string")
    tiers = [r.tier for r in health.retention_tier(parts, "ds", "2024-02-01").orderBy(F.desc("ds")).collect()]
    assert tiers == ["hot", "warm", "cold", "delete"]
    files = spark.createDataFrame([("s", f"f{i}", 100) for i in range(20)] + [("s", "big", 5000)],
                                  "collection string, file_path string, file_size long")
    flagged = [r.file_path for r in health.file_size_anomalies(files).filter("is_anomaly").collect()]
    assert flagged == ["big"]
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "x string, y int")
    sums = df.select(health.row_checksum(["x", "y"]).alias("c")).distinct().count()
    assert sums == 2


def test_extended_json_array_files(spark, tmp_root):
    import json
    import os
    from orelake.sources import read_extended_json, read_jsonl_tolerant
    os.makedirs(f"{tmp_root}/seed")
    docs = [{"_id": "plain-1", "createdAt": "2024-01-01T00:00:00Z", "name": "a"},
            {"_id": {"$oid": "65a0c0ffee0000000000beef"}, "createdAt": {"$date": "2024-01-02T00:00:00.000Z"}, "name": "b"}]
    with open(f"{tmp_root}/seed/students.json", "w", encoding="utf-8") as fh:
        json.dump(docs, fh, indent=2)
    df = read_extended_json(spark, f"{tmp_root}/seed", "_id string, createdAt string, name string",
                            date_cols=("createdAt",))
    got = sorted((r._id, r.createdAt, r.name) for r in df.collect())
    assert got == [("65a0c0ffee0000000000beef", "2024-01-02T00:00:00.000Z", "b"),
                   ("plain-1", "2024-01-01T00:00:00Z", "a")]
    os.makedirs(f"{tmp_root}/lines")
    with open(f"{tmp_root}/lines/a.jsonl", "w", encoding="utf-8") as fh:
        fh.write('{"a": 1}\n\n{"a": \n   \n{"a": 2}\n')
    assert sorted(r.a for r in read_jsonl_tolerant(spark, f"{tmp_root}/lines", "a int").collect()) == [1, 2]


def test_a_rewritten_table_has_its_own_schema(spark, tmp_root):
    from orelake.session import table
    path = f"{tmp_root}/t.parquet"
    spark.range(3).write.parquet(path)
    assert table(spark, tmp_root, "t").columns == ["id"] and table(spark, tmp_root, "t").count() == 3
    spark.range(4).selectExpr("id AS k", "'x' AS v").write.mode("overwrite").parquet(path)
    assert table(spark, tmp_root, "t").columns == ["k", "v"] and table(spark, tmp_root, "t").count() == 4


def test_a_large_batch_is_the_first_rows_without_one_task_that_gathers_them(spark, monkeypatch):
    import random

    from orelake.operators import incremental_scan, watermark
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *"abcdefgh"]), i) for i in range(600)]
    src = spark.createDataFrame([(f"2024-01-{1 + d:02d} 00:00:00.5" if d is not None else None, t, i) for d, t, i in rows],
                                "wm string, tie string, i int").withColumn("wm", F.col("wm").cast("timestamp_ntz"))
    low = lambda r: (r[0] is not None, str(r[0]), r[1] is not None, r[1] or "")
    want = sorted(((r.wm, r.tie) for r in src.collect()), key=low)
    monkeypatch.setattr(watermark, "TOP_K", 5)
    for limit in (6, 37, 300, 599, 600, 900):
        batch = incremental_scan(src, "wm", None, tie="tie", limit=limit)
        assert sorted(((r.wm, r.tie) for r in batch.collect()), key=low) == want[:limit]
        assert "TakeOrdered" not in batch._jdf.queryExecution().executedPlan().toString()
    whole = src.filter("tie IS NOT NULL").dropDuplicates(["wm", "tie"])
    assert "Limit" not in incremental_scan(whole, "wm", None, tie="tie", limit=50)._jdf.queryExecution().executedPlan().toString()
    after = incremental_scan(src, "wm", "2024-01-10 00:00:00.5", tie="tie", limit=40, tie_wm="d")
    assert sorted(((r.wm, r.tie) for r in after.collect()), key=low) == [
        x for x in want if x[0] is not None and (x[0].day > 10 or x[0].day == 10 and x[1] is not None and x[1] > "d")][:40]
