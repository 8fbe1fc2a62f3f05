"""The commit log: compare-and-swap, rebase of overlapping writers, several tables at once, constraints, cleaning."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from orelake.session import hadoop_path, scratch_path
from orelake.sinks import (Commit, CommitConflict, ConstraintViolation, partitions, read_current, read_tables, remove_orphans,
                           tables, upsert, write_version)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def content(spark, root, **kw):
    return sorted(map(tuple, read_current(spark, root, **kw).collect()))


def interleave(monkeypatch, between):
    """Run ``between`` once, just before the next pointer is created."""
    real, todo = tables._point, [between]

    def point(*args):
        if todo:
            todo.pop()()
        return real(*args)
    monkeypatch.setattr(tables, "_point", point)


def bucket_of(spark, k, buckets):
    return frame(spark, [(k, "")]).select(tables._bucket(["k"], buckets)).first()[0]


def test_overlapping_upserts_both_survive(spark, tmp_root, monkeypatch):
    """Another writer commits between this one's read and its pointer: on other buckets, then on the same one."""
    root, n = f"{tmp_root}/t", 8
    upsert(spark, root, frame(spark, [(i, f"v{i}") for i in range(40)]), ["k"], buckets=n)
    one = 1
    other = next(k for k in range(2, 40) if bucket_of(spark, k, n) != bucket_of(spark, one, n))
    same = next(k for k in range(2, 400) if bucket_of(spark, k, n) == bucket_of(spark, one, n))
    want = {i: f"v{i}" for i in range(40)}
    for k in (other, same):
        interleave(monkeypatch, lambda: upsert(spark, root, frame(spark, [(k, "theirs")]), ["k"], buckets=n))
        out = upsert(spark, root, frame(spark, [(one, f"mine{k}")]), ["k"], buckets=n)
        want |= {k: "theirs", one: f"mine{k}"}
        assert dict(map(tuple, out.collect())) == want
    interleave(monkeypatch, lambda: upsert(spark, root, frame(spark, [(one, "theirs")]), ["k"], buckets=n))
    upsert(spark, root, frame(spark, [(one, "mine")]), ["k"], buckets=n)     # the same key: the later commit stays
    assert dict(content(spark, root)) == want | {one: "mine"}


def test_first_versions_at_once(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/t"
    interleave(monkeypatch, lambda: upsert(spark, root, frame(spark, [(1, "a"), (2, "b")]), ["k"]))
    upsert(spark, root, frame(spark, [(2, "B"), (3, "c")]), ["k"])
    assert content(spark, root) == [(1, "a"), (2, "B"), (3, "c")]


def test_many_writers(spark, tmp_root):
    root, errors = f"{tmp_root}/t", []

    def write(w):
        try:
            for i in range(3):
                upsert(spark, root, frame(spark, [(100 * w + i, f"{w}.{i}"), (7, f"{w}.{i}")]), ["k"], buckets=2)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = dict(content(spark, root))
    assert not errors and got.pop(7).endswith(".2")
    assert got == {100 * w + i: f"{w}.{i}" for w in range(1, 5) for i in range(3)}


def test_an_exclusive_write_refuses_a_changed_table(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/cursor"
    write_version(frame(spark, [(1, "a")]), root)
    interleave(monkeypatch, lambda: write_version(frame(spark, [(2, "b")]), root))
    with pytest.raises(CommitConflict):
        write_version(frame(spark, [(3, "c")]), root, exclusive=True)
    assert content(spark, root) == [(2, "b")]
    interleave(monkeypatch, lambda: write_version(frame(spark, [(4, "d")]), root))
    write_version(frame(spark, [(5, "e")]), root)
    assert content(spark, root) == [(5, "e")]


def test_newest_wins_whatever_the_order_of_commits(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/t"
    put = lambda *rows: upsert(spark, root, spark.createDataFrame(rows, "k int, t int, v string"), ["k"], buckets=2, newest=["t"])
    put((1, 5, "new"), (2, 1, "x"))
    number = len(glob.glob(f"{root}/v-*"))
    put((1, 5, "new"), (2, 1, "x"))             # a replay
    put((1, 4, "old"))                           # a late one
    assert len(glob.glob(f"{root}/v-*")) == number and content(spark, root) == [(1, 5, "new"), (2, 1, "x")]
    interleave(monkeypatch, lambda: put((1, 9, "theirs")))
    put((1, 7, "mine"), (2, 2, "y"))
    assert content(spark, root) == [(1, 9, "theirs"), (2, 2, "y")]


def test_several_tables_change_together(spark, tmp_root):
    root = f"{tmp_root}/gold"
    fact = lambda rows: spark.createDataFrame(rows, "day int, k int")
    with Commit(spark, root) as c:
        c.upsert(frame(spark, [(1, "a")]), ["k"], table="dim", buckets=4)
        c.replace(fact([(20240101, 1), (20240102, 1)]), "day", [20240101, 20240102], table="fact")
        assert read_current(spark, root, table="dim") is None and c.read("dim").count() == 1
    with pytest.raises(RuntimeError), Commit(spark, root) as c:
        c.upsert(frame(spark, [(1, "b")]), ["k"], table="dim", buckets=4)
        c.replace(fact([(20240102, 9)]), "day", [20240102], table="fact")
        raise RuntimeError("killed")
    got = read_tables(spark, root)
    assert sorted(map(tuple, got["dim"].collect())) == [(1, "a")]
    assert sorted(map(tuple, got["fact"].collect())) == [(20240101, 1), (20240102, 1)]
    before = read_tables(spark, root)
    with Commit(spark, root, keep_s=3600) as c:
        c.replace(fact([(20240102, 5)]), "day", [20240101, 20240102], table="fact")
    assert content(spark, root, table="fact") == [(20240102, 5)] and partitions(spark, root, "fact") == ["20240102"]
    assert before["fact"].count() == 2          # the older version is still whole for its reader
    assert content(spark, root, table="fact", parts=[20240101]) == []
    with pytest.raises(ValueError), Commit(spark, root) as c:
        c.replace(fact([(20240103, 5)]), "day", [20240102], table="fact")


def test_a_day_filter_prunes_partitions(spark, tmp_root):
    with Commit(spark, f"{tmp_root}/g") as c:
        c.replace(spark.range(40).selectExpr("cast(id % 4 as int) day", "id k"), "day", [0, 1, 2, 3], table="fact")
    with Commit(spark, f"{tmp_root}/g") as c:
        c.replace(spark.range(8).selectExpr("2 day", "id k"), "day", [2], table="fact")
    df = read_current(spark, f"{tmp_root}/g", table="fact")
    assert df.filter("day = 2").count() == 8 and df.count() == 38
    plan = df.filter("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_constraints_stop_the_commit(spark, tmp_root):
    root = f"{tmp_root}/t"
    upsert(spark, root, frame(spark, [(1, "a")]), ["k"])
    with pytest.raises(ConstraintViolation, match="repeated key \\(3,\\)"):
        upsert(spark, root, frame(spark, [(2, "b"), (3, "c"), (3, "d")]), ["k"])
    with pytest.raises(ConstraintViolation, match="null in k"):
        upsert(spark, root, frame(spark, [(None, "b")]), ["k"])
    for rows, what in (([(1, 1, "x"), (1, 1, "y")], "repeated key \\(1, 1\\)"), ([(1, None, "x")], "null in k"), ([(1, 2, None)], "null in v")):
        with pytest.raises(ConstraintViolation, match=what), Commit(spark, root) as c:
            c.upsert(frame(spark, [(9, "never")]), ["k"])
            c.replace(spark.createDataFrame(rows, "day int, k int, v string"), "day", [1], table="fact", keys=["day", "k"], required=["v"])
    assert content(spark, root) == [(1, "a")] and list(read_tables(spark, root)) == [""]


def test_commits_leave_a_constant_number_of_files(spark, tmp_root):
    root = f"{tmp_root}/t"
    scratch = os.path.dirname(hadoop_path(spark, scratch_path(spark, "x"))[1].toUri().getPath())
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    sizes = []
    for i in range(8):
        upsert(spark, root, frame(spark, [(i % 3, f"n{i}")]), ["k"], buckets=2)
        sizes.append((len(os.listdir(f"{root}/_pointers")), len(glob.glob(f"{root}/v-*/*/part-*"))))
    assert max(p for p, _ in sizes) == 2 and max(n for _, n in sizes) <= 3
    assert set(os.listdir(scratch) if os.path.exists(scratch) else []) <= before
    for i in range(4):
        upsert(spark, root, frame(spark, [(1, f"m{i}")]), ["k"], buckets=2, keep_s=3600)
    assert len(os.listdir(f"{root}/_pointers")) == 2 + 4


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_orphans_go_and_nothing_else(spark, tmp_root, scheme):
    root = f"{scheme}{tmp_root}/g"
    with Commit(spark, root) as c:
        c.upsert(frame(spark, [(1, "a")]), ["k"], table="dim")
        c.replace(spark.range(4).selectExpr("1 day", "id k"), "day", [1], table="fact")
    frame(spark, [(1, "x")]).write.parquet(f"{root}/dim/v-000000000009-dead")
    frame(spark, [(1, "x")]).write.parquet(f"{root}/fact/day=1/v__=v-000000000009-dead")
    assert remove_orphans(spark, root) == 0     # too young: they may belong to a running writer
    assert remove_orphans(spark, root, older_than_s=-1) == 2
    assert content(spark, root, table="dim") == [(1, "a")] and read_current(spark, root, table="fact").count() == 4


@pytest.mark.parametrize("local", [True, False])
def test_a_taken_name_is_refused(spark, tmp_root, local):
    for n in ("a", "b"):
        os.makedirs(f"{tmp_root}/{n}")
        open(f"{tmp_root}/{n}/part-00000", "w").write(n)
    assert tables._move_new(spark, f"{tmp_root}/a", f"{tmp_root}/dst", local)
    assert not tables._move_new(spark, f"{tmp_root}/b", f"{tmp_root}/dst", local)
    assert open(f"{tmp_root}/dst/part-00000").read() == "a" and os.listdir(f"{tmp_root}/dst").count("b") == 0


def test_a_pointer_of_unknown_form_raises(spark, tmp_root):
    root = f"{tmp_root}/t"
    upsert(spark, root, frame(spark, [(1, "a")]), ["k"])
    spark.range(1).select(F.lit("{}").alias("value")).coalesce(1).write.text(f"{root}/_pointers/000000000002")
    (part,) = glob.glob(f"{root}/_pointers/000000000002/part-*")
    os.rename(part, f"{root}/_pointers/000000000002/part-00000")
    with pytest.raises(ValueError):
        read_current(spark, root)
