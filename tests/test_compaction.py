"""Closed days of the landed events in few files: rows equal at every moment, late files, clean-up."""

import glob
import json
import os

import pytest

from orelake.streaming.compaction import compact_closed_days, read_compacted, remove_packed
from orelake.streaming.course_feed import stream_to_bronze

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def land(spark, tmp_root, first, n):
    """``n`` topic files of events of three days, each its own micro-batch."""
    src, out = f"{tmp_root}/src", f"{tmp_root}/bronze"
    os.makedirs(src, exist_ok=True)
    for i in range(first, first + n):
        with open(f"{src}/{i:03d}.json", "w") as fh:
            for j, day in enumerate(DAYS):
                fh.write(json.dumps({"event_id": f"e{i}-{j}", "event_time": f"{day}T10:00:00Z", "course_id": f"c{i % 3}", "_offset": i}) + "\n")
    stream_to_bronze(spark, src, out, f"{tmp_root}/ckpt", options={"maxFilesPerTrigger": 1}, ingest_time_col="event_time").awaitTermination()
    return out


def events(df):
    return sorted((r.event_id, r.ingest_date) for r in df.collect())


def want(n):
    return sorted((f"e{i}-{j}", day) for i in range(n) for j, day in enumerate(DAYS))


def files(root, day):
    return glob.glob(f"{root}/ingest_date={day}/*/part-*")


def test_rows_stay_equal_and_files_become_few(spark, tmp_root):
    folder, root = land(spark, tmp_root, 0, 6), f"{tmp_root}/packed"
    assert events(read_compacted(spark, folder, root)) == want(6)
    reader = read_compacted(spark, folder, root)                     # opened before the commit, run after it
    assert compact_closed_days(spark, folder, root, before="2024-01-03") == DAYS[:2]
    assert events(reader) == events(read_compacted(spark, folder, root)) == want(6)
    assert [len(files(root, d)) for d in DAYS] == [1, 1, 0]
    assert compact_closed_days(spark, folder, root, before="2024-01-03") == []
    assert remove_packed(spark, folder, root) == 0                   # readers may still have them open
    assert remove_packed(spark, folder, root, older_than_s=-1) == 12
    assert events(read_compacted(spark, folder, root)) == want(6)
    land(spark, tmp_root, 6, 2)                                      # late files of the packed days
    assert events(read_compacted(spark, folder, root)) == want(8)
    assert compact_closed_days(spark, folder, root, before="2024-01-03", keep_s=0) == DAYS[:2]
    assert events(read_compacted(spark, folder, root)) == want(8)


def test_large_days_become_several_files(spark, tmp_root):
    folder, root = land(spark, tmp_root, 0, 8), f"{tmp_root}/packed"
    size = sum(os.path.getsize(f) for f in glob.glob(f"{folder}/ingest_date=2024-01-01/part-*"))
    compact_closed_days(spark, folder, root, before="2024-01-02", target_bytes=size // 3)
    assert 1 <= len(files(root, DAYS[0])) <= 4 and events(read_compacted(spark, folder, root)) == want(8)


def test_killed_before_the_commit(spark, tmp_root, monkeypatch):
    from orelake.sinks import tables
    folder, root = land(spark, tmp_root, 0, 3), f"{tmp_root}/packed"
    real = tables._point
    monkeypatch.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        compact_closed_days(spark, folder, root, before="2024-01-09")
    assert events(read_compacted(spark, folder, root)) == want(3)
    monkeypatch.setattr(tables, "_point", real)
    assert compact_closed_days(spark, folder, root, before="2024-01-09") == DAYS
    assert events(read_compacted(spark, folder, root)) == want(3)
