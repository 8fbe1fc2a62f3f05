"""Structured Streaming: malformed lines, restart from checkpoint, de-duplication, replay-safe upsert."""

import json
import os

from orelake.sinks import read_current
from orelake.streaming.course_feed import (BRONZE_EVENT_SCHEMA, decode_topic_records, dedupe_stream,
                                           stream_to_bronze, upsert_stream)


def _event(i, course, name, ts, offset):
    return {"event_id": f"e{i}", "event_time": ts, "course_id": course, "course_name": name, "event_type": "upsert",
            "created_at": "", "updated_at": ts, "_topic": "t", "_partition": 0, "_offset": offset}


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_to_bronze_skips_bad_lines_and_resumes(spark, tmp_root):
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    _land(src, "a.json", [json.dumps(_event(1, "c1", "A", "2024-01-01T10:00:00Z", 1)), "", "{broken",
                          json.dumps(_event(2, "c2", "B", "2024-01-02T10:00:00Z", 2))])
    stream_to_bronze(spark, src, out, ckpt, ingest_time_col="event_time").awaitTermination()
    read = lambda: spark.read.schema(BRONZE_EVENT_SCHEMA + ", ingest_date string").json(out)
    assert sorted(r.event_id for r in read().collect()) == ["e1", "e2"]
    assert sorted(r.ingest_date for r in read().collect()) == ["2024-01-01", "2024-01-02"]
    # restart: old file is not read again, only the new one
    _land(src, "b.json", [json.dumps(_event(3, "c1", "A2", "2024-01-03T10:00:00Z", 3))])
    stream_to_bronze(spark, src, out, ckpt, ingest_time_col="event_time").awaitTermination()
    assert sorted(r.event_id for r in read().collect()) == ["e1", "e2", "e3"]


def test_dedupe_stream_drops_redeliveries(spark, tmp_root):
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/out", f"{tmp_root}/ckpt"
    e1 = _event(1, "c1", "A", "2024-01-01T10:00:00Z", 1)
    e1b = dict(e1, event_id="e1-again")
    _land(src, "a.json", [json.dumps(e1), json.dumps(e1b)])
    dedupe_stream(spark, src, out, ckpt).awaitTermination()
    _land(src, "b.json", [json.dumps(dict(e1, event_id="e1-third")), json.dumps(_event(2, "c2", "B", "2024-01-02T00:00:00Z", 2))])
    dedupe_stream(spark, src, out, ckpt).awaitTermination()
    assert sorted(r.course_id for r in spark.read.parquet(out).collect()) == ["c1", "c2"]


def test_dedupe_stream_keeps_a_late_first_delivery(spark, tmp_root):
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/out", f"{tmp_root}/ckpt"
    late = _event(2, "c2", "Late", "2024-01-01T00:00:00Z", 2)
    _land(src, "a.json", [json.dumps(_event(1, "c1", "A", "2024-03-01T10:00:00Z", 1))])
    dedupe_stream(spark, src, out, ckpt).awaitTermination()
    for name in ("b.json", "c.json"):                 # two months late, then repeated
        _land(src, name, [json.dumps(late), json.dumps(dict(late, course_id=None))])
        dedupe_stream(spark, src, out, ckpt).awaitTermination()
    assert sorted(str(r.course_id) for r in spark.read.parquet(out).collect()) == ["None", "c1", "c2"]


def test_merge_does_not_depend_on_the_cut(spark):
    """Same-day events, the later delivery with an older or blank change time: the last delivered wins in any cut."""
    from itertools import permutations

    from orelake.streaming.course_feed import merge_courses
    rows = [("c1", "First", "2024-01-05T00:00:00Z", "2024-01-06T01:00:00Z", 1), ("c1", "Mid", "2024-01-09T00:00:00Z", "2024-01-06T02:00:00Z", 2),
            ("c1", "Last", "", "2024-01-06T02:00:00Z", 3)]
    ddl = "course_id string, course_name string, updated_at string, _ingested_at string, _offset long"
    df = lambda r: spark.createDataFrame([(*x[:5],) for x in r], ddl).selectExpr("*", "'2024-01-01' AS created_at")
    for order in permutations(rows):
        state = None
        for r in order:
            state = merge_courses(state, df([r]))
        got = state.first()
        assert (got.course_name, str(got.created_at)) == ("Last", "2024-01-01 00:00:00")
    assert merge_courses(None, df(rows)).first().course_name == "Last"


def test_publish_courses_resumes_from_the_stored_cursor(spark, tmp_root):
    from orelake.sinks import write_version
    from orelake.streaming.producer import publish_courses
    topic, state = f"{tmp_root}/topic", f"{tmp_root}/cursor"
    docs = spark.createDataFrame([(f"{i:024x}", f"n{i}" if i % 2 else None, f"t{i}") for i in range(1, 8)], "_id string, course_name string, title string")
    assert publish_courses(spark, docs.filter("_id <= '000000000000000000000004'"), topic, state, "2024-02-01 00:00:00", batch_size=3) == 4
    assert publish_courses(spark, docs, topic, state, "2024-02-01 00:00:00", batch_size=2) == 3
    assert publish_courses(spark, docs, topic, state, "2024-02-01 00:00:00") == 0
    got = {r.course_id: r.course_name for r in spark.read.json(topic).collect()}
    assert len(got) == spark.read.json(topic).count() == 7 and got[f"{2:024x}"] == "t2" and got[f"{3:024x}"] == "n3"
    write_version(spark.createDataFrame([("nonsense", "x")], "cursor string, published_at string"), state)
    assert publish_courses(spark, docs, f"{tmp_root}/again", state, "2024-02-01 00:00:00") == 7


def test_upsert_stream_is_replay_safe(spark, tmp_root):
    src, bronze, table = f"{tmp_root}/src", f"{tmp_root}/bronze", f"{tmp_root}/dim"
    _land(src, "a.json", [json.dumps(_event(1, "c1", "Old", "2024-01-01T10:00:00Z", 1)),
                          json.dumps(_event(2, "c1", "New", "2024-01-02T10:00:00Z", 2)),
                          json.dumps(_event(3, " ", "Blank", "2024-01-02T10:00:00Z", 3))])
    stream_to_bronze(spark, src, bronze, f"{tmp_root}/c1", ingest_time_col="event_time").awaitTermination()
    upsert_stream(spark, bronze, table, f"{tmp_root}/c2").awaitTermination()
    first = sorted((r.course_id, r.course_name) for r in read_current(spark, table).collect())
    assert first == [("c1", "New")]
    # the same bronze replayed through a fresh checkpoint leaves the table unchanged
    upsert_stream(spark, bronze, table, f"{tmp_root}/c3").awaitTermination()
    assert sorted((r.course_id, r.course_name) for r in read_current(spark, table).collect()) == first


def test_decode_topic_records(spark):
    recs = spark.createDataFrame([(json.dumps(_event(1, "c1", "A", "2024-01-01T00:00:00Z", 0)).encode(), "t", 3, 17)],
                                 "value binary, topic string, partition int, offset long")
    r = decode_topic_records(recs).first()
    assert (r.event_id, r.course_id, r._topic, r._partition, r._offset) == ("e1", "c1", "t", 3, 17)


def test_processing_time_trigger_tails_new_files(spark, tmp_root):
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    _land(src, "a.json", [json.dumps(_event(1, "c1", "A", "2024-01-01T10:00:00Z", 1))])
    q = stream_to_bronze(spark, src, out, ckpt, trigger={"processingTime": "1 second"}, ingest_time_col="event_time")
    try:
        q.processAllAvailable()
        _land(src, "b.json", [json.dumps(_event(2, "c2", "B", "2024-01-02T10:00:00Z", 2))])
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    got = sorted(r.event_id for r in spark.read.schema(BRONZE_EVENT_SCHEMA + ", ingest_date string").json(out).collect())
    assert got == ["e1", "e2"]


def test_dedupe_cost_follows_the_batch(spark, tmp_root):
    """A micro-batch looks up and adds its own keys only, and reads nothing of the output."""
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/out", f"{tmp_root}/ckpt"
    _land(src, "a.json", [json.dumps(_event(i, f"c{i}", "A", "2024-01-01T10:00:00Z", i)) for i in range(500)])
    dedupe_stream(spark, src, out, ckpt, partitions=2).awaitTermination()
    _land(src, "b.json", [json.dumps(_event(i, f"c{i}", "A", "2024-01-01T10:00:00Z", i)) for i in range(498, 503)])
    q = dedupe_stream(spark, src, out, ckpt)
    q.awaitTermination()
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 503 and state["numRowsUpdated"] == 3 and state["numShufflePartitions"] == 2
    assert any("rocksdb" in k for k in state["customMetrics"])
    assert spark.read.parquet(out).count() == 503
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider") is False


def test_a_replay_and_late_events_rewrite_no_bucket(spark, tmp_root):
    bronze, table = f"{tmp_root}/bronze", f"{tmp_root}/table"
    at = lambda i, c, n, t: json.dumps(dict(_event(i, c, n, t, i), _ingested_at=t))
    _land(f"{bronze}/ingest_date=2024-01-02", "a.json", [at(1, "c1", "New", "2024-01-02T10:00:00Z"), at(2, "c2", "B", "2024-01-02T10:00:00Z")])
    upsert_stream(spark, bronze, table, f"{tmp_root}/ckpt", partitions=2, keep_s=0).awaitTermination()
    pointers = sorted(os.listdir(f"{table}/_pointers"))
    _land(f"{bronze}/ingest_date=2024-01-01", "late.json", [at(0, "c1", "Old", "2024-01-01T10:00:00Z")])
    upsert_stream(spark, bronze, table, f"{tmp_root}/ckpt", keep_s=0).awaitTermination()            # late
    upsert_stream(spark, bronze, table, f"{tmp_root}/other", partitions=2, keep_s=0).awaitTermination()  # all again
    assert sorted(os.listdir(f"{table}/_pointers")) == pointers
    assert sorted((r.course_id, r.course_name) for r in read_current(spark, table).collect()) == [("c1", "New"), ("c2", "B")]


def test_many_micro_batches_leave_a_constant_number_of_folders(spark, tmp_root):
    from orelake.session import hadoop_path, scratch_path
    bronze, table = f"{tmp_root}/bronze", f"{tmp_root}/table"
    for i in range(10):
        t = f"2024-01-02T10:00:{i:02d}Z"
        _land(f"{bronze}/ingest_date=2024-01-02", f"{i}.json", [json.dumps(dict(_event(i, f"c{i % 2}", f"N{i}", t, i), _ingested_at=t))])
    scratch = os.path.dirname(hadoop_path(spark, scratch_path(spark, "x"))[1].toUri().getPath())
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    upsert_stream(spark, bronze, table, f"{tmp_root}/ckpt", options={"maxFilesPerTrigger": 1}, partitions=2, keep_s=0).awaitTermination()
    assert len(os.listdir(f"{table}/_pointers")) <= 2
    assert len([n for n in os.listdir(table) if n.startswith("v-")]) <= 4
    assert (set(os.listdir(scratch)) if os.path.exists(scratch) else set()) <= before
    assert sorted((r.course_id, r.course_name) for r in read_current(spark, table).collect()) == [("c0", "N8"), ("c1", "N9")]
