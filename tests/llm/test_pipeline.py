import collections
import os
import shutil
import subprocess
import sys

import corpus_pipeline
import __spark_entry__ as entry
from pyspark.sql import functions as F
from orelake.llm import registry
from orelake.llm.common import stored
from orelake.llm.secret_scan import labelled_samples, scan, train
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty, make, nasty
from tests.llm.test_near_dedup import plain as classes
from tests.llm.test_packing import library, placed_ok
from tests.llm.test_quality_rules import plain as counts


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    good = stored(steps["quality_rules"](spark, docs, SF_SMALL), "t")
    base = {r.doc_id for r in docs.collect() if not counts(r.text)[5]}
    assert good.columns == columns and {r.doc_id for r in good.collect()} <= base
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert not [d for d in base - {r.doc_id for r in good.collect()} if labels.get(d) == 1]

    one = stored(steps["near_dedup"](spark, good, SF_SMALL), "t")
    want = {c for _, c in classes([(r.doc_id, r.text) for r in good.collect()])}
    assert one.columns == columns and {str(r.doc_id) for r in one.collect()} == want

    clean = stored(steps["secret_scans"](spark, one, SF_SMALL), "t")
    model = train(labelled_samples(one))
    before = {r.doc_id: r.text for r in one.collect()}
    for r in clean.collect():
        out, at = "", 0
        for a, _, b in scan(before[r.doc_id], model):
            if a >= at:
                out += before[r.doc_id][at:a] + "[secret]"
            at = max(at, b)
        assert r.text == out + before[r.doc_id][at:] and r.n_chars == len(r.text)

    mixed = stored(steps["source_mixing"](spark, clean, SF_SMALL), "t")
    assert mixed.columns == columns and sorted(mixed.collect()) == sorted(clean.collect())

    packed = steps["packing"](spark, mixed, SF_SMALL).collect()
    placed_ok(packed, 2048)
    size = collections.Counter()
    for r in packed:
        size[r.doc_id] += r.length
    assert size == {r.doc_id: len(library(r.text)) + 1 for r in mixed.collect()}
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(packed)


def test_odd_and_empty_tables_pass_every_stage(spark):
    for rows in (nasty(), []):
        for name, stage in corpus_pipeline.STAGES:
            docs = make(spark, rows) if rows else empty(spark)
            out = stage(spark, docs, "")
            assert out.count() >= 0 and (name == "packing" or out.columns == docs.columns)


def test_registry():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(names) <= set(entry.queries()) and set(registry.oracle_sql()) <= set(names)


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = os.path.dirname(entry.__file__)
    for f in ("__spark_entry__.py", "orelake"):
        src = os.path.join(root, f)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / f)
    shutil.rmtree(tmp_path / "orelake" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=120).returncode == 0


def test_sequences_follow_the_mix(spark):
    from tests.llm.helpers import text
    d = make(spark, [(i, text(i, 90, 5000), "big" if i % 4 else "small") for i in range(600)])
    mixed = stored(corpus_pipeline.source_mixing(spark, d, ""), "t")
    parts = {r.file: r.rows for r in mixed.selectExpr("doc_id", "_metadata.file_path file", "_metadata.row_index at").groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("at", "doc_id"))).alias("rows")).collect()}
    order = {x.doc_id: i for i, x in enumerate(x for f in sorted(parts) for x in parts[f])}
    packed = corpus_pipeline.packing(spark, mixed, "").collect()
    n = placed_ok(packed, 2048)
    assert sum(r.length for r in packed) / 2048 / n > 0.9
    place = {r.doc_id: r.sequence_id for r in packed if r.piece == 0}
    first = sorted(place, key=place.get)[:len(place) // 2]
    assert sum(order[x] < len(order) // 2 for x in first) > 0.9 * len(first)
    other = stored(mixed.orderBy(F.desc("doc_id")), "t")
    assert {(r.doc_id, r.sequence_id) for r in corpus_pipeline.packing(spark, other, "").collect()} != {(r.doc_id, r.sequence_id) for r in packed}
