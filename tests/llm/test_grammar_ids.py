import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orelake.llm.grammar_ids import Grammar, fetch, joined_crc, re_pair, read_documents, read_shards, write_shards
from orelake.session import scratch_path
from tests.llm.helpers import empty, make, nasty, text
from tests.llm.test_packing import library


def plain(rows, end=2):
    """Every document in ascending doc_id order (nulls first): id, start, ids, checksum."""
    out, at = [], 0
    for d, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(library(t) + [end], dtype="<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def equal(got, want):
    """Same rows; documents of one id may change places among themselves."""
    got, want = [tuple(r)[:4] for r in got], list(want)
    bag = lambda rows: sorted(map(str, ((d, n, c) for d, _, n, c in rows)))
    assert bag(got) == bag(want)
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == [d for d, *_ in want]
    unique = {d for d in order if order.count(d) == 1}
    assert {r for r in got if r[0] in unique} == {r for r in want if r[0] in unique}


def written(spark, df, **kw):
    path = scratch_path(spark, "ids")
    write_shards(df, path, **kw)
    return path


def test_round_trip_of_odd_rows(spark):
    rows = nasty()
    path = written(spark, make(spark, rows))
    equal(read_documents(spark, path).collect(), plain(rows))


def test_many_files_small_shards_and_long_documents(spark):
    rows = nasty() + [(i, text(i % 9, 5 + i % 70)) for i in range(20, 160)]
    path = written(spark, make(spark, rows), files=5, shard=300)
    shards = read_shards(spark, path)
    assert shards.select("file").distinct().count() >= 4
    assert shards.filter("NOT whole").count() > 2 and shards.selectExpr("max(n_tokens)").first()[0] <= 300
    equal(read_documents(spark, path).collect(), plain(rows))


def test_one_id_with_a_third_of_the_rows_is_dealt_over_files(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 and i < 60 else i, f"text {i}") for i in range(300)]
    path = written(spark, make(spark, rows), files=10)
    spread = read_documents(spark, path).filter("doc_id = 7").select("file").distinct().count()
    assert spread >= 2
    equal(read_documents(spark, path).collect(), plain(rows))


def test_fetch_expands_the_wanted_documents_only(spark):
    rows = [(i, text(i % 5, 40)) for i in range(60)] + [(100, text(1, 900))]
    path = written(spark, make(spark, rows), files=2, shard=400)
    got = {}
    for r in sorted(fetch(spark, path, [3, 59, 100, 555]).collect(), key=lambda r: (r.doc_id, r.part)):
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == {i: library(dict(rows)[i]) + [2] for i in (3, 59, 100)}


def test_empty(spark):
    path = written(spark, empty(spark))
    assert read_documents(spark, path).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.sampled_from([7, 65_000]), st.sampled_from([None, 2]), st.data())
def test_grammar_gives_every_range_back(ids, vocabulary, end, data):
    ids = np.array(ids, dtype=np.uint32)
    g = re_pair(ids, vocabulary, end, least=2, spread=2, gain=0)
    assert g.decode().tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert g.decode(a, b).tolist() == ids[a:b].tolist()
    for r, (x, y) in enumerate(g.pairs.tolist()):   # rules use earlier symbols, and their stored lengths are true
        assert max(x, y) < vocabulary + r
        one = Grammar(vocabulary, g.pairs, g.lengths, np.array([vocabulary + r], dtype=g.symbols.dtype))
        assert len(one.decode()) == g.lengths[r]
    if end is not None:
        assert not (g.pairs == end).any()


def test_no_pair_is_left_that_is_frequent():
    ids = np.array([1, 2, 3, 4] * 500 + [5] * 301, dtype=np.uint32)
    g = re_pair(ids, 10, least=2, gain=0)
    pairs = list(zip(g.symbols[:-1].tolist(), g.symbols[1:].tolist()))
    assert g.decode().tolist() == ids.tolist() and len(g.symbols) < 30 and max(map(pairs.count, pairs)) < 3


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=90), st.binary(max_size=90))
def test_joined_checksums(a, b):
    assert joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_workers_forget_the_words_before_they_build_grammars(spark, tmp_root, monkeypatch):
    from orelake.llm import grammar_ids
    from orelake.llm.packing import _word_ids
    build = grammar_ids._shard_row

    def watched(*values):
        assert _word_ids.cache_info().currsize == 0
        return build(*values)

    monkeypatch.setattr(grammar_ids, "_shard_row", watched)
    docs = make(spark, [(i, f"some words {i}") for i in range(400)])
    stored_at = f"{tmp_root}/docs"
    docs.repartition(8).write.parquet(stored_at)
    grammar_ids.write_shards(spark.read.parquet(stored_at), f"{tmp_root}/ids", files=8)
    assert grammar_ids.read_documents(spark, f"{tmp_root}/ids").count() == 400
