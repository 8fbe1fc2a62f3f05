import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orelake.llm.packing import Plan, WordIds, default_vocabulary, pack_documents, sequences, tokenize_pieces
from orelake.llm.packing import pack as place
from tests.llm.helpers import empty, make, nasty


def library(t):
    return Tokenizer.from_file(default_vocabulary()).encode(t or "", add_special_tokens=False).ids


def placed_ok(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_pieces_are_the_librarys_ids(spark):
    rows = nasty()
    got = pack_documents(make(spark, rows)).collect()
    placed_ok(got, 2048)
    want = []
    for d, t in rows:
        ids = np.array(library(t) + [0], dtype="<u4")
        want += [(d, i // 2048, i, len(ids[i:i + 2048]), zlib.crc32(ids[i:i + 2048].tobytes())) for i in range(0, len(ids), 2048)]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBé'sS ,.1²\n\t_-<|>ßİǅ\x1c\xa0"), max_size=40), min_size=1, max_size=6))
def test_cached_words_equal_the_library(values):
    ids = WordIds(default_vocabulary())
    for _ in range(2):
        got = [np.frombuffer(x, dtype="<u4").tolist() for x in ids.encode(values)]
        assert got == [library(v) for v in values]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25))
def test_plan_places_every_piece_once_and_well(counts):
    plan = Plan(counts, 60)
    bins = {}
    for n, c in counts.items():
        seq, off = plan.place(np.full(c, n, dtype=np.int64), np.arange(c, dtype=np.int64))
        for s, o in zip(seq.tolist(), off.tolist()):
            bins.setdefault(s, []).append((o, n))
    for v in bins.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 60 and sum(3 * n > 60 for _, n in v) <= 2
    large, pairs = sorted(n for n, c in counts.items() for _ in range(c) if 3 * n > 60), 0
    while len(large) > 1:       # what the pieces above a third need at least: the largest with the smallest, if they fit
        fits = large[0] + large[-1] <= 60
        large, pairs = large[fits:-1], pairs + 1
    least = max(-(-sum(n * c for n, c in counts.items()) // 60), pairs + len(large))
    assert len(bins) == plan.bins <= 1.25 * least + 2


def test_hot_length_and_sequences(spark):
    docs = make(spark, [(i, "one two three" if i % 3 else "word " * (50 + i % 7)) for i in range(900)])
    pieces = tokenize_pieces(docs, capacity=64, keep_ids=True)
    got = place(pieces, capacity=64)
    rows = got.collect()
    n = placed_ok(rows, 64)
    assert n <= -(-sum(r.length for r in rows) // 64) * 1.25
    joined = {r.sequence_id: r.ids for r in sequences(got).collect()}
    for r in rows[:50]:
        assert joined[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_empty(spark):
    assert pack_documents(empty(spark)).count() == 0
