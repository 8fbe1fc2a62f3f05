import collections
import itertools
import random

import numpy as np

from orelake.llm.components import components
from orelake.llm.near_dedup import OrderMinHash, _common, _contracted, _numbered, aligned, near_duplicates, one_of_each, shingles
from tests.llm.helpers import empty, make, nasty, text


def in_order(a, b):
    """Words matched in order, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain(rows):
    """Class of each row by all pairs with 0.8 of their words matched in order."""
    w = [(t or "").encode().split() for _, t in rows]
    bags = [collections.Counter(x) for x in w]
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        total = len(w[a]) + len(w[b])
        most = sum((bags[a] & bags[b]).values())
        if label[a] == label[b] or most < 0.8 * (total - most) - 1e-9:
            continue
        n = most if w[a] == w[b] else in_order(w[a], w[b])
        if n >= 0.8 * (total - n) - 1e-9:
            lo, hi = sorted((label[a], label[b]))
            label = [lo if x == hi else x for x in label]
    ids = collections.defaultdict(list)
    for (d, _), c in zip(rows, label):
        ids[c].append(d)
    first = {c: min((d for d in v if d is not None), default=None) for c, v in ids.items()}
    return sorted(((str(d), str(first[c])) for (d, _), c in zip(rows, label)))


def edited(t, seed, n):
    w, rng = t.split(), random.Random(seed)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def sample():
    rows = [(i, text(i, 220, 3000)) for i in range(60)]
    for i in range(30):
        rows += [(100 + 10 * i + j, edited(rows[i][1], 10 * i + j, 4 * j)) for j in range(6)]  # up to 0.83 of the words
    passage = text(7777, 60, 3000)
    rows += [(1000 + i, text(3000 + i, 100, 3000) + " " + passage) for i in range(40)]
    return rows


def rows_moved():
    """A text, the same with its halves swapped (another text), and with its last tenth moved to the front (still alike)."""
    w = text(4242, 300, 3000).split()
    return [(9000, " ".join(w)), (9001, " ".join(w[150:] + w[:150])), (9002, " ".join(w[270:] + w[:270]))]


def test_classes_equal_all_pairs(spark):
    moved = rows_moved()
    rows = sample() + [(d if d is None else 5000 + d, t) for d, t in nasty()] + moved
    got = near_duplicates(make(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == plain(rows)
    kept = collections.Counter(str(r.class_id) for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({str(r.class_id) for r in got})


def test_large_groups_are_dealt_to_several_tasks(spark):
    base = text(5, 300, 3000)
    rows = [(i, edited(base, i, i % 25)) for i in range(150)]
    whole = sorted(map(tuple, near_duplicates(make(spark, rows)).collect()))
    dealt = sorted(map(tuple, near_duplicates(make(spark, rows), OrderMinHash(together=20)).collect()))
    assert whole == dealt
    assert sorted((str(d), str(c)) for d, c, _ in whole) == plain(rows)


def test_alignment_is_in_order_and_banded():
    h = np.arange(1, 101, dtype=np.uint64) * np.uint64(7919)
    assert aligned(h, h, 0.8) == 1.0
    moved = np.concatenate((h[50:], h[:50]))
    assert aligned(h, moved, 0.8) < 0.5
    repeated = shingles(np.tile(h[:6], 5))
    assert len(np.unique(repeated)) == len(repeated) == 28
    assert len(np.unique(_numbered(np.tile(h[:6], 5)))) == 30


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(3)
    for n in range(150):
        x = rng.integers(1, 40, rng.integers(0, 120)).astype(np.uint64)
        y = np.array([v if rng.random() > 0.1 else 99 for v in x if rng.random() > 0.05], dtype=np.uint64)
        total, m = len(x) + len(y), in_order(x.tolist(), y.tolist())
        want = m / (total - m) if total else 1.0
        got = aligned(x, y, 0.8)
        assert got == want if want >= 0.8 else got < 0.8


def test_long_texts_are_aligned_at_common_shingles():
    rng = np.random.default_rng(5)
    x = rng.integers(1, 3000, 60_000).astype(np.uint64)
    y = np.array([v if rng.random() > 0.05 else 5000 for v in x if rng.random() > 0.01], dtype=np.uint64)
    got = aligned(x, y, 0.8)
    m = _common(x[:6000].tolist(), y[:5940].tolist(), 600)
    assert abs(got - m / (11_940 - m)) < 0.02 and aligned(x, rng.permutation(y), 0.8) < 0.3


def test_a_shared_passage_makes_no_link(spark):
    """Many texts share half of their words; two pairs of them are alike.  Groups are dealt to several tasks, no link is lost."""
    passage = text(1, 120, 3000)
    rows = [(i, passage + " " + text(100 + i, 100, 3000)) for i in range(250)]
    rows += [(900 + i, edited(rows[i][1], i, 12)) for i in range(2)]
    got = near_duplicates(make(spark, rows), OrderMinHash(together=15)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == plain(rows)


def test_one_of_each_and_odd_tables(spark):
    docs = make(spark, [(3, "same words here"), (2, " same  words here"), (1, "other words there"), (None, None), (4, "")])
    out = one_of_each(docs)
    assert out.columns == docs.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4"]
    assert near_duplicates(empty(spark)).count() == 0 and one_of_each(empty(spark)).count() == 0


def test_contracted_links_have_the_same_components(spark):
    rng = random.Random(8)
    links = [(min(p), max(p)) for p in ((rng.randrange(400), rng.randrange(400)) for _ in range(330)) if p[0] != p[1]]
    links += [(1000 + i % 7, 2000 + j) for j in range(200) for i in range(7)]
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.label for r in components(_contracted(df)).collect()} == {r.node: r.label for r in components(df).collect()}
    assert _contracted(df).filter("a >= 1000").distinct().count() == 200 + 6


def test_components_of_chains_stars_and_nulls(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
