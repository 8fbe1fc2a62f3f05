import base64
import os
import random

import pyarrow.parquet as pq
import zstandard

from orelake.llm.quality_rules import Bands, keep_good, limit, quality_rules
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty, make, nasty, text


def plain(t, bands=Bands()):
    t = t or ""
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t) if x]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if x.strip(" \t\n\r\x0b\x0c"):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_counts_equal_a_plain_version(spark):
    rows = [r for r in nasty() if r[0] not in (6,)] + [(20, "a b c\na b c\n\n  \nd a b c #$ |x|"), (21, "a a a a")]
    got = quality_rules(make(spark, rows)).collect()
    want = sorted(((d,) + plain(t) for d, t in rows), key=str)
    assert sorted((tuple(r)[:7] for r in got), key=str) == want
    assert all(not r.kept for r in got if r.base_failed)


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    import base64
    import random
    rng = random.Random(1)
    syllables = "an er on the re in ou ea th ti es nd".split()
    prose = " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(700))
    shout = " ".join(x.upper() + "!!" for x in prose.split()[:40]) + " "
    noise = " ".join(base64.b85encode(rng.randbytes(9)).decode() for _ in range(300))
    r = quality_rules(make(spark, [(1, prose)])).first()
    assert r.ratio == len(prose) / len(zstandard.ZstdCompressor(level=3).compress(prose.encode()))
    bands = Bands(low=((1, 0.8 * r.ratio),), high=((1, 1.1 * r.ratio),), chunk=1000, chunk_low=1.3, chunk_high=r.ratio)
    docs = make(spark, [(1, prose), (2, shout * 6), (3, noise), (4, prose + shout * 4)])
    assert {r.doc_id: r.kept for r in quality_rules(docs, bands).collect()} == {1: True, 2: False, 3: False, 4: False}


def test_limit_is_read_between_its_knots():
    knots = ((100, 1.0), (400, 2.0))
    assert [limit(knots, n) for n in (10, 100, 200, 400, 10**9)] == [1.0, 1.0, 1.5, 2.0, 2.0]


def test_keep_good_keeps_columns_and_empty_tables(spark):
    docs = make(spark, [(1, text(1, 300)), (2, "short")])
    assert keep_good(docs).columns == docs.columns
    assert keep_good(empty(spark)).count() == 0 and quality_rules(empty(spark)).count() == 0


def clean(size, lang="en", folder=SF_SMALL):
    """``size`` characters of joined texts that are labelled good, all different, of one language; ASCII in English."""
    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    rows = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    parts = {r["text"][:60]: r["text"] for r in rows if r["doc_id"] in good and r["lang"] == lang
             and (r["text"].isascii() or lang != "en") and len(r["text"].split()) >= 50}
    whole = "\n".join(parts.values())
    assert len(whole) >= size
    return whole[:size]


def noise(size):
    return base64.b64encode(random.Random(1).randbytes(size))[:size].decode()


def test_one_chunk_of_noise_is_rejected_at_production_parameters(spark):
    good, bands = clean(30 * 4096), Bands()
    docs = make(spark, [(1, good), (2, good[:16384] + noise(4096)), (3, good + noise(4096))])
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: False, 3: False}
    assert got[2].ratio < limit(bands.low, 20480) and got[3].chunk_low < bands.chunk_low


def test_noise_or_repetition_behind_the_last_whole_chunk_is_rejected(spark):
    good, bands = clean(30 * 4096), Bands()
    same = "again and again the same words " * 130
    docs = make(spark, [(1, good + good[:1000]), (2, good + noise(4000)), (3, good + same[:4000]), (4, good[:4000])])
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: False, 3: False, 4: True}
    assert all(limit(bands.low, 126880) <= got[d].ratio <= limit(bands.high, 126880) for d in (2, 3))
    assert got[2].chunk_low < bands.chunk_low and got[3].chunk_high > bands.chunk_high and got[4].chunk_low is None


def test_very_long_clean_documents_are_kept_and_repeated_ones_are_not(spark):
    folder = os.path.join(os.path.dirname(SF_SMALL), "sf0.1")
    rows = [(i, clean(n, lang, folder)) for i, (lang, n) in enumerate(
        [("de", 300_000), ("de", 1_000_000), ("fr", 300_000), ("fr", 1_000_000), ("es", 300_000), ("en", 1_000_000)])]
    rows += [(10, rows[0][1] * 2), (11, rows[5][1][:500_000] * 2)]
    got = {r.doc_id: r for r in quality_rules(make(spark, rows)).collect()}
    assert {d: r.kept for d, r in got.items()} == {d: d < 10 for d, _ in rows}
    assert all(r.ratio > 2.64 for d, r in got.items())
