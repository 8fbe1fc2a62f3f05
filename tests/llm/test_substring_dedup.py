import hashlib
import re

from orelake.llm import substring_dedup
from orelake.llm.substring_dedup import kept_digest, remove_repeats
from tests.llm.helpers import empty, make, nasty, text


def plain(rows, n=13):
    words = [[x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x] for _, t in rows]
    key = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for k, w in zip(key, words):
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            least[g] = min(least.get(g, k), k)
    out = []
    for (d, _), k, w in zip(rows, key, words):
        gone = {j for i in range(len(w) - n + 1) if least[tuple(w[i:i + n])] < k for j in range(i, i + n)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def both(spark, rows, **kw):
    got = sorted((tuple(r) for r in kept_digest(remove_repeats(make(spark, rows), **kw)).collect()), key=str)
    assert got == plain(rows)


def test_equal_to_a_plain_version(spark):
    shared = [text(100 + i, 40) for i in range(3)]
    rows = nasty()
    for i in range(40):
        parts = [text(1000 + i, 30)] + [shared[j] for j in range(3) if (i + j) % 2] + [text(2000 + i, 25)]
        rows.append((100 - i, "\n ".join(parts)))
    rows += [(200, "a " * 300), (201, "b a " * 100 + "a " * 100), (202, "a " * 100)]
    both(spark, rows)


def test_small_memory_sends_in_parts(spark, monkeypatch):
    rows = [(i % 50, text(i % 20, 60) + " " + text(500 + i, 20)) for i in range(80)]
    both(spark, rows, bucket_bytes=1 << 10)
    monkeypatch.setattr(substring_dedup, "LONGEST", 3)
    both(spark, rows)


def test_empty(spark):
    assert remove_repeats(empty(spark)).count() == 0
