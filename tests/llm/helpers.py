"""Small tables with everything that may go wrong, and plain versions of shared rules."""

import random

EXTRA = ", kept boolean, row long, n_words long, label string, score double, q string, key__ string"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows, extra=True):
    """Documents from (doc_id, text[, source]) with further columns whose names the operators use inside."""
    full = []
    for r in rows:
        d, t, s = (*r, "src0")[:3]
        full.append((d, t, "en", s, len(t) if t is not None else None) + ((True, 7, 1, "x", 0.5, "q", "k") if extra else ()))
    return spark.createDataFrame(full, DDL + (EXTRA if extra else ""))


def text(seed, n, vocabulary=400):
    """``n`` words from a made-up vocabulary."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def nasty():
    """Nulls, empty and blank texts, odd characters, one very long text, repeated rows and equal ids."""
    long = text(99, 30_000, 5000)
    return [(None, "a text without an id " * 5), (1, None), (2, ""), (3, " \n\t \x0b\x0c\r "), (4, "one"),
            (5, "Zażółć gęślą jaźń — “quotes” … 日本語 テキスト 😀 é   x\x1cy\xa0z ² ¼"),
            (6, long), (7, text(7, 60)), (7, text(7, 60)), (8, text(7, 60)), (9, "x" * 5000),
            (10, "<|endoftext|> a <|startoftext|>b<|endoftext|>"), (11, text(11, 200) + "\n" + text(11, 200)),
            (12, "Heat " * 400)]


def empty(spark):
    return make(spark, []).limit(0)
