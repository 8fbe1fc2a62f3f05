"""Quality rules by compression bands: zstandard ratios of whole texts and of fixed chunks."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from math import log2

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import fresh, texts

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, chunk_low double, chunk_high double, kept boolean")


@dataclass(frozen=True)
class Bands:
    """Limits on (bytes / compressed bytes) by text length in bytes.

    ``low`` and ``high`` are (length, ratio) knots, read linearly in the
    logarithm of the length and flat beyond the ends.  They leave a margin of
    about 1 % beyond what texts labelled as good reach at each length;
    knots above 61,000 bytes come from such texts joined within a language.
    The longer a text, the more a compressor can reuse, hence the rise; it
    ends at a few million bytes, which is how far this level looks back.
    ``chunk_low`` / ``chunk_high`` bound every chunk of ``chunk`` bytes; the
    last one ends with the text and may overlap the one before.  A text
    shorter than a chunk is judged by the limits for its own length.
    """

    low: tuple[tuple[int, float], ...] = (
        (50, 0.50), (200, 1.00), (300, 1.28), (420, 1.285), (600, 1.335), (850, 1.445), (1200, 1.56), (1700, 1.655),
        (2400, 1.72), (3400, 1.83), (4800, 1.905), (6800, 1.985), (9600, 2.055), (13600, 2.13), (19200, 2.20),
        (27200, 2.225), (38400, 2.285), (54300, 2.31), (77000, 2.32), (308000, 2.345), (436000, 2.45), (2000000, 2.475))
    high: tuple[tuple[int, float], ...] = (
        (340, 1.95), (670, 1.97), (950, 2.05), (1350, 2.11), (1900, 2.19), (2700, 2.225), (3800, 2.29), (5400, 2.335),
        (7600, 2.41), (10800, 2.45), (15400, 2.47), (21800, 2.50), (30800, 2.55), (43400, 2.60), (61000, 2.64),
        (131000, 2.67), (200000, 2.70), (262000, 2.76), (500000, 2.83), (1000000, 2.87), (4000000, 2.89))
    chunk: int = 4096
    chunk_low: float = 1.92
    chunk_high: float = 2.32
    level: int = 3


def limit(knots: tuple[tuple[int, float], ...], size: int) -> float:
    """The band's limit at ``size`` bytes."""
    at = bisect_right(knots, size, key=lambda k: k[0])
    if at == 0:
        return knots[0][1]
    if at == len(knots):
        return knots[-1][1]
    (x0, y0), (x1, y1) = knots[at - 1], knots[at]
    return y0 + (y1 - y0) * log2(size / x0) / log2(x1 / x0)


def _repeat_words(w: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    grams = list(zip(w, w[1:], w[2:]))
    if len(set(grams)) == len(grams):
        return 0
    seen, twice = set(), set()
    for g in grams:
        (twice if g in seen else seen).add(g)
    total, reach = 0, 0
    for i, g in enumerate(grams):
        if g in twice:
            total += i + 3 - max(i, reach)
            reach = i + 3
    return total


def _measure(text: str | None, bands: Bands, zip_: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = text.encode()
    w = raw.split()
    blank = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    repeats = _repeat_words(w)
    failed = len(w) < 50 or 100 * repeats > 50 * len(w)
    ratio = len(raw) / len(zip_.compress(raw)) if raw else 0.0
    parts = [raw[i:i + bands.chunk] for i in range(0, len(raw) - bands.chunk + 1, bands.chunk)]
    if len(raw) > bands.chunk and len(raw) % bands.chunk:
        parts.append(raw[-bands.chunk:])
    each = [bands.chunk / len(zip_.compress(p)) for p in parts]
    inside = limit(bands.low, len(raw)) <= ratio <= limit(bands.high, len(raw)) if raw else False
    kept = not failed and inside and all(bands.chunk_low <= r <= bands.chunk_high for r in each)
    return (len(w), len(text) - blank, symbols, len(lines) - len(set(lines)), repeats, failed, ratio,
            min(each, default=None), max(each, default=None), kept)


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """Struct of the base counts and the verdict for a text column.

    Null and empty texts have no words: all counts 0, ``base_failed`` true,
    ``kept`` false.  ``chunk_low`` and ``chunk_high`` (least and largest chunk
    ratio) are null for texts shorter than one chunk.  Texts are read whole,
    one at a time; a text's verdict depends on nothing but itself, so ties,
    repeats and skew have no effect.
    """
    @F.arrow_udf(SCHEMA)
    def measure(col: pa.Array) -> pa.Array:
        zip_ = zstandard.ZstdCompressor(level=bands.level)
        rows = [_measure(x.as_py(), bands, zip_) for x in col]
        kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * 3 + [pa.bool_()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        cols = zip(*rows) if rows else [[] for _ in kinds]
        return pa.StructArray.from_arrays([pa.array(list(c), type=k) for c, k in zip(cols, kinds)], names=names)

    return measure(text)


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: doc_id, the base counts, the ratios and ``kept``; see :func:`quality`."""
    rows = texts(docs).withColumn("q", quality(F.col("text"), bands))
    return rows.select("doc_id", "q.*")


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns.  One scan, no shuffle."""
    q = fresh(docs, "quality__")
    return docs.withColumn(q, quality(F.col("text").cast("string"), bands)).filter(f"`{q}`.kept").drop(q)
