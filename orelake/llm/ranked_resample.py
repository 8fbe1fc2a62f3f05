"""Importance resampling towards a target text set: array-scored weights, exact ranks by regular sampling."""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import LOWER, slices, stored

_PART = 8 << 20
# Bytes of words are digits, letters and all of the non-ASCII range; every other byte parts words.
_WORD_BYTES = LOWER.copy()
_WORD_BYTES[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20
_LAST = (1 << 63) - 1


def _word_buckets(col: pa.Array, buckets: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature, number of features of each text); features are runs of 1 to ``run`` words.

    A distinct word is hashed once; longer runs are hashed one by one.
    """
    col = pc.fill_null(col, "")
    off = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1]
    raw = _WORD_BYTES[np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]]]
    clean = pa.Array.from_buffers(pa.string(), len(col), [None, pa.py_buffer((off - off[0]).tobytes()), pa.py_buffer(raw.tobytes())])
    split = pc.ascii_split_whitespace(clean)
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    edge = before[np.asarray(split.offsets) - split.offsets[0].as_py()]
    coded = words.filter(pa.array(full)).dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    at = coded.indices.to_numpy(zero_copy_only=False)
    own = np.fromiter((zlib.crc32(w) % buckets for w in distinct), dtype=np.int64, count=len(distinct))[at]
    n = np.diff(edge)
    if run == 1:
        return own, n
    found = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        w = [distinct[i] for i in at[a:b].tolist()]
        longer = [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in range(2, run + 1) for i in range(len(w) - k + 1)]
        found.append(np.concatenate((own[a:b], np.array(longer, dtype=np.int64))))
    return np.concatenate([*found, own[:0]]), np.array([len(x) for x in found], dtype=np.int64)


def bucket_counts(texts: DataFrame, buckets: int = 10_000, run: int = 1) -> np.ndarray:
    """Features per bucket over all rows of ``text``: a task sends one row per bucket it met, the driver gets ``buckets`` sums."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0, _PART):
                total += np.bincount(_word_buckets(part.column(0), buckets, run)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over its share in the raw texts."""
    add = float(len(raw))
    s, t = float(raw.sum()) + add, float(target.sum()) + add
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(raw.tolist(), target.tolist())],
                    dtype=np.int64)


def _noise(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln u)), u from the id's hash."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 2024, run: int = 1) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every document."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _PART):
                bucket, n = _word_buckets(part.column(1), len(gain), run)
                row = np.repeat(np.arange(len(n)), n)
                weight = np.bincount(row, weights=gain[bucket], minlength=len(n)).astype(np.int64)
                noise = np.array([_noise(d, seed) for d in part.column(0).to_pylist()], dtype=np.int64)
                words = n if run == 1 else _word_buckets(part.column(1), 1, 1)[1]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, words, weight, weight + noise))],
                                                 names=["doc_id", "n_features", "n_words", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, n_features long, n_words long, weight long, score long")


class Splitters:
    """Ascending (key, doc, place) triples that part an order into segments 0, 1, ...: a row's is the number of triples not above it."""

    def __init__(self, triples: list[tuple[int, int, int]]):
        self.triples = sorted(set(triples))
        self.keys = np.array([t[0] for t in self.triples], dtype=np.int64)

    def segment(self, key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        out, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        for i in np.flatnonzero(high > out).tolist():  # equal to some splitter's key
            row = (int(key[i]), int(doc[i]), int(place[i]))
            at = bisect_left(self.triples, row, int(out[i]), int(high[i]))
            out[i] = at + (at < len(self.triples) and self.triples[at] == row)
        return out

    def column(self) -> Column:
        """The segment as a column over key__, doc__ and place__."""
        @F.arrow_udf("int")
        def of(key: pa.Array, doc: pa.Array, place: pa.Array) -> pa.Array:
            return pa.array(self.segment(key.to_numpy(), doc.to_numpy(), place.to_numpy()).astype(np.int32))

        return of("key__", "doc__", "place__")


def regular_splitters(runs: DataFrame, total: int, segment: int) -> tuple[Splitters, list[int]]:
    """(splitters, rows before each segment) of locally sorted runs, so that no segment has over twice ``segment`` rows.

    Every run gives the rows at regular steps; the splitters are regular
    among all of these.  A count shows the segments that runs of another
    order made too long; these are sampled again at a smaller step.  Triples
    are unique, so any segment can be parted.  The driver gets some 16 rows
    a segment and one a run, and one count a segment.
    """
    step = max(1, segment // 16)
    index = F.col("place__").bitwiseAND((1 << 33) - 1)
    triple = ["key__", "doc__", "place__"]
    sample = sorted(map(tuple, runs.filter(index % step == step - 1).select(*triple).collect())) if total > segment else []
    cut = Splitters(sample[15::16])
    while True:
        rows = runs.select(cut.column().alias("segment__"))
        count = dict(map(tuple, rows.groupBy("segment__").count().collect()))
        long = [s for s, n in count.items() if n > 2 * segment]
        if not long or step == 1 and len(cut.triples) >= total - 1:
            break
        step = max(1, step // 8)
        inside = runs.withColumn("segment__", cut.column()).filter(F.col("segment__").isin(long) & (index % step == step - 1))
        more: dict[int, list] = {}
        for s, *t in sorted(map(tuple, inside.select("segment__", *triple).collect())):
            more.setdefault(s, []).append(tuple(t))
        cut = Splitters(cut.triples + [t for s, rows_ in more.items()
                                       for t in rows_[::max(1, len(rows_) * segment // (2 * count[s]))]])
    before, at = [], 0
    for s in range(len(cut.triples) + 1):
        before.append(at)
        at += count.get(s, 0)
    return cut, before


def ranked(runs: DataFrame, k: int, total: int, segment: int = 1 << 20) -> DataFrame:
    """The rows of ``runs`` with ``rank__``: 1 to ``k`` in ascending order of (key__, doc__, place__), null for the rest.

    Only segments that hold one of the first ``k`` ranks are exchanged; each
    is sorted where it arrives, its ranks start after the rows counted in the
    segments before it.
    """
    if k <= 0:
        return runs.withColumn("rank__", F.lit(None).cast("long"))
    cut, before = regular_splitters(runs, total, segment)
    last = max(s for s, n in enumerate(before) if n < k)
    inside: Column = F.lit(True)
    if last < len(cut.triples):
        a, b, c = cut.triples[last]
        inside = (F.col("key__") < a) | ((F.col("key__") == a) & ((F.col("doc__") < b) | ((F.col("doc__") == b) & (F.col("place__") < c))))
    columns = runs.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = -1, 0
        for batch in batches:
            s = batch.column(len(columns)).to_numpy()
            rank = np.empty(len(s), dtype=np.int64)
            edge = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
            for a, b in zip(edge[:-1], edge[1:]):
                if a == b:
                    continue
                if s[a] != now:
                    now, at = int(s[a]), before[int(s[a])]
                rank[a:b] = np.arange(at + 1, at + 1 + b - a)
                at += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rank, mask=rank > k)], names=[*columns, "rank__"])

    schema = runs.withColumn("rank__", F.lit(None).cast("long")).schema
    near = (runs.filter(inside).withColumn("segment__", cut.column()).repartitionById(last + 1, F.col("segment__"))
            .sortWithinPartitions("segment__", "key__", "doc__", "place__").mapInArrow(number, schema))
    return near.unionByName(runs.filter(~inside).withColumn("rank__", F.lit(None).cast("long")))


def target_resample(docs: DataFrame, target: DataFrame, percent: int = 10, buckets: int = 10_000, run: int = 1,
                    seed: int = 2024, least_words: int = 20, segment: int = 1 << 20) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document of ``docs``; ``target`` is a table with ``text``.

    The scored documents are written once as locally sorted runs (``score``
    descending, then doc_id, then the run's own order, so repeated rows get
    ranks of their own and may be parted).  ``percent`` of the documents with
    ``least_words`` words get ranks 1, 2, ..., the others a null rank.  Null
    and empty texts have no features and weigh 0.  A null id draws the noise
    of an empty one and comes after equal scores with an id.  Empty tables
    give no rows; an empty target only flattens the gains.
    """
    gain = gains(bucket_counts(docs, buckets, run), bucket_counts(target, buckets, run))
    rows = scored(docs, gain, seed, run).withColumns({
        "able__": F.col("n_words") >= least_words, "key__": -F.col("score"),
        "doc__": F.coalesce("doc_id", F.lit(_LAST))})
    rows = rows.sortWithinPartitions(F.col("able__").desc(), "key__", "doc__").withColumn("place__", F.monotonically_increasing_id())
    runs = stored(rows, "runs")
    able = runs.filter("able__")
    total = able.count()
    out = ranked(able, percent * total // 100, total, segment)
    rest = runs.filter("NOT able__").withColumn("rank__", F.lit(None).cast("long"))
    return out.unionByName(rest).select("doc_id", "n_features", "weight", "score", F.col("rank__").alias("rank"))
