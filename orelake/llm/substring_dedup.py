"""Substring dedup: super-k-mers by minimiser, windows counted exactly in each bucket."""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import mix, slices, texts, word_hashes

GRAM = 3  # words of the grams among which a window's minimiser is chosen
LONGEST = 64  # windows of one packed string
HELD = 120_000  # packed strings that a task holds before it sends them
LAST = (1 << 63) - 1  # stands for a null doc_id: larger than any other
_SPAN = np.dtype([("row", "<i8"), ("start", "<i4"), ("n", "<i4")])


def _super_kmers(texts_: list[bytes], window: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(text number, first word, windows, minimiser, packed words) of all texts; words joined by one blank."""
    split = [t.split() for t in texts_]
    count = np.array([len(w) for w in split], dtype=np.int64)
    raw = b"\n".join(b" ".join(w) for w in split if w)
    start, end, h = word_hashes(np.frombuffer(raw, dtype=np.uint8))
    if len(start) < window:
        return
    owner = np.repeat(np.arange(len(split)), count)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    with np.errstate(over="ignore"):
        g = h[:len(h) - GRAM + 1].copy()
        for j in range(1, GRAM):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - GRAM + 1 + j]
        g = mix(g, 2)
    least = np.lib.stride_tricks.sliding_window_view(g, window - GRAM + 1).min(axis=1)
    at = np.flatnonzero(owner[:len(owner) - window + 1] == owner[window - 1:])
    if not len(at):
        return
    mins = least[at]
    turn = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (mins[1:] != mins[:-1]) | (owner[at[1:]] != owner[at[:-1]]))))
    size = np.diff(np.append(turn, len(at)))
    if size.max() > LONGEST:
        parts = -(-size // LONGEST)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        turn, size = np.repeat(turn, parts) + step * LONGEST, np.repeat(size, parts)
        size = np.minimum(LONGEST, size - step * LONGEST)
    a = at[turn]
    yield from zip(owner[a].tolist(), (a - first[owner[a]]).tolist(), size.tolist(), mins[turn].view(np.int64).tolist(),
                   map(raw.__getitem__, map(slice, start[a].tolist(), end[a + size + window - 2].tolist())))


class _Sender:
    """Packed strings of one task, each once with the smallest document that has it; the rest is known to repeat."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.zip = zstandard.ZstdCompressor(level=3)
        self.held: dict[bytes, tuple] = {}  # packed -> (minimiser, document, [(row, first word), ...])
        self.known: list[tuple[int, int, int]] = []

    def add(self, doc: int, row: int, start: int, n: int, key: int, packed: bytes) -> None:
        have = self.held.get(packed)
        if have is None:
            self.held[packed] = (key, doc, [(row, start)])
        elif have[1] == doc:
            have[2].append((row, start))
        elif have[1] < doc:
            self.known.append((row, start, n))
        else:
            self.known.extend((r, s, n) for r, s in have[2])
            self.held[packed] = (key, doc, [(row, start)])

    def send(self) -> Iterator[pa.RecordBatch]:
        """One row per bucket met: (bucket, packed strings with their places); one for the known repeats."""
        by_bucket: dict[int, list] = defaultdict(list)
        for packed, (key, doc, places) in self.held.items():
            by_bucket[key % self.buckets].append((packed, doc, places))
        names, data = [], []
        for bucket, items in by_bucket.items():
            rows = [(i, d, r, s) for i, (_, d, places) in enumerate(items) for r, s in places]
            cols = np.array(rows, dtype=np.int64).T
            words_ = b"\n".join(p for p, _, _ in items)
            blob = struct.pack("<q", cols.shape[1]) + np.ascontiguousarray(cols).tobytes() + words_
            names.append(bucket)
            data.append(self.zip.compress(blob))
            if len(data) >= 256:
                yield _rows(names, False, data)
                names, data = [], []
        if data:
            yield _rows(names, False, data)
        if self.known:
            yield _rows([self.known[0][0] % self.buckets], True, [np.array(self.known, dtype=_SPAN).tobytes()])
        self.held.clear()
        self.known.clear()


def _rows(bucket: list[int], known: bool, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array([known] * len(data)), pa.array(data, pa.binary())],
                                      names=["bucket", "known", "data"])


def _send(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sender(window, buckets)
        for batch in batches:
            for part in slices(batch, 1):
                rows = part.column(2).to_pylist()
                docs = [LAST if d is None else d for d in part.column(0).to_pylist()]
                for i, start, n, key, packed in _super_kmers([(t or "").encode() for t in part.column(1).to_pylist()], window):
                    out.add(docs[i], rows[i], start, n, key, packed)
                if len(out.held) >= HELD:
                    yield from out.send()
        yield from out.send()

    return run


def _repeats(blobs: list[bytes], window: int) -> np.ndarray:
    """Spans of windows of one bucket whose words a smaller document has as well."""
    unzip = zstandard.ZstdDecompressor()
    places, packed, base = [], [], 0
    for blob in blobs:
        raw = unzip.decompress(blob)
        n = struct.unpack_from("<q", raw)[0]
        cols = np.frombuffer(raw, dtype=np.int64, count=4 * n, offset=8).reshape(4, n).copy()
        own = raw[8 + 32 * n:]
        cols[0] += base
        base += own.count(b"\n") + 1
        places.append(cols)
        packed.append(own)
    item, doc, row, first = np.concatenate(places, axis=1)
    raw = b"\n".join(packed)
    arr = np.frombuffer(raw, dtype=np.uint8)
    start, end, h = word_hashes(arr)
    lines = np.concatenate(([0], np.flatnonzero(arr == 10) + 1))
    owner = np.searchsorted(lines, start, side="right") - 1
    at = np.flatnonzero(owner[:len(owner) - window + 1] == owner[window - 1:])
    with np.errstate(over="ignore"):
        g = np.zeros(len(h) - window + 1, dtype=np.uint64)
        for j in range(window):
            g = g * np.uint64(0xD1342543DE82EF95) + h[j:len(h) - window + 1 + j]
    g = g[at]
    by_hash = np.argsort(g, kind="stable")
    same = g[by_hash][1:] == g[by_hash][:-1]
    often = np.zeros(len(g), dtype=bool)
    often[by_hash[1:][same]] = True
    often[by_hash[:-1][same]] = True
    # Only windows whose hash occurs twice can repeat; these are told apart by their very words.
    least_doc = np.full(base, LAST, dtype=np.int64)
    np.minimum.at(least_doc, item, doc)
    w = at[often]
    keys = list(map(raw.__getitem__, map(slice, start[w].tolist(), end[w + window - 1].tolist())))
    docs = least_doc[owner[w]].tolist()
    least: dict[bytes, int] = {}
    for k, d in zip(keys, docs):
        if d < least.get(k, LAST + 1):
            least[k] = d
    late = np.array([least[k] < d for k, d in zip(keys, docs)], dtype=bool)
    if not late.any():
        return np.empty(0, dtype=_SPAN)
    w = w[late]
    string = owner[w]
    offset = w - np.searchsorted(owner, string, side="left")
    turn = np.flatnonzero(np.concatenate(([True], (np.diff(w) != 1) | (string[1:] != string[:-1]))))
    runs = np.stack((string[turn], offset[turn], np.diff(np.append(turn, len(w)))), axis=1)
    order = np.argsort(item, kind="stable")
    lo, hi = np.searchsorted(item[order], runs[:, 0], "left"), np.searchsorted(item[order], runs[:, 0], "right")
    many = hi - lo
    pick = order[np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    out = np.empty(len(pick), dtype=_SPAN)
    out["row"], out["start"], out["n"] = row[pick], first[pick] + np.repeat(runs[:, 1], many), np.repeat(runs[:, 2], many)
    return out


def _find(window: int):
    def emit(span: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(span), 50_000):
            s = span[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(s[c].astype(t)) for c, t in (("row", "i8"), ("start", "i4"), ("n", "i4"))],
                                             names=["row", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            for b, known, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if known:
                    yield from emit(np.frombuffer(data, dtype=_SPAN))
                    continue
                if b != bucket and blobs:
                    yield from emit(_repeats(blobs, window))
                    blobs = []
                bucket = b
                blobs.append(data)
        if blobs:
            yield from emit(_repeats(blobs, window))

    return run


def _apply(window: int):
    """The words of a text that no repeated window covers."""
    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string>")
    def run(text: pa.Array, spans: pa.Array) -> pa.Array:
        unzip = zstandard.ZstdDecompressor()
        n, gone, kept = [], [], []
        for t, own in zip(text, spans):
            t, own = t.as_py(), own.as_py()
            w = unzip.decompress(t).split() if t else []
            if own:
                mark = np.zeros(len(w) + 1, dtype=np.int64)
                a = np.array([s["start"] for s in own])
                np.add.at(mark, a, 1)
                np.add.at(mark, a + np.array([s["n"] for s in own]) + window - 1, -1)
                stay = np.cumsum(mark)[:-1] == 0
                left = [x for x, s in zip(w, stay.tolist()) if s]
            else:
                left = w
            n.append(len(w))
            gone.append(len(w) - len(left))
            kept.append(b" ".join(left).decode())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                          names=["n_words", "n_removed", "kept"])

    return run


def zipped(text):
    """The UTF-8 bytes of a text column, compressed, so that a shuffle of whole texts stays small."""
    @F.arrow_udf("binary")
    def run(col: pa.Array) -> pa.Array:
        zip_ = zstandard.ZstdCompressor(level=3)
        return pa.array([zip_.compress((x.as_py() or "").encode()) for x in col], pa.binary())

    return run(text)


def remove_repeats(docs: DataFrame, window: int = 13, bucket_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and ``kept``, the words left, joined by one blank.

    A word goes if a window of ``window`` words that covers it also starts in
    a document with a smaller doc_id; windows are judged on the input.

    Consecutive windows with the same minimiser (least hash of their
    three-word grams) travel as one packed string.  Each task sends a string
    once, with the smallest document that has it, so a passage in any share of
    the documents reaches its bucket once per task.  A bucket (one of about
    text bytes / ``bucket_bytes``) sorts its window hashes and compares the
    words of equal ones.  The spans found go back to their rows, texts
    compressed for that shuffle.

    Null and empty texts have no words; a null doc_id counts as larger than
    all others; rows with equal ids do not make each other's windows repeats;
    a window repeated within one document alone stays.  ``docs`` should be a
    scan or a written table, as rows are numbered by place.
    """
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    size = docs.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(64, -(-size // bucket_bytes))
    sent = rows.mapInArrow(_send(window, buckets), "bucket long, known boolean, data binary")
    spans = (sent.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_find(window), "row long, start int, n int"))
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    packed = rows.select("row", "doc_id", zipped(F.col("text")).alias("z"))
    joined = packed.join(by_row, "row", "left")
    return joined.select("doc_id", _apply(window)(F.col("z"), F.col("spans")).alias("r")).select("doc_id", "r.*")


def kept_digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of :func:`remove_repeats`."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
