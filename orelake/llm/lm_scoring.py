"""LM scoring by deleted interpolation: n-gram likelihoods mixed by context-frequency buckets."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import LOWER, mix, slices, stored, texts, word_hashes

BLOCK = 8 << 20  # bytes of text whose n-grams are counted together before they are sent
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
FOLDS, HELD_OUT, WEIGHING = 7, 2, 3  # remainders: scored only; left out of the likelihoods that the weights are learned on
DEPTH = 48  # context-frequency buckets: 0 (unseen), then by powers of two


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(block, parts): the task's rows (doc_id, text, fold) cut the same way at every pass."""
    task, n, parts, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for part in slices(batch, 1):
            parts.append(part)
            size += part.column(1).nbytes
            if size >= BLOCK:
                yield (task << 24) + n, parts
                n, parts, size = n + 1, [], 0
    if parts:
        yield (task << 24) + n, parts


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens per document, token hashes, hashes of the tokens before) of one part; each document ends in END."""
    raw = [(t.as_py() or "").encode() for t in part.column(1)]
    joined = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
    first = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])[:-1]))
    start, _, h = word_hashes(LOWER[joined])
    owner = np.searchsorted(first, start, side="right") - 1
    count = np.bincount(owner, minlength=len(raw)) + 1
    seq = np.empty(int(count.sum()), dtype=np.uint64)
    seq[np.arange(len(h)) + owner] = h
    last = np.cumsum(count) - 1
    seq[last] = END
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[last - count + 1] = START
    return count, seq, before


def _keys(seq: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odd keys for words, even ones for pairs of words."""
    with np.errstate(over="ignore"):
        return mix(seq, 5) | np.uint64(1), mix(before * np.uint64(0x9E3779B97F4A7C15) + seq, 6) & ~np.uint64(1)


def _pack(*arrays: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences, counts as four-byte integers, compressed."""
    keys, counts = arrays[0], arrays[1:]
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(
        struct.pack("<q", len(keys)) + planes.tobytes() + b"".join(_plane4(c) for c in counts))


def _plane4(c: np.ndarray) -> bytes:
    return c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _read4(raw: bytes, at: int, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = struct.unpack_from("<q", raw)[0]
    planes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(planes, dtype=np.uint64), _read4(raw, 8 + 8 * n, n), _read4(raw, 8 + 12 * n, n)


def _batch(schema: str, *cols) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


SENT = "bucket long, block long, data binary"
ANSWER = "block long, part long, data binary"


def _send(buckets: int):
    """Per block and bucket: the distinct n-gram keys, their training counts and those of the weighing fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _blocks(batches):
            keys, train, weigh = [], [], []
            for part in parts:
                count, seq, before = _tokens(part)
                fold = np.repeat(part.column(2).to_numpy(), count)
                for k in _keys(seq, before):
                    keys.append(k)
                    train.append(fold != HELD_OUT)
                    weigh.append(fold == WEIGHING)
            key, where = np.unique(np.concatenate(keys), return_inverse=True)
            n = [np.bincount(where, weights=np.concatenate(x), minlength=len(key)).astype(np.int64) for x in (train, weigh)]
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            turn = np.flatnonzero(np.diff(bucket, prepend=bucket[0] + np.uint64(1)))
            edge = [*turn.tolist(), len(key)]
            names, data = [], []
            for a, b in zip(edge, edge[1:]):
                names.append(int(bucket[a]))
                data.append(_pack(key[a:b], n[0][a:b], n[1][a:b]))
            yield _batch(SENT, names, [block] * len(names), data)

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the totals of each block's keys, in the block's order; block -1 has (V, N, N of the weighing fold)."""
    bucket, held = None, []

    def done() -> pa.RecordBatch:
        got = [_unpack(d) for _, d in held]
        key, where = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        total = [np.bincount(where, weights=np.concatenate([g[i] for g in got]), minlength=len(key)).astype(np.int64) for i in (1, 2)]
        word = (key & np.uint64(1)).astype(bool)
        blocks, data, at = [], [], 0
        for (block, _), g in zip(held, got):
            own = where[at:at + len(g[0])]
            at += len(g[0])
            raw = struct.pack("<q", len(own)) + _plane4(total[0][own]) + _plane4(total[1][own])
            blocks.append(block)
            data.append(zstandard.ZstdCompressor(level=1).compress(raw))
        sums = struct.pack("<3q", int((total[0][word] > 0).sum()), int(total[0][word].sum()), int(total[1][word].sum()))
        return _batch(ANSWER, [*blocks, -1], [bucket] * (len(blocks) + 1), [*data, sums])

    for batch in batches:
        for b, block, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if b != bucket and held:
                yield done()
                held = []
            bucket = b
            held.append((block, data))
    if held:
        yield done()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each block, compressed, as parts numbered below 0."""
    for block, parts in _blocks(batches):
        for i, part in enumerate(parts):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(part)
            yield _batch(ANSWER, [block], [i - (1 << 40)], [out.getvalue().to_pybytes()])


COUNTED = "doc_id long, fold int, n_tokens long, n_known long, base_score double, counts binary"


def _count_tokens(v: int, n: int):
    """Rows sorted by block and part -> per document its tokens' training counts, words and pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, totals = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            got = [_tokens(p) for p in parts]
            keys = [_keys(seq, before) for _, seq, before in got]
            where = np.unique(np.concatenate([k for pair in keys for k in pair]), return_inverse=True)[1]
            train, weigh = (np.concatenate([t[i] for t in totals]) for i in (0, 1))
            at = 0
            for p, (count, seq, _) in zip(parts, got):
                word, pair = where[at:at + len(seq)], where[at + len(seq):at + 2 * len(seq)]
                at += 2 * len(seq)
                cw, known = train[word], train[word] > 0
                own = np.repeat(np.arange(len(count)), count)
                base = np.bincount(own, weights=np.log10((cw + 1.0) / (n + v + 1.0)), minlength=len(count))
                n_known = np.bincount(own, weights=known, minlength=len(count)).astype(np.int64)
                fold = p.column(2).to_numpy()
                last = np.cumsum(count)
                data = []
                for a, b, f in zip((last - count).tolist(), last.tolist(), fold.tolist()):
                    cols = [cw[a:b], train[pair[a:b]]]
                    if f == WEIGHING:
                        cols += [weigh[word[a:b]], weigh[pair[a:b]]]
                    data.append(zstandard.ZstdCompressor(level=1).compress(b"".join(map(_plane4, cols))))
                yield _batch(COUNTED, p.column(0), p.column(2), count, n_known, base, data)

        for batch in batches:
            for b, i, data in zip(*[batch.column(j).to_pylist() for j in range(3)]):
                if b != block:
                    if parts:
                        yield from done()
                    block, parts, totals = b, [], []
                if i < 0:
                    parts.append(pa.ipc.open_stream(data).read_next_batch())
                else:
                    raw = zstandard.ZstdDecompressor().decompress(data)
                    m = struct.unpack_from("<q", raw)[0]
                    totals.append((_read4(raw, 8, m).astype(np.int64), _read4(raw, 8 + 4 * m, m).astype(np.int64)))
        if parts:
            yield from done()

    return run


def _columns(data: bytes, n: int, k: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return [_read4(raw, 4 * n * i, n).astype(np.int64) for i in range(k)]


def _context(cw: np.ndarray) -> np.ndarray:
    """Count of each token's predecessor; the start stands before as many tokens as the end is found."""
    return np.concatenate((cw[-1:], cw[:-1]))


def _bucket(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, np.minimum(DEPTH - 1, 1 + np.log2(np.maximum(c, 1)).astype(np.int64)), 0)


@dataclass(frozen=True)
class Mixture:
    """Training totals and, per context-frequency bucket, the weights of pair, word and uniform likelihood."""

    train_tokens: int
    distinct: int
    weights: np.ndarray

    def score(self, cw: np.ndarray, c2: np.ndarray) -> float:
        """log10 probability of a text from its tokens' word and pair counts."""
        cv = _context(cw)
        w = self.weights[_bucket(cv)]
        p = w[:, 0] * c2 / np.maximum(cv, 1) + w[:, 1] * cw / max(self.train_tokens, 1) + w[:, 2] / (self.distinct + 1)
        return float(np.log10(p).sum())


def learn_weights(cells: np.ndarray, distinct: int, rounds: int = 30) -> np.ndarray:
    """Expectation-maximisation over rows (bucket, pair likelihood, word likelihood, tokens).

    Buckets without held-out tokens take the weights learned on all tokens;
    each weight is at least 1e-6, so no text has probability 0.
    """
    weights = np.full((DEPTH, 3), 1 / 3)
    if len(cells):
        bucket, like = cells[:, 0].astype(int), np.column_stack((cells[:, 1], cells[:, 2], np.full(len(cells), 1 / (distinct + 1))))
        count = cells[:, 3]

        def fit(w: np.ndarray, at: np.ndarray) -> np.ndarray:
            for _ in range(rounds):
                part = w[at] * like
                part *= (count / part.sum(axis=1))[:, None]
                w = np.column_stack([np.bincount(at, weights=part[:, j], minlength=len(w)) for j in range(3)])
                w = np.maximum(w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300), 1e-6)
                w /= w.sum(axis=1, keepdims=True)
            return w

        every = fit(np.full((1, 3), 1 / 3), np.zeros(len(cells), dtype=int))[0]
        some = np.isin(np.arange(DEPTH), bucket)
        weights = np.where(some[:, None], fit(weights, bucket), every)
    return weights


def _cells(n_rest: int, fine: int = 20):
    """Held-out tokens by bucket and (logarithmically rounded) likelihoods under counts without their fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cw, c2, xw, x2 = _columns(data, n, 4)
                cw, c2 = cw - xw, c2 - x2
                cv = _context(cw)
                like = [np.where(c > 0, np.rint(fine * np.log10(np.maximum(c, 1) / np.maximum(d, 1))), -32_768).astype(np.int64)
                        for c, d in ((c2, cv), (cw, n_rest))]
                found.append((_bucket(cv) << 32) | ((like[0] + 32_768) << 16) | (like[1] + 32_768))
            cell, n = np.unique(np.concatenate(found), return_counts=True)
            yield _batch("cell long, n long", cell, n)

    return run


def lm_score(docs: DataFrame, bucket_bytes: int = 4 << 20, fine: int = 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens are the ASCII-lower-cased words and one end per document.  The model
    learns from documents whose crc32(doc_id as text) mod 7 is not 2: pair,
    word and uniform likelihoods, mixed with weights that depend on how often
    the word before was seen.  The weights are learned by
    expectation-maximisation on the documents with remainder 3, under counts
    that leave these out; for it, likelihoods are rounded to 1 / ``fine`` of a
    power of ten, so the cells that reach the driver are bounded.

    Counting is an exchange.  Each block of documents sends its distinct
    n-gram keys (64-bit hashes) with counts to one of about text bytes /
    ``bucket_bytes`` buckets; a frequent n-gram arrives once per block.  The
    bucket adds up and answers with the totals in the order asked.  Blocks
    then meet their answers and note the counts of each document's tokens,
    from which weights and scores follow.

    Null and empty texts are the end alone; a null doc_id counts as the empty
    text; repeated rows count and are scored as rows of their own.  ``docs``
    should be a scan or a written table, read twice in the same order.
    """
    fold = F.expr(f"CAST(crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)) % {FOLDS} AS INT)")
    rows = texts(docs).withColumn("fold", fold)
    size = rows.select(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(64, -(-size // bucket_bytes))
    sent = rows.mapInArrow(_send(buckets), SENT)
    answers = stored(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answer, ANSWER), "lm-answers")
    sums = np.array([struct.unpack("<3q", r["data"]) for r in
                     answers.filter("block = -1").select("data").collect()], dtype=np.int64).reshape(-1, 3).sum(axis=0)
    distinct, total, weighing = (int(x) for x in sums)
    met = rows.mapInArrow(_texts, ANSWER).unionByName(answers.filter("block >= 0"))
    counted = stored(met.repartition("block").sortWithinPartitions("block", "part")
                     .mapInArrow(_count_tokens(distinct, total), COUNTED), "lm-counts")
    cells = (counted.filter(F.col("fold") == WEIGHING).select("n_tokens", "counts")
             .mapInArrow(_cells(max(total - weighing, 1), fine), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    cell = cells["cell"].to_numpy()
    like = [np.where(x == 0, 0.0, 10.0 ** ((x - 32_768) / fine)) for x in ((cell >> 16) & 0xFFFF, cell & 0xFFFF)]
    learned = np.column_stack((cell >> 32, *like, cells["n"].to_numpy()))
    model = Mixture(total, distinct, learn_weights(learned, distinct))

    @F.arrow_udf("double")
    def score(n: pa.Array, data: pa.Array) -> pa.Array:
        return pa.array([model.score(*_columns(d.as_py(), m.as_py(), 2)) for m, d in zip(n, data)], pa.float64())

    return counted.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
                          F.lit(total).cast("long").alias("train_tokens"), "base_score",
                          score("n_tokens", "counts").alias("score"))
