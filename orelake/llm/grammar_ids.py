"""Token ids as binary shards under a grammar (Re-Pair), with expansion lengths for random-access decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.llm.common import slices
from orelake.llm.packing import _PART, _tokenizer, _word_ids, default_vocabulary, free_words

SHARD = 1 << 20  # ids under one grammar at most
SHARDS = ("file int, shard int, whole boolean, base long, n_tokens long, first_start long, doc_ids array<long>, "
          "counts array<long>, vocabulary long, width int, pairs binary, lengths binary, symbols binary")
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, file int, shard int"
_SLOTS = 20  # bits of the table that finds chosen pairs


@dataclass(frozen=True)
class Grammar:
    """Symbols below ``vocabulary`` are ids; symbol ``vocabulary + r`` stands for ``pairs[r]``, ``lengths[r]`` ids long."""

    vocabulary: int
    pairs: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def _unfold(self, symbols: np.ndarray) -> np.ndarray:
        """Rules applied to all symbols at once, until only ids are left."""
        while True:
            rule = symbols >= self.vocabulary
            if not rule.any():
                return symbols
            which = symbols[rule] - self.vocabulary
            out = np.repeat(symbols, 1 + rule)
            at = np.flatnonzero(rule) + np.arange(len(which))
            out[at], out[at + 1] = self.pairs[which, 0], self.pairs[which, 1]
            symbols = out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of consecutive symbols: each rule is unfolded once, then copied."""
        met = np.zeros(self.vocabulary + len(self.lengths), dtype=bool)
        met[symbols] = True
        used = np.flatnonzero(met)
        kind = symbols.dtype
        offset = np.concatenate(([0], np.cumsum(self.size(used)))) * kind.itemsize
        number = np.empty(len(met), dtype=np.int32)
        number[used] = np.arange(len(used), dtype=np.int32)
        strings = pa.Array.from_buffers(pa.large_binary(), len(used), [None, pa.py_buffer(offset.astype(np.int64)), pa.py_buffer(self._unfold(used.astype(kind)))])
        out = strings.take(pa.array(number[symbols]))
        return np.frombuffer(out.buffers()[2] or b"", dtype=kind)[:int(np.frombuffer(out.buffers()[1], dtype=np.int64)[len(out)]) // kind.itemsize]

    def size(self, symbols: np.ndarray) -> np.ndarray:
        """Number of ids each symbol stands for."""
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.vocabulary
        out[rule] = self.lengths[symbols[rule] - self.vocabulary]
        return out

    def decode(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols that cover them are expanded."""
        end = np.cumsum(self.size(self.symbols))
        total = int(end[-1]) if len(end) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return self.symbols[:0]
        a, b = np.searchsorted(end, start, side="right"), np.searchsorted(end, stop) + 1
        skip = start - (int(end[a - 1]) if a else 0)
        return self.expand(self.symbols[a:b])[skip:skip + stop - start]


def re_pair(ids: np.ndarray, vocabulary: int, end_id: int | None = None, least: int = 8, spread: int = 256,
            gain: float = 0.03) -> Grammar:
    """Replace frequent pairs of neighbouring symbols by new symbols, again and again.

    A round counts all pairs, takes those with at least 1/``spread`` of the
    most frequent one's count (and ``least``), and replaces them from left to
    right where they overlap, so frequent pairs go before rare ones.  Of
    chosen pairs that meet in a slot of the look-up table one has to wait for
    the next round.  It ends when no pair occurs ``least`` times or a round at
    that bound saves less than ``gain``.  Pairs with ``end_id`` are left alone, so documents start
    at a symbol.  Symbols take two bytes where the vocabulary leaves room
    for rules in them, else four.
    """
    narrow = vocabulary <= 60_000
    kind, limit, bits = (np.uint16, 1 << 16, 16) if narrow else (np.uint32, 1 << 32, 32)
    word = np.uint32 if narrow else np.uint64
    a, pairs, lengths = ids.astype(word), [], [np.empty(0, dtype=np.int64)]
    known = np.ones(vocabulary, dtype=np.int64)
    top = vocabulary
    while len(a) > 1 and top < limit:
        key = (a[:-1] << word(bits)) | a[1:]
        if end_id is not None:
            key = key[(a[:-1] != end_id) & (a[1:] != end_id)]
        if not len(key):
            break
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(first, append=len(key))
        bound = max(least, int(count.max()) // spread)
        taken = np.flatnonzero(count >= bound)
        if not len(taken):
            break
        if len(taken) > limit - top:
            taken = np.sort(taken[np.argsort(-count[taken], kind="stable")[:limit - top]])
        chosen = key[first[taken]]
        at, rule = _occurrences(a, chosen, word(bits))
        used = np.bincount(rule, minlength=len(chosen)) >= 2  # overlaps may have left a pair with less
        keep = used[rule]
        at, rule = at[keep], rule[keep]
        if not len(at):
            break
        chosen, number = chosen[used], np.cumsum(used) - 1
        left, right = (chosen >> word(bits)).astype(np.int64), (chosen & word((1 << bits) - 1)).astype(np.int64)
        pairs.append(np.stack((left, right), axis=1).astype(kind))
        lengths.append(known[left] + known[right])
        known = np.concatenate((known, lengths[-1]))
        a[at] = (top + number[rule]).astype(word)
        stay = np.ones(len(a), dtype=bool)
        stay[at + 1] = False
        saved, a = len(at) / len(a), a[stay]
        top += len(chosen)
        if bound == least and saved < gain:
            break
    flat = np.concatenate(pairs) if pairs else np.empty((0, 2), dtype=kind)
    return Grammar(vocabulary, flat, np.concatenate(lengths), a.astype(kind))


def _slot(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        if key.dtype == np.uint32:
            return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)


def _occurrences(a: np.ndarray, chosen: np.ndarray, bits) -> tuple[np.ndarray, np.ndarray]:
    """(position, number in ``chosen``) of the chosen pairs, every other one where they overlap."""
    key = (a[:-1] << bits) | a[1:]
    table = np.full(1 << _SLOTS, -1, dtype=np.int32)
    table[_slot(chosen)] = np.arange(len(chosen), dtype=np.int32)
    rule = table[_slot(key)]
    at = np.flatnonzero(rule >= 0)
    rule = rule[at]
    same = chosen[rule] == key[at]
    at, rule = at[same], rule[same]
    n = np.arange(len(at))
    head = np.ones(len(at), dtype=bool)
    head[1:] = np.diff(at) != 1
    keep = (n - np.maximum.accumulate(np.where(head, n, 0))) % 2 == 0
    return at[keep], rule[keep]


def _spread(docs: DataFrame, files: int | None, at_least: int = 8192, at_most: int = 20_000) -> tuple[int, int, list[int]]:
    """(files for null ids, all files, upper ids of the others): from counts and percentiles of the id column alone.

    Each file gets ``at_least`` documents, more where there would be more than ``at_most`` files.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    total, known = ids.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    size = max(at_least, -(-total // at_most)) if files is None else max(1, -(-total // files))
    blank, rest = -(-(total - known) // size), -(-known // size)
    if rest < 2:
        return blank, blank + max(rest, 1), []
    shares = [i / rest for i in range(1, rest)]
    edges = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * rest)).alias("p")).first()["p"]
    return blank, blank + rest, list(edges)


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, files: int | None = None,
                 shard: int = SHARD) -> None:
    """Encode all documents and write them below ``path`` in ascending order of doc_id.

    Documents travel to their file as ids: files hold consecutive ranges of
    doc_id, and a doc_id with more rows than a file takes is dealt over
    several files (null ids come first).  A file is cut into shards of whole
    documents with a grammar each; a document longer than a shard has shards
    of its own (``whole`` is false there).  A task holds one shard at a time,
    and no more the words remembered for encoding.
    Null texts are empty; a document is its ids and ``end_id``.  ``docs``
    must be a scan or a written table, whose rows a retried task reads in
    the same order.
    """
    place = vocabulary or default_vocabulary()
    size = max([i for i in _tokenizer(place).get_vocab().values()] + [end_id]) + 1
    kind = "<u2" if size <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype=kind).tobytes()
    blank, total, edges = _spread(docs, files)
    limits = np.array(edges, dtype=np.int64)

    def files_of(doc: pa.Array, row: np.ndarray) -> np.ndarray:
        known = doc.is_valid().to_numpy(zero_copy_only=False)
        ids = doc.fill_null(0).to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(limits, ids), np.searchsorted(limits, ids, side="right")
        return np.where(known, blank + low + row % (high - low + 1), row % max(blank, 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(place)
        for batch in batches:
            for part in slices(batch, 1, _PART):
                ids, count = words.encode_column(part.column(1))
                raw, to = ids.astype(kind, copy=False).tobytes(), (np.cumsum(count) * np.dtype(kind).itemsize).tolist()
                own = pa.array([raw[a:b] + end for a, b in zip([0, *to[:-1]], to)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(files_of(part.column(0), part.column(2).to_numpy()), pa.int32()),
                                                  part.column(0), part.column(2), own], names=["file", "doc_id", "row", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_words()
        held: list[tuple[int | None, np.ndarray]] = []
        file, number, base, waiting = None, 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, base, held, waiting
            if held:
                yield _shard_row(file, number, True, base, base, held, size, end_id)
                number, base, held, waiting = number + 1, base + waiting, [], 0

        for batch in batches:
            for f, doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if f != file:
                    yield from flush()
                    file, number, base = f, 0, 0
                ids = np.frombuffer(raw.as_buffer(), dtype=kind)
                if waiting + len(ids) > shard:
                    yield from flush()
                if len(ids) <= shard:
                    held.append((doc, ids))
                    waiting += len(ids)
                    continue
                start = base
                for at in range(0, len(ids), shard):
                    piece = ids[at:at + shard]
                    yield _shard_row(file, number, False, base, start, [(doc, piece)], size, end_id)
                    number, base = number + 1, base + len(piece)
        yield from flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    dealt = (rows.mapInArrow(encode, "file int, doc_id long, row long, ids binary")
             .repartitionById(total, F.col("file")).sortWithinPartitions("file", "doc_id", "row"))
    (dealt.mapInArrow(cut, SHARDS).write.mode("overwrite").option("compression", "none")
     .option("parquet.block.size", 32 << 20).parquet(path))


def _shard_row(file: int, number: int, whole: bool, base: int, start: int, docs: list[tuple[int | None, np.ndarray]],
               vocabulary: int, end_id: int) -> pa.RecordBatch:
    ids = np.concatenate([x for _, x in docs])
    g = re_pair(ids, vocabulary, end_id)
    values = [file, number, whole, base, len(ids), start, [d for d, _ in docs], [len(x) for _, x in docs], vocabulary,
              g.symbols.itemsize, g.pairs.tobytes(), g.lengths.astype("<u4").tobytes(), g.symbols.tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                      names=[x.split()[0] for x in SHARDS.split(", ")])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards written below ``path``."""
    return spark.read.schema(SHARDS).parquet(path)


def grammar_of(shard: dict) -> Grammar:
    """The grammar of one shard, from its columns."""
    kind = f"<u{shard['width']}"
    return Grammar(shard["vocabulary"], np.frombuffer(shard["pairs"], dtype=kind).reshape(-1, 2),
                   np.frombuffer(shard["lengths"], dtype="<u4").astype(np.int64), np.frombuffer(shard["symbols"], dtype=kind))


def _bases(shards: DataFrame) -> dict[int, int]:
    """Ids before each file: one number per file reaches the driver (at most 20,000 by default)."""
    out, at = {}, 0
    for r in sorted(shards.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()):
        out[r["file"]] = at
        at += r["n"]
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, from their own and the second one's ``size`` in bytes."""
    def times(a: int, b: int) -> int:  # of polynomials modulo the CRC's, lowest power in the highest bit
        out = 0
        while a:
            if a & 0x80000000:
                out ^= b
            a = (a << 1) & 0xFFFFFFFF
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return out

    shift, step, n = 0x80000000, 0x00800000, size  # 1, and x to the 8
    while n:
        if n & 1:
            shift = times(shift, step)
        step, n = times(step, step), n >> 1
    return times(shift, first) ^ second


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file, shard of every document, decoded from the files.

    Documents of more than one shard are put together from the checksums of
    their parts (as many as the document has shards).
    """
    shards = read_shards(spark, path)
    bases = _bases(shards)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = batch.slice(i, 1).to_pylist()[0]
                raw = grammar_of(s).decode().astype("<u4").tobytes()
                count = np.array(s["counts"], dtype=np.int64)
                end = np.cumsum(count)
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((end - count).tolist(), end.tolist())]
                start = bases[s["file"]] + (s["base"] + end - count if s["whole"] else np.array([s["first_start"]]))
                n = len(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(count), pa.array(crc, pa.int64()),
                     pa.array([s["file"]] * n, pa.int32()), pa.array([s["shard"]] * n, pa.int32())],
                    names=[x.split()[0] for x in DOCUMENTS.split(", ")])

    @F.arrow_udf("long")
    def chain(parts: pa.Array) -> pa.Array:
        out = []
        for row in parts.to_pylist():
            crc = row[0]["ids_crc32"]
            for p in row[1:]:
                crc = joined_crc(crc, p["ids_crc32"], 4 * p["n_tokens"])
            out.append(crc)
        return pa.array(out, pa.int64())

    whole = shards.filter("whole").mapInArrow(decode, DOCUMENTS)
    parts = shards.filter("NOT whole").mapInArrow(decode, DOCUMENTS)
    long = (parts.groupBy("file", "start").agg(F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                                              F.min("shard").alias("shard"),
                                              F.array_sort(F.collect_list(F.struct("shard", "n_tokens", "ids_crc32"))).alias("p"))
            .withColumn("ids_crc32", chain("p")))
    return whole.unionByName(long.select(*whole.columns))


def fetch(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id, file, start (in the file), part, ids of the wanted documents: only the symbols that cover them are expanded.

    ``doc_ids`` is a bounded list; a document of several shards gives one row per shard, in order of ``part``.
    """
    wanted = sorted(set(doc_ids))
    hit = read_shards(spark, path).filter(F.arrays_overlap("doc_ids", F.lit(wanted).cast("array<long>")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = set(wanted)
        for batch in batches:
            for i in range(batch.num_rows):
                s = batch.slice(i, 1).to_pylist()[0]
                g, at, rows = grammar_of(s), 0, []
                for d, n in zip(s["doc_ids"], s["counts"]):
                    if d in keep:
                        rows.append((d, s["base"] + at if s["whole"] else s["first_start"], g.decode(at, at + n)))
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([s["file"]] * len(rows), pa.int32()),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([s["shard"]] * len(rows), pa.int32()),
                     pa.array([r[2].astype(np.int64) for r in rows], pa.list_(pa.int64()))],
                    names=["doc_id", "file", "start", "part", "ids"])

    return hit.mapInArrow(pick, "doc_id long, file int, start long, part int, ids array<long>")
