"""Best-fit packing by large-item matching, planned on length counts and applied by numbering."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelake.llm.common import fresh, mix, powers, running_total, slices, stored, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Characters on which lower case, white space, normal form and the classes below are plain; texts with others go
# to the library whole.
_PLAIN = "^[\t-\r\x20-\x7e¡-±´-¸º»¿-įı-ɏ]*$"
# Fixed value: where the vocabulary's tokenizer cuts a word without white space.
_CUTS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
_KNOWN = 2_000_000  # remembered words and parts, about 40 bytes each
_PART = 8 << 20  # bytes of text encoded at once; repeated words of a part are looked up once


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of non-null strings, over their bytes in one go."""
    off = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]] if len(words) else np.empty(0, np.uint8)
    size, first = np.diff(off), off[:-1] - off[0]
    out, full = np.zeros(len(words), dtype=np.uint64), np.flatnonzero(size)
    if len(full):
        within = np.arange(len(raw)) - np.repeat(first, size)
        with np.errstate(over="ignore"):
            value = (raw.astype(np.uint64) + np.uint64(1)) * powers(int(size.max()) + 1)[within]
            out[full] = mix(np.add.reduceat(value, first[full]) + size[full].astype(np.uint64))
    return out


class WordIds:
    """Token ids of white-space words, remembered in flat columns (two bytes an id where the vocabulary allows, else four).

    Right for tokenizers that drop white space and cut at it, so a text's ids
    are its words' ids in a row.  Words are found by hash and compared; new
    ones are cut into parts, and new parts are encoded together and told
    apart by the mark on the last token of a part.  The memory is bounded:
    when it is full, words not met since it was last full go.  Texts with
    special-token strings or characters outside the plain set are encoded
    whole by the library.
    """

    def __init__(self, path: str, known: int = _KNOWN):
        from tokenizers import Tokenizer, pre_tokenizers
        self.library, self.known = _tokenizer(path), known
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Parts are normal already and cut where the library cuts, so only its byte mapping and merges are left to do.
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.library.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._keep(pa.array([], pa.string()), pa.array([], pa.large_binary()))

    def _keep(self, words: pa.Array, ids: pa.Array) -> None:
        self.words, self.ids, self.met = words, ids, np.zeros(len(words), dtype=bool)
        h = _hashes(words)
        self.number = np.argsort(h, kind="stable")
        self.hash = h[self.number]

    def _find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, whether known, hash) of each word; the numbers of unknown ones mean nothing."""
        h = _hashes(words)
        if not len(self.words):
            return np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool), h
        at = self.number[np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)]
        return at, pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False), h

    def _add(self, words: pa.Array, h: np.ndarray, ids: pa.Array) -> np.ndarray:
        """Remember distinct unknown words; their numbers."""
        new = np.arange(len(self.words), len(self.words) + len(words))
        order = np.argsort(h, kind="stable")
        at = np.searchsorted(self.hash, h[order])
        self.hash, self.number = np.insert(self.hash, at, h[order]), np.insert(self.number, at, new[order])
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])
        self.met = np.concatenate((self.met, np.ones(len(words), dtype=bool)))
        return new

    def _encode_parts(self, parts: pa.Array) -> pa.Array:
        names = parts.to_pylist()
        ids = np.array(self.merges.encode_batch_fast([" ".join(names)], add_special_tokens=False)[0].ids, dtype=self.kind)
        end = np.flatnonzero(self.last[ids]) + 1
        if len(end) != len(names):
            return pa.array([np.array(e.ids, dtype=self.kind).tobytes()
                             for e in self.library.encode_batch_fast(names, add_special_tokens=False)], pa.large_binary())
        offsets = np.concatenate(([0], end)) * self.kind.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])

    def _numbers(self, words: pa.Array, cut: bool = True) -> np.ndarray:
        """Numbers of distinct words, new ones learnt: whole if they are parts already, else from their parts."""
        at, known, h = self._find(words)
        new = np.flatnonzero(~known)
        if len(new):
            names = words.take(pa.array(new))
            if cut:
                alone = pc.utf8_is_alpha(names)
                odd = names.filter(pc.invert(alone))
                split = pc.ascii_split_whitespace(pc.utf8_rtrim(pc.replace_substring_regex(odd, _CUTS, r"\1 "), " "))
                coded = pa.concat_arrays([split.flatten(), names.filter(alone)]).dictionary_encode()
                parts = self._numbers(coded.dictionary, cut=False)[coded.indices.to_numpy()]
                taken = self.ids.take(pa.array(parts[:len(split.flatten())]))
                edge = np.frombuffer(taken.buffers()[1], dtype=np.int64)[np.asarray(split.offsets) - split.offsets[0].as_py()]
                ids = pa.Array.from_buffers(pa.large_binary(), len(odd), [None, pa.py_buffer(edge), taken.buffers()[2]])
                alone = alone.to_numpy(zero_copy_only=False)
                at[new[alone]] = parts[len(split.flatten()):]
                rest = new[~alone]
                at[rest], known, _ = self._find(odd)  # words that are one part are known by now
                left = np.flatnonzero(~known)
                at[rest[left]] = self._add(odd.take(pa.array(left)), h[rest[left]], ids.take(pa.array(left)))
            else:
                at[new] = self._add(names, h[new], self._encode_parts(names))
        self.met[at] = True
        return at

    def _lookup(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, as bytes."""
        if len(self.words) + len(words) > self.known and len(self.words):
            keep = pa.array(self.met if self.met.sum() <= self.known // 2 else np.zeros(len(self.met), dtype=bool))
            self._keep(self.words.filter(keep), self.ids.filter(keep))
        at = self._numbers(words)
        return self.ids.take(pa.array(at))

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, number of ids of each text) of a string column; null is the empty text.

        Lower case, white space and the numbering of distinct words are
        Arrow's work on the whole column; only distinct words become strings.
        """
        col = pc.fill_null(col, "")
        plain = pc.match_substring_regex(col, _PLAIN)
        for mark in self.special:
            plain = pc.and_not(plain, pc.match_substring(col, mark))
        words = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(plain, col, "")))
        coded = words.flatten().dictionary_encode()
        taken = self._lookup(coded.dictionary).take(coded.indices)
        end = np.frombuffer(taken.buffers()[1], dtype=np.int64)[:len(taken) + 1] // self.kind.itemsize
        ids = np.frombuffer(taken.buffers()[2] or b"", dtype=self.kind)[:end[-1]]
        edge = end[np.asarray(words.offsets) - words.offsets[0].as_py()]
        count = np.diff(edge)
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        if len(odd):
            found = [np.array(self.library.encode(col[i].as_py(), add_special_tokens=False).ids, dtype=self.kind) for i in odd.tolist()]
            cut = np.split(ids, edge[odd])
            ids = np.concatenate([cut[0], *[x for pair in zip(found, cut[1:]) for x in pair]])
            count[odd] = [len(x) for x in found]
        return ids, count

    def encode(self, texts_: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        ids, count = self.encode_column(pa.array(texts_, pa.string()))
        raw, end = ids.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
        return list(map(raw.__getitem__, map(slice, [0, *end[:-1]], end)))


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def free_words() -> None:
    """Give back the remembered words of this Python worker; Spark uses workers again for later steps that need none."""
    _word_ids.cache_clear()
    pa.default_memory_pool().release_unused()


def tokenize_pieces(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, end_id: int = 0,
                    keep_ids: bool = False, keep: str = "") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (the ids with ``keep_ids``, then columns ``keep`` of ``docs``, as DDL).

    A document is its ids and ``end_id``; null and empty texts are the end id
    alone.  Only documents longer than ``capacity`` are cut.  Repeated rows
    give repeated pieces.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = PIECES + (", ids array<int>" if keep_ids else "") + (f", {keep}" if keep else "")
    kept = [c.split()[0] for c in keep.split(", ")] if keep else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(path)
        for batch in batches:
            for part in slices(batch, 1, _PART):
                doc, piece, start, length, crc, own, of = [], [], [], [], [], [], []
                flat, count = ids.encode_column(part.column(1))
                flat, to = flat.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
                for n, (d, a, b) in enumerate(zip(part.column(0).to_pylist(), [0, *to[:-1]], to)):
                    raw = flat[a:b] + end
                    for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                        chunk = raw[at:at + 4 * capacity]
                        doc.append(d)
                        piece.append(i)
                        start.append(at // 4)
                        length.append(len(chunk) // 4)
                        crc.append(zlib.crc32(chunk))
                        of.append(n)
                        if keep_ids:
                            own.append(np.frombuffer(chunk, dtype="<i4"))
                cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()),
                        *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
                if keep_ids:
                    cols.append(pa.array(own, pa.list_(pa.int32())))
                cols += [part.column(2 + i).take(pa.array(of, pa.int64())) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in schema.split(", ")])

    return texts(docs, *kept).mapInArrow(cut, schema)


class Plan:
    """Where the r-th piece of each length goes: sorted runs of (length, first rank) with bin, offset and count per bin."""

    def __init__(self, counts: dict[int, int], capacity: int):
        if any(not 1 <= n <= capacity for n in counts):
            raise ValueError("piece lengths must lie between 1 and the capacity")
        self.capacity = capacity
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.bins = 0
        self.open: dict[int, list[tuple[int, int]]] = {}  # free room -> runs (first bin, number of bins)
        self.rooms: list[int] = []
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, first bin, offset, pieces per bin
        self._match_large()
        self._fill_small()
        self.runs.sort()
        cols = np.array(self.runs, dtype=np.int64).reshape(-1, 5)
        self.key = (cols[:, 0] << 40) | cols[:, 1]
        self.first, self.bin, self.offset, self.per = cols[:, 1], cols[:, 2], cols[:, 3], cols[:, 4]

    def _put(self, length: int, first_bin: int, n: int, offset: int, per: int = 1) -> None:
        self.runs.append((length, self.rank[length], first_bin, offset, per))
        self.rank[length] += n
        self.left[length] -= n

    def _give(self, room: int, first_bin: int, n: int) -> None:
        if room and n:
            if room not in self.open:
                self.open[room] = []
                insort(self.rooms, room)
            self.open[room].append((first_bin, n))

    def _match_large(self) -> None:
        """Pieces above a third of the capacity: the largest left takes the largest other that fits, two a bin."""
        c = self.capacity
        large = [n for n in sorted(self.left) if 3 * n > c]
        for a in reversed(large):
            while self.left[a]:
                at = bisect_left(large, c - a + 1) - 1
                while at >= 0 and (large[at] > a or self.left[large[at]] < (2 if large[at] == a else 1)):
                    at -= 1
                b = large[at] if at >= 0 else None
                n = self.left[a] if b is None else self.left[a] // 2 if b == a else min(self.left[a], self.left[b])
                if b == a:
                    self._put(a, self.bins, 2 * n, 0, per=2)
                else:
                    self._put(a, self.bins, n, 0)
                    if b is not None:
                        self._put(b, self.bins, n, a)
                self._give(c - a - (b or 0), self.bins, n)
                self.bins += n

    def _fill_small(self) -> None:
        """The rest, longest first, into the fullest bin with room, then into new bins."""
        c = self.capacity
        for a in sorted((n for n in self.left if 3 * n <= c), reverse=True):
            while self.left[a]:
                at = bisect_left(self.rooms, a)
                if at == len(self.rooms):
                    n = -(-self.left[a] // (c // a))
                    self._give(c, self.bins, n)
                    self.bins += n
                    continue
                room = self.rooms[at]
                first, n = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room], self.rooms[at]
                q = room // a
                full = min(n, self.left[a] // q)
                if full:
                    self._put(a, first, full * q, c - room, per=q)
                    self._give(room - q * a, first, full)
                elif self.left[a]:
                    some, full = self.left[a], 1
                    self._put(a, first, some, c - room, per=q)
                    self._give(room - some * a, first, 1)
                self._give(room, first + full, n - full)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        at = np.searchsorted(self.key, (length << 40) | rank, side="right") - 1
        step = rank - self.first[at]
        return self.bin[at] + step // self.per[at], self.offset[at] + step % self.per[at] * length


class Plans:
    """A :class:`Plan` per group of pieces, by ascending number: the sequences of a group follow all of the groups before."""

    def __init__(self, counts: dict[int, dict[int, int]], capacity: int):
        self.step, self.bins, keys, cols = capacity + 1, 0, [], []
        for group in sorted(counts):
            plan = Plan(counts[group], capacity)
            keys.append(plan.key + (group * self.step << 40))
            cols.append(np.stack((plan.first, plan.bin + self.bins, plan.offset, plan.per)))
            self.bins += plan.bins
        self.key = np.concatenate([np.empty(0, dtype=np.int64), *keys])
        self.first, self.bin, self.offset, self.per = np.concatenate([np.empty((4, 0), dtype=np.int64), *cols], axis=1)

    def place(self, group: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these groups, lengths and ranks."""
        at = np.searchsorted(self.key, (group * self.step + length << 40) | rank, side="right") - 1
        step = rank - self.first[at]
        return self.bin[at] + step // self.per[at], self.offset[at] + step % self.per[at] * length


def pack(pieces: DataFrame, capacity: int = 2048, group: str | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    The number of pieces of each length (``capacity`` numbers at most) is all
    that the driver needs: large-item matching and best fit work on whole runs
    of equally long pieces, and a run's pieces are told apart by their rank
    among the equally long ones.  The rank comes from bucketed running totals,
    so a length that holds a third of all pieces is dealt over many tasks.
    Equal pieces may swap places; each gets a place of its own.  Pass
    ``pieces`` from a scan or a written table, as it is read twice.

    With ``group``, a column of a few dozen small numbers, each group has
    sequences of its own, numbered after those of the groups before.
    """
    own = fresh(pieces, "group__")
    rows = pieces.withColumn(own, F.lit(0).cast("long") if group is None else F.col(group).cast("long"))
    counts: dict[int, dict[int, int]] = {}
    for g, length, n in rows.groupBy(own, "length").count().collect():
        counts.setdefault(g, {})[length] = n
    plans = Plans(counts, capacity)
    ranked = running_total(rows, [own, "length"], ["doc_id", "piece"], F.lit(1), "rank__")

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(group_: pa.Array, length: pa.Array, rank: pa.Array) -> pa.Array:
        seq, offset = plans.place(*[x.to_numpy(zero_copy_only=False) for x in (group_, length, rank)])
        return pa.StructArray.from_arrays([pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                                          names=["sequence_id", "offset"])

    return ranked.withColumn("place__", place(own, "length", "rank__")).select(*pieces.columns, "place__.*")


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """Tokenize, cut and pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    No documents give no rows.  The piece table is written once, as it is
    needed for the counts and for the placing.
    """
    return pack(stored(tokenize_pieces(docs, capacity, vocabulary), "pieces"), capacity)


def _in_order(docs: DataFrame) -> DataFrame:
    """``docs`` with file__, row__, which sort rows as they are stored (of a table that is not read from files: as they come)."""
    try:
        return docs.withColumns({"file__": F.col("_metadata.file_path"), "row__": F.col("_metadata.row_index")})
    except AnalysisException:
        return docs.withColumns({"file__": F.lpad(F.spark_partition_id().cast("string"), 9, "0"),
                                 "row__": F.monotonically_increasing_id()})


def _windows(pieces: DataFrame, most: int, least: int, rows: int = 16) -> DataFrame:
    """``pieces`` with window__: the stretch of the stored order they lie in, one of ``most`` with ``least`` tokens or more.

    Lengths are added up for every ``rows`` rows, then by file; one task sees
    a number per file.
    """
    chunks = (pieces.groupBy("file__", F.expr(f"row__ DIV {int(rows)}").alias("chunk__"))
              .agg(F.sum("length").alias("n__")))
    start = Window.orderBy("file__").rowsBetween(Window.unboundedPreceding, -1)
    files = (chunks.groupBy("file__").agg(F.sum("n__").alias("n__"))
             .withColumn("size__", F.greatest(F.lit(int(least)), F.ceil(F.sum("n__").over(Window.partitionBy()) / int(most))))
             .select("file__", "size__", F.coalesce(F.sum("n__").over(start), F.lit(0)).alias("before__")))
    inside = Window.partitionBy("file__").orderBy("chunk__").rowsBetween(Window.unboundedPreceding, -1)
    at = (chunks.withColumn("within__", F.coalesce(F.sum("n__").over(inside), F.lit(0))).join(files, "file__")
          .select("file__", "chunk__", F.expr("CAST((before__ + within__) DIV size__ AS BIGINT)").alias("window__")))
    own = [c for c in pieces.columns if c not in ("file__", "row__")]
    return pieces.withColumn("chunk__", F.expr(f"row__ DIV {int(rows)}")).join(at, ["file__", "chunk__"]).select(*own, "window__")


def pack_in_order(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, windows: int = 64) -> DataFrame:
    """Like :func:`pack_documents`, but the sequences follow the stored order of ``docs``, stretch by stretch.

    The order is cut into ``windows`` stretches of about as many tokens (fewer
    where that would be less than 16 sequences), each packed by itself: any
    first sequences hold the first documents, to a stretch.  A stretch has a
    few sequences that are not full.
    """
    pieces = stored(tokenize_pieces(_in_order(docs), capacity, vocabulary, keep="file__ string, row__ long"), "pieces")
    placed = stored(_windows(pieces, windows, 16 * capacity), "windows")
    return pack(placed, capacity, "window__").drop("window__")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token ids of each packed sequence, from placed pieces with their ids."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
