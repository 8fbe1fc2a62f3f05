"""Token counts: pieces counted once per distinct pre-token, summed over per-document frequencies."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import slices, texts

# Fixed value: the pre-token pattern of the byte-level vocabulary, on characters where the standard
# classes mean the same as the library's; texts with any other character are split by the library.
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-±´-¸º»¿-ɏ]*")
DOCS_A_BLOCK, PRETOKENS_A_BLOCK = 60_000, 400_000
HOT = 256  # documents of one block with the same pre-token, from which on its rows are dealt by block as well
_PAIR = np.dtype([("doc", "<u2"), ("n", "<u2")])


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


def _pretokens(text: str, library, special: list[str]) -> tuple[Counter, int]:
    """(frequency of each pre-token, number of special tokens) of a text."""
    parts, n = [text], 0
    for s in special:
        if s in text:
            cut = [p.split(s) for p in parts]
            n += sum(len(c) - 1 for c in cut)
            parts = [x for c in cut for x in c]
    out: Counter = Counter()
    for p in parts:
        if _PLAIN.fullmatch(p):
            out.update(_PRE.findall(p))
        else:
            out.update(p[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(p))
    return out, n


def _map_blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _tokenizer(path)
        special = [t.content for t in library.get_added_tokens_decoder().values()]
        task, block = TaskContext.get().partitionId(), 0
        found: dict[str, bytearray] = {}
        docs: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            name = (task << 24) + block
            keys = list(found)
            for at in range(0, len(keys), 20_000):
                some = keys[at:at + 20_000]
                lists = [bytes(found[k]) for k in some]
                salt = [name + 1 if len(v) >= 4 * HOT else 0 for v in lists]
                yield _batch(some, salt, [name] * len(some), lists)
            head = np.array([(-1 if d is None else d, d is None, b, s) for d, b, s in docs], dtype=_HEAD)
            yield _batch([None], [name + 1], [name], [head.tobytes()])
            found.clear()
            docs.clear()
            block += 1

        for batch in batches:
            for part in slices(batch, 1):
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    t = t or ""
                    freq, n_special = _pretokens(t, library, special)
                    i = len(docs).to_bytes(2, "little")
                    for k, n in freq.items():
                        own = found.get(k)
                        if own is None:
                            own = found[k] = bytearray()
                        while n > 65_535:
                            own += i + b"\xff\xff"
                            n -= 65_535
                        own += i + n.to_bytes(2, "little")
                    docs.append((d, len(t.encode()), n_special))
                    if len(docs) >= DOCS_A_BLOCK or len(found) >= PRETOKENS_A_BLOCK:
                        yield from flush()
        if docs:
            yield from flush()

    return run


_HEAD = np.dtype([("doc", "<i8"), ("none", "?"), ("bytes", "<i8"), ("special", "<i8")])
ROWS = "pretoken string, salt long, block long, pairs binary"


def _batch(pretoken, salt, block, pairs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pretoken, pa.string()), pa.array(salt, pa.int64()),
                                       pa.array(block, pa.int64()), pa.array(pairs, pa.binary())],
                                      names=["pretoken", "salt", "block", "pairs"])


def _sum_pairs(path: str, most: int = 2_000_000):
    """Rows sorted by pre-token -> per block, the sums of pieces by document number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _tokenizer(path)
        last, last_n = None, 0
        keys: list[np.ndarray] = []
        sums: list[np.ndarray] = []
        size = 0

        def compact() -> tuple[np.ndarray, np.ndarray]:
            k, where = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(where, weights=np.concatenate(sums), minlength=len(k)).astype(np.int64)

        def emit(k: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            own = k >> 16
            turn = np.flatnonzero(np.diff(own, prepend=own[0] - 1)) if len(k) else []
            for a, b in zip(turn, [*turn[1:], len(k)]):
                pair = np.empty(b - a, dtype=_SUM)
                pair["doc"], pair["n"] = k[a:b] & 0xFFFF, v[a:b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(own[a])], pa.int64()), pa.array([False]), pa.array([pair.tobytes()], pa.binary())],
                    names=["block", "head", "data"])

        for batch in batches:
            token = batch.column(0).to_pylist()
            block = batch.column(2).to_numpy()
            data = batch.column(3)
            for i, t in enumerate(token):
                if t is None:
                    yield pa.RecordBatch.from_arrays([batch.column(2).slice(i, 1), pa.array([True]), data.slice(i, 1)],
                                                     names=["block", "head", "data"])
            new = [t for a, t in zip([last, *token], token) if t != a and t is not None]
            counted = dict(zip(new, (len(e.ids) for e in library.encode_batch_fast(new, add_special_tokens=False)))) if new else {}
            if last is not None:
                counted.setdefault(last, last_n)
            own = [i for i, t in enumerate(token) if t is not None]
            if own:
                last = token[own[-1]]
                last_n = counted[last]
                size_each = np.asarray(pc.binary_length(data), dtype=np.int64)[own] // _PAIR.itemsize
                pair = np.frombuffer(b"".join(data[i].as_py() for i in own), dtype=_PAIR)
                pieces = np.repeat(np.array([counted[token[i]] for i in own], dtype=np.int64), size_each)
                keys.append((np.repeat(block[own], size_each) << 16) | pair["doc"])
                sums.append(pair["n"] * pieces)
                size += len(pair)
                if size > 2 * most:
                    k, v = compact()
                    if len(k) > most:
                        yield from emit(k, v)
                        k, v = k[:0], v[:0]
                    keys[:], sums[:], size = [k], [v], len(k)
        if keys:
            yield from emit(*compact())

    return run


_SUM = np.dtype([("doc", "<u2"), ("n", "<i8")])


def _by_document(limit: int):
    """Rows sorted by block, its head first -> one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, head, total = None, None, None

        def done() -> pa.RecordBatch:
            n = total + head["special"]
            return pa.RecordBatch.from_arrays(
                [pa.array(head["doc"], pa.int64(), mask=head["none"]), pa.array(head["bytes"], pa.int64()),
                 pa.array(n, pa.int64()), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

        for batch in batches:
            for b, is_head, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if is_head:
                    if block is not None:
                        yield done()
                    block, head = b, np.frombuffer(data, dtype=_HEAD)
                    total = np.zeros(len(head), dtype=np.int64)
                else:
                    pair = np.frombuffer(data, dtype=_SUM)
                    total[pair["doc"]] += pair["n"]
        if block is not None:
            yield done()

    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; no token id is ever made for a text.

    1. Each task cuts its texts into pre-tokens and sends, per block of
       documents, every distinct pre-token once with its (document, frequency)
       pairs.  Each block also sends its documents' ids and sizes.
    2. Rows meet by pre-token, sorted, so its pieces are counted once and
       joined to the pairs of all blocks.  A pre-token in many documents of a
       block is dealt by block as well, so no partition gathers a common word
       from all blocks.  Pieces times frequency are summed by document.
    3. The sums meet by block and are added up.

    Null and empty texts have 0 bytes and tokens; a null doc_id stays null;
    repeated rows are counted as rows of their own.  Special-token strings
    count as one token each, as the library takes them.  ``docs`` should be a
    scan or a written table, whose rows a retried task reads in the same order.
    """
    path = vocabulary or default_vocabulary()
    rows = texts(docs).mapInArrow(_map_blocks(path), ROWS)
    met = rows.repartition("pretoken", "salt").sortWithinPartitions("pretoken")
    sums = met.mapInArrow(_sum_pairs(path), "block long, head boolean, data binary")
    blocks = sums.repartition("block").sortWithinPartitions("block", F.desc("head"))
    return blocks.mapInArrow(_by_document(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
