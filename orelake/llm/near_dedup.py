"""Near-duplicates by Order MinHash over three-word shingles, verified by banded alignment of words."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import fresh, mix, slices, stored, texts, word_hashes
from orelake.llm.components import components
from orelake.llm.substring_dedup import zipped

SHINGLE = 3


@dataclass(frozen=True)
class OrderMinHash:
    """Parameters.

    ``sketches`` values a text, each the ``minima`` smallest occurrence-labelled
    shingles of one hash order, retained in text order; ``rows`` values make a
    band.  Texts that share a band and ``agree`` values or more are compared.
    Two texts that agree in words at 0.8, edits spread evenly, have about 0.57
    of their shingles in common, so a value agrees with probability 0.33 and a
    pair is missed with probability about 0.01; edits close together, or
    fewer, leave more shingles whole.  A value of two shingles inside a
    passage that many texts share is common, a band of two such values rare,
    so such passages make no large buckets.  (Texts of some ten words may
    have no shingle left.)
    """

    sketches: int = 80
    rows: int = 2
    minima: int = 2
    agree: int = 12
    similarity: float = 0.8
    together: int = 1000  # members of a group compared in one task; larger groups are dealt as pairs of parts
    seed: int = 1

    def orders(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        draw = rng.integers(0, 1 << 63, size=(2, self.sketches), dtype=np.uint64)
        return (draw[0] << np.uint64(1)) | np.uint64(1), draw[1]


def shingles(h: np.ndarray) -> np.ndarray:
    """Occurrence-labelled three-word shingles of a text's word hashes, in text order; a shorter text is one shingle."""
    with np.errstate(over="ignore"):
        k = min(SHINGLE, len(h))
        g = np.full(max(1, len(h) - k + 1), np.uint64(k))
        for j in range(k):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j]
        g = mix(g, 4)
        order = np.argsort(g, kind="stable")
        s = g[order]
        if (s[1:] == s[:-1]).any():
            new = np.concatenate(([True], s[1:] != s[:-1]))
            number = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
            label = np.empty(len(s), dtype=np.uint64)
            label[order] = number
            g = np.where(label > 0, mix(g + label * np.uint64(0xD6E8FEB86659FD93), 5), g)
    return g


def sketch(x: np.ndarray, conf: OrderMinHash, orders: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 32-bit value per hash order."""
    part = max(1, (1 << 22) // len(x))  # a bounded table, however long the text
    if len(orders[0]) > part:
        return np.concatenate([sketch(x, conf, (orders[0][i:i + part], orders[1][i:i + part])) for i in range(0, len(orders[0]), part)])
    with np.errstate(over="ignore"):
        v = x[None, :] * orders[0][:, None] + orders[1][:, None]
        at = np.empty((conf.minima, len(v)), dtype=np.int64)
        rows = np.arange(len(v))
        for i in range(conf.minima):
            at[i] = v.argmin(axis=1)
            if i < len(x) - 1:
                v[rows, at[i]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        at.sort(axis=0)
        value = np.zeros(len(v), dtype=np.uint64)
        for i in range(conf.minima):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + x[at[i]], 6 + i)
    return (value >> np.uint64(32)).astype(np.uint32)


def _words(text: str | bytes | None) -> tuple[bytes, np.ndarray]:
    raw = b" ".join((text.encode() if isinstance(text, str) else text or b"").split())
    return raw, word_hashes(np.frombuffer(raw, dtype=np.uint8))[2]


_SIGNED = "row long, doc_id long, digest binary, bands binary, sketch binary"


def _sign(conf: OrderMinHash):
    """Per text: digest of its words and, for the first of equal ones in a task, its bands and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, seen = conf.orders(), set()
        n = conf.sketches // conf.rows
        for batch in batches:
            for part in slices(batch, 1):
                digest, bands, own = [], [], []
                for t in part.column(1).to_pylist():
                    raw, h = _words(t)
                    d = xxhash.xxh3_128_digest(raw)
                    digest.append(d)
                    if d in seen:
                        bands.append(None)
                        own.append(None)
                        continue
                    seen.add(d)
                    s = sketch(shingles(h), conf, orders)
                    b = np.arange(n, dtype=np.uint64)
                    for j in range(conf.rows):
                        b = mix(b * np.uint64(0x100000001B3) + s[j::conf.rows][:n], 8 + j)
                    bands.append(b.tobytes())
                    own.append(s.astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(0), *[pa.array(c, pa.binary()) for c in (digest, bands, own)]],
                    names=["row", "doc_id", "digest", "bands", "sketch"])

    return run


def _explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.frombuffer(b, dtype=np.int64) for b in batch.column(1).to_pylist()]
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column(0).to_numpy(), [len(k) for k in keys]))],
                names=["key", "rep"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows whose first three columns agree; the remaining columns as tuples."""
    now, rows = None, []
    for batch in batches:
        for r in zip(*[c.to_pylist() for c in batch.columns]):
            if r[:3] != now:
                if rows:
                    yield rows
                now, rows = r[:3], []
            rows.append(r[3:])
    if rows:
        yield rows


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                                      names=["a", "b"])


def _forest(agree: int):
    """Per bucket: each member with the first member it is joined to by chains of agreeing sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _groups(batches):
            rows.sort()
            ids = [r[0] for r in rows]
            s = np.frombuffer(b"".join(r[1] for r in rows), dtype="<u2").reshape(len(rows), -1)
            left = np.arange(1, len(rows))
            root, todo = 0, [0]
            while len(left):
                if not todo:
                    root, left = left[0], left[1:]
                    todo = [root]
                    continue
                hit = (s[left] == s[todo.pop()]).sum(axis=1) >= agree
                out += [(ids[root], ids[i]) for i in left[hit]]
                todo += left[hit].tolist()
                left = left[~hit]
            if len(out) > 20_000:
                yield _links(out)
                out = []
        yield _links(out)

    return run


def _common(x: list[int], y: list[int], band: int) -> int:
    """Words of ``x`` and ``y`` that match in order, at most ``band`` places apart: all rows of the table as bits of one number."""
    full, reach = (1 << len(y)) - 1, (1 << (2 * band + 1)) - 1
    place: dict[int, int] = {}
    for j, w in enumerate(y):
        place[w] = place.get(w, 0) | 1 << j
    open_ = full
    for i, w in enumerate(x):
        hit = place.get(w, 0)
        if hit:
            hit &= open_ & (reach << (i - band) if i > band else reach >> (band - i))
            open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(y) - open_.bit_count()


def aligned(x: np.ndarray, y: np.ndarray, similarity: float, whole: int = 40_000) -> float:
    """Words matched in order / words of either text, by alignment inside a band.

    The band is the shift beyond which the similarity cannot be reached, so
    nothing is lost for texts that reach it.  Texts of more than ``whole``
    words together are aligned at the shingles they have in common, in order,
    and by the band in the gaps between.
    """
    total = len(x) + len(y)
    if not total:
        return 1.0
    need = similarity * total / (1 + similarity)
    band = int(total - 2 * need + 1e-9)
    n = min(len(x), len(y))
    if n < need - 1e-9:
        return n / (total - n)
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - n:][::-1] != y[len(y) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    x, y = x[:len(x) - tail], y[:len(y) - tail]
    matched = head + tail
    if total <= whole:
        matched += _common(x.tolist(), y.tolist(), band)
    else:
        matched += _anchored(x, y, band)
    return matched / (total - matched)


def _anchored(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Words that match in order, at the longest in-order chain of common shingles and within the gaps."""
    _, i, j = np.intersect1d(shingles(x), shingles(y), assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    order = np.argsort(i)
    i, j = i[order], j[order]
    ends: list[int] = []
    back, tip = np.full(len(j), -1), []
    for at, p in enumerate(j.tolist()):
        k = bisect_left(ends, p)
        ends[k:k + 1], tip[k:k + 1] = [p], [at]
        back[at] = tip[k - 1] if k else -1
    chain, at = [], tip[-1] if tip else -1
    while at >= 0:
        chain.append((int(i[at]), int(j[at])))
        at = back[at]
    done, a, b = 0, 0, 0
    for p, q in [*chain[::-1], (len(x), len(y))]:
        if p < a or q < b:  # overlaps the match before: its last words are the same
            continue
        if p > a and q > b:
            done += _common(x[a:p].tolist(), y[b:q].tolist(), band)
        size = 1 if p < len(x) else 0
        done, a, b = done + size, p + size, q + size
    return done


def _numbered(h: np.ndarray) -> np.ndarray:
    """Words told apart by how often they were there before."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.empty(0, dtype=bool)
    at = np.arange(len(s))
    label = np.empty(len(s), dtype=np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0)) if len(s) else at
    with np.errstate(over="ignore"):
        return np.where(label > 0, mix(h + label * np.uint64(0xD6E8FEB86659FD93), 5), h)


def _shared(x: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of all pairs of texts."""
    if len(x) == 2:
        n = len(x[0]) + len(x[1]) - len(np.unique(np.concatenate(x)))
        return np.array([[len(x[0]), n], [n, len(x[1])]])
    owner = np.repeat(np.arange(len(x)), [len(a) for a in x])
    _, where, often = np.unique(np.concatenate(x), return_inverse=True, return_counts=True)
    keep = often[where] > 1
    _, where = np.unique(where[keep], return_inverse=True)
    owner, out = owner[keep], np.zeros((len(x), len(x)), dtype=np.float32)
    width = max(64, (1 << 22) // len(x))
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    for a in range(0, int(where[-1]) + 1 if len(where) else 0, width):
        lo, hi = np.searchsorted(where, [a, a + width])
        m = np.zeros((len(x), width), dtype=np.float32)
        m[owner[lo:hi], where[lo:hi] - a] = 1
        out += m @ m.T
    return np.rint(out)


def _verify(similarity: float):
    """Per family: members joined to the first member of their class by chains of verified pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, out = zstandard.ZstdDecompressor(), []
        for rows in _groups(batches):
            rows.sort()
            x = [_words(unzip.decompress(r[1]))[1] for r in rows]
            size = np.array([len(a) for a in x])
            shared = _shared([_numbered(a) for a in x])  # no alignment matches more
            like = shared / np.maximum(size[:, None] + size[None, :] - shared, 1)
            a, b = np.nonzero(np.triu(like >= similarity - 1e-9, 1))
            label = np.arange(len(x))
            for at in np.argsort(-like[a, b], kind="stable").tolist():
                i, j = a[at], b[at]
                if label[i] != label[j] and aligned(x[i], x[j], similarity) >= similarity - 1e-9:
                    lo, hi = sorted((label[i], label[j]))
                    label[label == hi] = lo
            out += [(rows[k][0], rows[i][0]) for i, k in enumerate(label.tolist()) if i != k]
            if len(out) > 20_000:
                yield _links(out)
                out = []
        yield _links(out)

    return run


def _dealt(df: DataFrame, key: str, size: str, together: int, value: str) -> DataFrame:
    """(key, i, j, rep, value): members of large groups copied to every pair of parts that holds theirs."""
    parts = F.ceil(F.col(size) / F.lit(together)).cast("int")
    own = F.pmod(F.xxhash64("rep"), parts).cast("int")
    spread = (df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
              .select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", value))
    return spread.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def _contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components and about one per ``b``: its first ``a``, which is linked to b's other ones.

    A text is linked to one text in each of its buckets; of a large group
    these are the same few for all members, so their links to each other
    are soon all there.  The list of a ``b`` is as long as it has buckets.
    """
    own = links.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("r"))
    others = F.concat(F.array("b"), F.expr("slice(r, 2, size(r))"))
    return own.select(F.get("r", F.lit(0)).alias("a"), F.explode(others).alias("b"))


def _classes(rows: DataFrame, conf: OrderMinHash) -> DataFrame:
    """(row, doc_id, text) -> (row, doc_id, class_row, class_id): the first row and id of each row's class."""
    signed = stored(rows.select("doc_id", "text", "row").mapInArrow(_sign(conf), _SIGNED), "signed")
    reps = stored(signed.groupBy("digest").agg(F.min("row").alias("rep"), F.max("bands").alias("bands"),
                                               F.max("sketch").alias("sketch")), "texts")
    keys = reps.select("rep", "bands").mapInArrow(_explode_bands, "key long, rep long")
    several = keys.groupBy("key").agg(F.count("rep").alias("size")).filter("size > 1")
    buckets = keys.join(several, "key").join(reps.select("rep", "sketch"), "rep")
    forest = _contracted(_dealt(buckets, "key", "size", conf.together, "sketch").mapInArrow(_forest(conf.agree), "a long, b long"))
    family = components(forest)
    sizes = family.groupBy("label").agg(F.count("node").alias("size"))
    # Texts are always dealt by row for this join, whatever the number of members: shuffles then follow the input.
    members = (family.join(sizes, "label").hint("merge")
               .join(rows.select(F.col("row").alias("node"), zipped(F.col("text")).alias("z")), "node")
               .select("label", "size", F.col("node").alias("rep"), "z"))
    links = _dealt(members, "label", "size", conf.together, "z").mapInArrow(_verify(conf.similarity), "a long, b long")
    classes = components(links).select(F.col("node").alias("rep"), "label")
    each = (signed.select("row", "doc_id", "digest").join(reps.select("digest", "rep"), "digest").join(classes, "rep", "left")
            .select("row", "doc_id", F.coalesce("label", "rep").alias("label")))
    first = each.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    return (each.join(first, "label")
            .select("row", "doc_id", F.col("first.row").alias("class_row"), F.col("first.doc_id").alias("class_id")))


def near_duplicates(docs: DataFrame, conf: OrderMinHash = OrderMinHash()) -> DataFrame:
    """One row per document: doc_id, class_id, kept.

    1. Texts with the same words are one text from here on.
    2. Order MinHash sketches put texts into buckets; within a bucket, chains
       of texts whose sketches agree become star links, and these the
       families: every pair to compare lies inside one family.
    3. In each family the common words of all pairs are counted, which no
       alignment can exceed; pairs at 0.8 or more are aligned in order, word
       by word in a band, unless already joined.
    4. Pairs with 0.8 of their words matched make classes, exact copies join
       their text's class.

    ``class_id`` is the class's smallest doc_id; the class's first row with it
    is ``kept``.  Buckets and families above ``together`` members are dealt to
    several tasks as pairs of parts, all of which are compared.  Null and
    empty texts, or such without words, are copies of each other; a null
    doc_id is larger than any other.  No documents give no rows.  ``docs``
    should be a scan or a written table, as rows are numbered by place.
    """
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    return _classes(rows, conf).select("doc_id", "class_id", (F.col("row") == F.col("class_row")).alias("kept"))


def one_of_each(docs: DataFrame, conf: OrderMinHash = OrderMinHash()) -> DataFrame:
    """One document of each class, with all columns; see :func:`near_duplicates`."""
    row = fresh(docs, "row__")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = numbered.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.col(row).alias("row"))
    kept = _classes(rows, conf).filter("row = class_row").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
