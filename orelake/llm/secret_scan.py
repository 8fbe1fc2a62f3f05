"""Secret scans: fixed patterns plus two character Markov models compared by log-likelihood ratio."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import fresh, stored, texts

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_HEX_RUN = re.compile(r"[0-9a-f]{16,}")  # every maximal run that is long enough
_CODE = {c: i + 1 for i, c in enumerate(SYMBOLS)}  # 0 stands for the start of a string
_SIZE = len(SYMBOLS) + 1


# Alphabets that keys are drawn from.
ALPHABETS = {"alphanumeric": SYMBOLS[:62], "base64": SYMBOLS[:64], "base64url": SYMBOLS[:62] + "_-", "upper": SYMBOLS[:26] + SYMBOLS[52:62],
             "lower": SYMBOLS[26:62], "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF"}
_PIECE = re.compile(r"[A-Za-z0-9]+|[+/_.=-]+")


def random_strings(count: int, seed: int = 5, lengths: tuple[int, int] = (16, 44)) -> list[str]:
    """``count`` seeded random strings of each of :data:`ALPHABETS`, of even lengths in ``lengths``: labelled examples of keys."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(lengths[0], lengths[1] + 1, size=(len(ALPHABETS), count))
    return ["".join(np.array(list(a))[rng.integers(0, len(a), size=n)]) for a, row in zip(ALPHABETS.values(), sizes) for n in row]


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratio (random : ordinary) of each character after its predecessor, natural logarithm.

    ``margin`` is the least mean ratio per character of a finding, ``least``
    its least length (both are parameters of :func:`train`).
    """

    ratio: tuple[float, ...]
    least: int
    margin: float

    def score(self, run: str) -> float:
        """Mean ratio per character: above 0 the random-string model explains the run better."""
        total, before = 0.0, 0
        for c in run:
            code = _CODE[c]
            total += self.ratio[before * _SIZE + code]
            before = code
        return total / len(run)

    def segments(self, run: str) -> list[tuple[int, int]]:
        """The parts of a run that are taken for random strings, from left to right.

        A run is cut at its separators.  Of all stretches of neighbouring
        pieces that start and end with letters or digits, the one whose ratios
        lie furthest above the margin in sum is taken if it is long enough;
        then what is left of it and right of it is searched likewise.  So a
        key is found behind a name, in a path or beside another one, and a key
        with separators inside stays whole.
        """
        pieces, total, before = [], 0.0, 0
        for m in _PIECE.finditer(run):
            gain = 0.0
            for c in m[0]:
                code = _CODE[c]
                gain += self.ratio[before * _SIZE + code] - self.margin
                before = code
            pieces.append((m.start(), m.end(), gain, m[0][0].isalnum()))
            total = max(total, gain)
        return self._best(pieces) if total > 0 else []

    def _best(self, pieces: list[tuple[int, int, float, bool]]) -> list[tuple[int, int]]:
        if not pieces or pieces[-1][1] - pieces[0][0] < self.least:
            return []
        best, where, before, between, first = 0.0, None, float("-inf"), 0.0, 0
        for i, (_, _, gain, word) in enumerate(pieces):
            if not word:
                between = gain
                continue
            if before + between <= 0:
                before, between, first = 0.0, 0.0, i
            before += between + gain
            between = 0.0
            if before > best:
                best, where = before, (first, i)
        if where is None:
            return []
        a, b = where
        found = [(pieces[a][0], pieces[b][1])] if pieces[b][1] - pieces[a][0] >= self.least else []
        return self._best(pieces[:a]) + found + self._best(pieces[b + 1:])


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base matches, in code points."""
    found = []
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", _HEX_RUN)):
        for m in pattern.finditer(text):
            size = len(m[2]) if kind == "assign" else m.end() - m.start()
            if size >= LEAST[kind]:
                found.append((m.start(), kind, m.end()))
    return found


def _candidate(least: int) -> re.Pattern:
    return re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{least},}}(?![A-Za-z0-9+/_.=-])")


def scan(text: str | None, model: MarkovPair | None) -> list[tuple[int, str, int]]:
    """Base spans and, with a model, the further stretches it takes for random strings, by start and kind.

    A run that a base span covers in part is searched beside it.
    """
    text = text or ""
    found = base_spans(text)
    if model is not None:
        taken = sorted((s, e) for s, _, e in found)
        for m in _candidate(model.least).finditer(text):
            at, end = m.span()
            for s, e in [t for t in taken if t[0] < end and at < t[1]] + [(end, end)]:
                if s - at >= model.least:
                    found += [(at + x, "markov", at + y) for x, y in model.segments(text[at:s])]
                at = max(at, e)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def labelled_samples(docs: DataFrame, least: int = 12, bound: int = 20_000, seed: int = 7) -> DataFrame:
    """(run, random): at most ``bound`` labelled strings of each class.

    Random strings are the values and keys that the base patterns find;
    ordinary ones are the runs of ``least`` or more characters of the same
    alphabet in texts, outside all base spans.  The sample is the ``bound``
    distinct runs of each class with the smallest seeded hash, so it does not
    depend on the order of rows or on partitions; each task sends no more
    than that many.  Null and empty texts give no run.
    """
    edge = _candidate(least)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, dict[str, int]] = {True: {}, False: {}}
        for batch in batches:
            for x in batch.column(0):
                text = x.as_py() or ""
                spans = base_spans(text)
                runs = [(ASSIGN.fullmatch(text[s:e])[2] if k == "assign" else text[s:e], True) for s, k, e in spans]
                runs += [(m[0], False) for m in edge.finditer(text)
                         if not any(s < m.end() and m.start() < e for s, _, e in spans)]
                for run, flag in runs:
                    kept[flag][run] = xxhash.xxh64_intdigest(run, seed) >> 1
                for flag, have in kept.items():
                    if len(have) > 4 * bound:
                        kept[flag] = dict(sorted(have.items(), key=lambda r: (r[1], r[0]))[:bound])
        rows = [(r, h, flag) for flag, have in kept.items() for r, h in sorted(have.items(), key=lambda r: (r[1], r[0]))[:bound]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in
                                          enumerate((pa.string(), pa.int64(), pa.bool_()))], names=["run", "rank", "random"])

    runs = (texts(docs).select("text").mapInArrow(sample, "run string, rank long, random boolean")
            .groupBy("run", "rank").agg(F.max("random").alias("random")))
    parts = [runs.filter(F.col("random") == flag).orderBy("rank", "run").limit(bound) for flag in (True, False)]
    return parts[0].unionByName(parts[1]).select("run", "random")


def _ratio(table: np.ndarray, smooth: float, prior: float) -> tuple[float, ...]:
    """Log ratios from transition counts (class, predecessor, character)."""
    table = table[:, :, 1:]
    single = table.sum(axis=1, keepdims=True) + smooth
    table = table + prior * single / single.sum(axis=2, keepdims=True)
    logs = np.log(table) - np.log(table.sum(axis=2, keepdims=True))
    ratio = np.zeros((_SIZE, _SIZE))
    ratio[:, 1:] = logs[1] - logs[0]
    return tuple(float(x) for x in ratio.ravel())


def train(samples: DataFrame, least: int = 16, margin: float | None = None, smooth: float = 0.5, prior: float = 60.0,
          keys: int = 1000, held: int = 5000, false_alarms: float = 0.001) -> MarkovPair:
    """Fit both first-order models from (run, random) rows, read twice, and ``keys`` seeded random strings per alphabet.

    Counts of (half, class, previous character, character) are made by Spark;
    at most 4 x 69 x 68 of them reach the driver.  A transition's estimate
    leans on its character's add-``smooth`` frequency with the weight of
    ``prior`` observations, so rare and unseen ones stay sound.  Without a
    ``margin`` it is the least one, to a hundredth and from 0.1 to 2, at which
    models fitted on one half of the runs find anything in at most
    ``false_alarms`` of the ordinary runs of the other half (the first
    ``held`` by hash, of those with ``least`` characters; 0.35 where there
    are fewer than 100).
    """
    half = samples.filter("length(run) > 0").withColumn("half", F.pmod(F.xxhash64("run"), F.lit(2)).cast("int"))
    step = F.expr("transform(sequence(1, length(run)), i -> "
                  "struct(if(i = 1, '', substring(run, i - 1, 1)) AS before, substring(run, i, 1) AS now))")
    counts = half.select("half", "random", F.inline(step)).groupBy("half", "random", "before", "now").count().collect()
    table = np.zeros((2, 2, _SIZE, _SIZE))
    for r in counts:
        if r["now"] in _CODE:
            table[r["half"], int(r["random"]), _CODE.get(r["before"], 0), _CODE[r["now"]]] += r["count"]
    for i, run in enumerate(random_strings(keys)):
        before = 0
        for c in run:
            table[i % 2, 1, before, _CODE[c]] += 1
            before = _CODE[c]
    if margin is None:
        rows = half.filter(f"half = 1 AND NOT random AND length(run) >= {int(least)}").orderBy(F.xxhash64("run"), "run").limit(held)
        runs, own = [r["run"] for r in rows.select("run").collect()], _ratio(table[0], smooth, prior)
        low, high = (10, 200) if len(runs) >= 100 else (35, 35)
        while low < high:
            at = (low + high) // 2
            pair = MarkovPair(own, least, at / 100)
            low, high = (low, at) if sum(bool(pair.segments(r)) for r in runs) <= false_alarms * len(runs) else (at + 1, high)
        margin = low / 100
    return MarkovPair(_ratio(table.sum(axis=0), smooth, prior), least, margin)


def _scan_udf(model: MarkovPair | None):
    fields = "n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"

    @F.arrow_udf(fields)
    def run(col: pa.Array) -> pa.Array:
        out = []
        for x in col:
            spans = scan(x.as_py(), model)
            base = [s for s in spans if s[1] != "markov"]
            n = {k: sum(s[1] == k for s in spans) for k in KINDS}
            out.append((n["assign"], n["access"], n["hex"], n["markov"],
                        hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        cols = zip(*out) if out else [[] for _ in kinds]
        return pa.StructArray.from_arrays([pa.array(list(c), type=k) for c, k in zip(cols, kinds)],
                                          names=[f.split()[0] for f in fields.split(", ")])

    return run


def secret_scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """One row per document: doc_id, counts by kind, digest of the base spans, all spans.

    Without ``model`` one is trained from the documents' own labelled samples.
    Null and empty texts have no spans (digest of the empty string).  Every
    text is scanned whole and alone; repeated rows give repeated results.
    """
    model = model or train(stored(labelled_samples(docs), "samples"))
    return texts(docs).withColumn("s", _scan_udf(model)(F.col("text"))).select("doc_id", "s.*")


def redact(text: Column, model: MarkovPair, mark: str = "[secret]") -> Column:
    """The text with every span (overlaps merged) replaced by ``mark``; null stays null."""
    @F.arrow_udf("string")
    def run(col: pa.Array) -> pa.Array:
        out = []
        for x in col:
            s = x.as_py()
            if s is not None:
                parts, at = [], 0
                for start, _, end in scan(s, model):
                    if start >= at:
                        parts += [s[at:start], mark]
                    at = max(at, end)
                s = "".join(parts) + s[at:]
            out.append(s)
        return pa.array(out, type=pa.string())

    return run(text)


def without_secrets(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """All documents with all columns; secrets in ``text`` replaced, ``n_chars`` (if there) counted anew."""
    model = model or train(stored(labelled_samples(docs), "samples"))
    tmp = fresh(docs, "clean__")
    out = docs.withColumn(tmp, redact(F.col("text").cast("string"), model))
    cols = {"text": F.col(tmp)}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(F.col("n_chars").isNull(), None).otherwise(F.length(F.col(tmp))).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(cols).select(*docs.columns)
