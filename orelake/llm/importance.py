"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import LOWER, mix, slices, stored, texts, word_hashes

BUCKETS = 1 << 20


def _grams(part: pa.RecordBatch, column: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words of the batch's texts, ASCII lower-cased."""
    rows, found = [], []
    for i, t in enumerate(part.column(column)):
        t = t.as_py()
        if t:
            _, _, h = word_hashes(LOWER[np.frombuffer(t.encode(), dtype=np.uint8)])
            with np.errstate(over="ignore"):
                g = np.concatenate((h, mix(h[:-1] + np.uint64(3) * h[1:], 1)))
            found.append((g % np.uint64(buckets)).astype(np.int64))
            rows.append(np.full(len(g), i, dtype=np.int64))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(found)


def target_sample(labels: DataFrame, bound: int = 100_000, seed: int = 11) -> DataFrame:
    """doc_id of at most ``bound`` documents labelled good and not toxic, by smallest seeded hash.

    Of several labels of one document the worst counts; null ids, null
    qualities and null toxicities do not make a target.
    """
    worst = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    good = worst.filter("doc_id IS NOT NULL AND q = 1 AND t = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    return good.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(bound)


def gram_models(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, smooth: float = 10.0) -> np.ndarray:
    """Log ratio target : raw of each bucket's probability.

    Raw counts are scaled to the target's total before ``smooth`` is added to
    both, so a gram too rare to be expected in the target weighs about 0.
    The raw model counts all documents, the target model those whose id is in
    ``target`` (bounded by :func:`target_sample`, hence broadcast).  A task
    sends one row per bucket it met; the driver gets ``buckets`` sums.
    """
    flagged = texts(docs).join(F.broadcast(target.select("doc_id", F.lit(True).alias("is_target"))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                row, gram = _grams(part, 0, buckets)
                own = np.array([bool(x) for x in part.column(1).to_pylist()])
                total[0] += np.bincount(gram, minlength=buckets)
                if len(row):
                    total[1] += np.bincount(gram[own[row]], minlength=buckets)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])],
                                         names=["bucket", "raw", "target"])

    sums = (flagged.select("text", "is_target").mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, own = np.zeros(buckets), np.zeros(buckets)
    at = sums["bucket"].to_numpy()
    raw[at], own[at] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    raw *= own.sum() / max(raw.sum(), 1)
    return np.log(own + smooth) - np.log(raw + smooth)


def log_weight(text: Column, ratio: np.ndarray) -> Column:
    """Struct (n_grams, log_weight): the sum of the log ratios of all grams of a text; 0 for null and empty texts."""
    @F.arrow_udf("struct<n_grams: long, log_weight: double>")
    def score(col: pa.Array) -> pa.Array:
        n, w = np.zeros(len(col), dtype=np.int64), np.zeros(len(col))
        at = 0
        for part in slices(pa.RecordBatch.from_arrays([col], names=["text"]), 0):
            row, gram = _grams(part, 0, len(ratio))
            size = part.num_rows
            n[at:at + size] = np.bincount(row, minlength=size)
            w[at:at + size] = np.bincount(row, weights=ratio[gram], minlength=size)
            at += size
        return pa.StructArray.from_arrays([pa.array(n), pa.array(w)], names=["n_grams", "log_weight"])

    return score(text)


def top_threshold(df: DataFrame, key: str, k: int) -> float | None:
    """The ``k``-th largest value of a double column, exactly, without a sort.

    The range that holds it is cut into 4,096 parts again and again by
    counting; the driver sees that many counts a step.  ``None`` if there are
    fewer than ``k`` values or ``k`` is 0.
    """
    rows = df.select(F.col(key).cast("double").alias("v")).filter("v IS NOT NULL")
    edge = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if k <= 0 or edge[2] < k:
        return None
    low, high, need = edge[0], edge[1], k
    while low < high:
        step = (high - low) / 4096
        if step == 0:  # neighbours among the smallest doubles
            return low
        part = F.least(F.lit(4095), F.floor((F.col("v") - F.lit(low)) / F.lit(step)))
        inside = rows.filter((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        bins = inside.groupBy(part.alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in sorted(bins.collect(), key=lambda r: -r["b"]):
            if need <= r["n"]:
                break
            need -= r["n"]
        low, high = r["lo"], r["hi"]
    return low


def importance_resample(docs: DataFrame, labels: DataFrame, share: float | None = None, bound: int = 100_000,
                        buckets: int = BUCKETS, seed: int = 11, length: int = 400) -> DataFrame:
    """doc_id, n_grams, log_weight, key, kept of every document.

    ``log_weight`` is the sum over a text's grams.  ``key`` is that weight for
    ``length`` grams (the sum times length / (grams + 20), so that long texts
    are not favoured for their length and very short ones stay near 0) plus
    Gumbel noise drawn from a hash of the id, so the documents with the ``k``
    largest keys are a sample without replacement in proportion to the weights.  ``k`` is ``share`` of
    the documents; by default the share of targets among labelled documents.
    Keys equal to the ``k``-th are all kept, so repeated rows share their
    fate.  Null and empty texts weigh 0; a null id has noise of its own.
    Without labelled targets all weights are flat but defined.
    """
    ratio = gram_models(docs, target_sample(labels, bound, seed), buckets)
    if share is None:
        worst = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        share = worst.agg(F.avg(F.when(F.expr("q = 1 AND t = 0"), 1.0).otherwise(0.0))).first()[0] or 0.0
    noise = -F.log(-F.log((F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("gumbel"), "doc_id"), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)))
    scored = texts(docs).select("doc_id", log_weight(F.col("text"), ratio).alias("w")).select("doc_id", "w.*")
    even = F.col("log_weight") * F.lit(float(length)) / (F.col("n_grams") + F.lit(20))
    scored = stored(scored.withColumn("key", even + noise), "weights")
    least = top_threshold(scored, "key", round(share * scored.count()))
    kept = F.lit(False) if least is None else F.col("key") >= F.lit(least)
    return scored.withColumn("kept", kept)
