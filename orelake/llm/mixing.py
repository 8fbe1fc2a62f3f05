"""Mixing sources to target weights by Pfair scheduling; DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.llm.common import fresh, running_total

# What all sources have had when each has had ``v`` times its weight, or ended: the slot of the ideal fluid mix.
_FLUID = "aggregate(s, 0D, (t, y) -> t + least(CAST(y.n AS DOUBLE), y.w * ({v})))"

# One slot after the other: of the sources whose next block is released, the one with the earliest deadline (then the
# lowest number) goes next.  Slots are gathered by ``parts``, so that no long list is copied for each of them.
_STEP = """
element_at(transform(
  array(array_min(transform(q, (x, k) -> IF(state.done[k] < size(x.jobs), named_struct(
    'early', x.jobs[state.done[k]].release > t, 'deadline', x.jobs[state.done[k]].deadline, 'no', k), NULL)))),
  next -> named_struct(
    'done', transform(state.done, (d, k) -> IF(k = next.no, d + 1L, d)),
    'out', concat(state.out, array(named_struct('slot', t, 'no', next.no, 'block', state.done[next.no]))))), 1)
"""
_EDF = f"""
aggregate(
  sequence(0L, (total - 1L) DIV {{parts}}L),
  named_struct('done', transform(q, x -> 0L), 'out', CAST(array() AS ARRAY<ARRAY<STRUCT<slot: BIGINT, no: INT, block: BIGINT>>>)),
  (all, p) -> element_at(transform(
    array(aggregate(
      sequence(p * {{parts}}L, least((p + 1L) * {{parts}}L, total) - 1L),
      named_struct('done', all.done, 'out', CAST(array() AS ARRAY<STRUCT<slot: BIGINT, no: INT, block: BIGINT>>)),
      (state, t) -> {_STEP})),
    part -> named_struct('done', part.done, 'out', concat(all.out, array(part.out)))), 1)).out
"""


def _weight(weights: dict[str, float] | None) -> Column:
    """The weight of a source row (key__, n): given, or the square root of its number of blocks."""
    if not weights:
        return F.sqrt(F.col("n"))
    if min(weights.values()) <= 0:
        raise ValueError("weights must be above 0")
    table = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (f"s:{k}", float(v))])
    return F.coalesce(F.element_at(table, F.col("key__")), F.lit(float(min(weights.values()))))


def schedule(blocks: DataFrame, weights: dict[str, float] | None = None, parts: int = 1000) -> DataFrame:
    """(key__, n) rows -> one row per block: key__, block, period (slot DIV ``parts``), slot, release, deadline.

    Pfair windows over all blocks: in the ideal fluid mix every source has a
    share of each slot in proportion to its weight until it ends, and those
    that last share what it leaves in the same proportion.  A block is
    released in the slot in which the fluid mix begins it and due by the end
    of the one in which it is done.  The fluid mix meets all windows, so
    earliest deadline first does, too: at every slot each source is less than
    one block from its true share, however many sources or slots, and every
    block is placed once.  (Windows are told from doubles, a millionth of a
    slot is forgiven.)

    The order is one fold over all blocks in one row, so its length is bounded
    by the caller (see :func:`mix_sources`); a slot costs a step per source,
    which is meant for up to some hundred sources.
    """
    weighted = blocks.withColumn("w", _weight(weights))
    whole = weighted.agg(F.array_sort(F.collect_list(F.struct("key__", "n", "w"))).alias("s")).filter("size(s) > 0")
    release = f"CAST(floor({_FLUID.format(v='i / x.w')} + 1e-6D) AS BIGINT)"
    deadline = f"CAST(ceil({_FLUID.format(v='(i + 1L) / x.w')} - 1e-6D) AS BIGINT)"
    jobs = f"transform(sequence(0L, x.n - 1L), i -> named_struct('release', {release}, 'deadline', {deadline}))"
    table = whole.select(F.expr(f"transform(s, x -> named_struct('key__', x.key__, 'jobs', {jobs}))").alias("q"),
                         F.expr("aggregate(s, 0L, (t, x) -> t + x.n)").alias("total"))
    placed = table.select("q", F.explode(F.expr(_EDF.format(parts=int(parts)))).alias("part"))
    return placed.select("q", F.inline("part")).select(
        F.expr("q[no].key__").alias("key__"), "block", F.expr(f"slot DIV {int(parts)}").alias("period"), "slot",
        F.expr("q[no].jobs[block].release").alias("release"), F.expr("q[no].jobs[block].deadline").alias("deadline"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = 32_768,
                parts: int = 1000, most_blocks: int = 200_000) -> DataFrame:
    """One row per document: doc_id, source, n_chars, block, period, slot, release, deadline.

    A source's documents, in the order of a hash of their ids, form blocks of
    ``block_chars`` code points, or of as many as make ``most_blocks`` of all
    texts if that is more; a document longer than a block also takes up the
    blocks it covers.  Without ``weights`` a source weighs the square root
    of its size; with them, a source not named weighs as much as the least
    one.  A null source is a source of its own, null and empty texts are 0
    long, repeated rows are documents of their own; equal ids are in any
    order.  No documents give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_chars"))
    return _placed(rows, weights, block_chars, parts, most_blocks)


def _placed(rows: DataFrame, weights: dict[str, float] | None, block_chars: int, parts: int, most_blocks: int) -> DataFrame:
    keyed = rows.withColumn("key__", F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("s:"), "source")))
    # One row per source: the window over all of them gives the size of a block.
    every = F.sum("chars").over(Window.partitionBy())
    size = (keyed.groupBy("key__").agg(F.sum("n_chars").alias("chars"))
            .withColumn("room", F.greatest(F.lit(int(block_chars)), F.ceil(every / F.lit(int(most_blocks)))).cast("long"))
            .select("key__", "room", F.greatest(F.lit(1), F.ceil(F.col("chars") / F.col("room"))).cast("long").alias("n")))
    run = running_total(keyed, ["key__"], ["doc_id"], F.col("n_chars"), "before__")
    located = (run.join(size, "key__")
               .withColumn("block", F.least(F.expr("before__ DIV room"), F.col("n") - 1)))
    plan = schedule(size.select("key__", "n"), weights, parts)
    out = located.drop("n", "room").join(plan, ["key__", "block"])
    return out.select(*rows.columns, "block", "period", "slot", "release", "deadline")


def mixed_documents(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = 32_768,
                    parts: int = 1000, most_blocks: int = 200_000) -> DataFrame:
    """All documents with all their columns, in the order of the mix (sorted over the written files)."""
    row = fresh(docs, "row__")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = numbered.select(F.col(row).alias("mix_row__"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("source").cast("string").alias("source"),
                           F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_chars"))
    slot = fresh(docs, "slot__")
    plan = _placed(rows, weights, block_chars, parts, most_blocks).select(F.col("mix_row__").alias(row), F.col("slot").alias(slot))
    order = [slot, row]
    return numbered.join(plan, row).repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
