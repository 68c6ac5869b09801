"""Mixing sources to target weights by weighted fair queueing.

Only DataFrame functions. Each source's documents are shuffled by a hash and sent
round after round; a copy's virtual finish time is the words its source has sent
by then over the source's target. All copies are sorted by that time and cut at
the total budget.

Both running sums are taken in two steps, so a hot source is never one task's
work: hash ranges of a source, sized to some thousand documents, get a base from
the sums before them, and a window runs inside each. Virtual time fills evenly
with words, so its equal ranges are balanced by construction; only the range in
which the budget ends needs a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeflow.llm.common import power_of_two
from tradeflow.session import pin

RANGE_ROWS = 4096


def targets(
    sized: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3, share: float = 1.0
) -> DataFrame:
    """One row per source: ``_key``, ``source_size`` and ``target``.

    ``sized`` has ``source`` and ``size``. Sources in code point order, null last,
    take the weights in turn and share ``share`` of all sizes. A target stops at
    ``repeats`` times the source's size; the excess goes to the others by weight.
    Sorted by the level at which they fill up, the sources that are full form a
    prefix, so one pass of running sums settles the shares.
    """
    sources = sized.groupBy("_key", "source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1)
    )
    rows = sources.withColumns({"_weight": turn, "_cap": F.lit(repeats) * F.col("source_size")})
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_key")
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_budget": F.sum("source_size").over(every) * F.lit(share),
            "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0)),
            "_open": F.sum("_weight").over(every)
            - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        }
    )
    level = (F.col("_budget") - F.col("_full")) / F.col("_open")
    fills = level * F.col("_weight") >= F.col("_cap")
    rows = rows.withColumns({"_fills": fills, "_level": level})
    # The level of the first source that does not fill up holds for all after it.
    final = F.min(F.when(~F.col("_fills"), F.struct(F.col("_cap") / F.col("_weight"), "_key", "_level"))).over(every)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(final["_level"] * F.col("_weight"), F.col("_cap").cast("double")))
    return rows.select("_key", "source_size", target.alias("target"))


def _copies(finish: list[Column], before) -> Column:
    return sum((F.when(before(e, t), 1).otherwise(0) for e, t in enumerate(finish)), F.lit(0))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: Sequence[int] = (1, 2, 3),
    repeats: int = 3,
    share: float = 1.0,
    seed: int = 7,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` says how often the mix takes the document, 0 to ``repeats``, and
    ``taken`` is ``copies`` times ``size``. Copies enter whole, in virtual finish
    time, as long as their sum stays within the budget, so a source's words end
    within about one document of its target. A null size counts as 0; a null
    source is a source of its own; sources without any word have the target 0 and
    are not taken. Equal hashes are ordered by id and size; rows equal in id,
    source and size have the same result. An empty table gives an empty one.
    """
    text = F.col(f"`{source}`").cast("string")
    sized = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        text.alias("source"),
        F.coalesce(F.concat(F.lit("s"), text), F.lit("n")).alias("_key"),
        F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0)).alias("size"),
    ).withColumn("_h", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "_key", "size"))
    sized = pin(sized, "mix-sizes")
    n = sized.count()
    bits = 1 + power_of_two(n / RANGE_ROWS)
    sized = sized.withColumn("_range", F.shiftrightunsigned("_h", 64 - bits))

    goals = targets(sized, weights, repeats, share)
    sums = sized.groupBy("_key", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "_key", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    ).join(goals, "_key")
    inside = (
        Window.partitionBy("_key", "_range")
        .orderBy("_h", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    sent = F.sum("size").over(inside)
    queued = sized.withColumn("_sent", sent).join(bases, ["_key", "_range"])
    queued = queued.select(
        "doc_id", "_key", "size", "source_size", "target",
        (F.col("_base") + F.col("_sent")).alias("_sent"),
    )
    queued = pin(queued, "mix-queue")

    def finish(e: int) -> Column:
        words = F.col("_sent") + F.lit(e) * F.col("source_size")
        return F.when(F.col("target") > 0, words / F.col("target"))

    times = [finish(e) for e in range(repeats)]
    copies = queued.filter("target > 0").select(
        "doc_id", "_key", "size", F.posexplode(F.array(*times)).alias("_copy", "_time")
    )
    cut = _cut(copies, _budget(queued, share), n)
    if cut is None:
        within = lambda e, t: t.isNotNull()
    else:
        at = F.struct(*[F.lit(cut[c]).cast(copies.schema[c].dataType).alias(c) for c in ORDER])
        within = lambda e, t: F.coalesce(
            F.struct(t.alias("_time"), "_key", "doc_id", F.lit(e).alias("_copy")) < at, F.lit(False)
        )
    taken = _copies(times, within)
    return queued.select(
        "doc_id", "size", "source_size", "target",
        taken.cast("int").alias("copies"), (taken * F.col("size")).alias("taken"),
    )


ORDER = ["_time", "_key", "doc_id", "_copy"]


def _budget(queued: DataFrame, share: float) -> float:
    """The words to send: the targets' sum, or all the sources can give."""
    return queued.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * share


def _cut(copies: DataFrame, budget: float, n: int):
    """The first copy, in order of time, with which the words sent exceed the
    budget; None if none does."""
    ranges = 1 << power_of_two(n / RANGE_ROWS)
    slot = F.least(F.floor(F.col("_time") * ranges), F.lit(ranges * 1024)).cast("bigint")
    sorted_in = copies.withColumn("_slot", slot)
    sums = sorted_in.groupBy("_slot").agg(F.sum("size").alias("_sum"))
    running = F.sum("_sum").over(Window.orderBy("_slot"))
    over = (
        sums.withColumn("_upto", running)
        .filter(F.col("_upto") > budget)
        .orderBy("_slot")
        .select("_slot", (F.col("_upto") - F.col("_sum")).alias("_before"))
        .first()
    )
    if over is None:
        return None
    last = sorted_in.filter(F.col("_slot") == over["_slot"])
    upto = F.lit(over["_before"]) + F.sum("size").over(
        Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    )
    return last.withColumn("_upto", upto).filter(F.col("_upto") > budget).orderBy(*ORDER).first()
