"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule: its share of the mix over training time
0 to 1, given by knots joined with straight lines. Targets are the weights' shares
of the words to train on, filled like vessels: no source gives more than ``cap``
times what it holds, and what is above is shared again by weight. Within a
source the documents follow each other in the order of the hash of their id; the
tape of their words, repeated as often as needed, is the source's cumulative
demand. Its schedule is integrated in closed form (a parabola between
knots) and inverted, so that every document gets the time at which the demand
reaches it, and the mix is the rows range-sorted by that time.

Running totals are split: totals of (source, hash block) come from a partial
aggregate, a window adds them up over the blocks, and a second window runs inside a
block. A source with a third of all rows is thus dealt over all its blocks.

Defined cases: a null text has size 0 and takes nothing; a null source is a source
of its own, last in order; a null id hashes as the empty text; rows that are alike in
source, id and size are interchangeable; a source without words has target 0; an
empty table gives an empty result. Extra columns are carried along, one named
like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A word for sizes, as the contract of the mix has it.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights repeat along the sources; each weight has its schedule of (time, relative rate).
WEIGHTS = (3, 1, 2)
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)))
SHARE, CAP = 1.5, 2.0
#: Hexadecimal digits of the hash that name a block: 4,096 blocks of each source.
BLOCK_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``_key, turn, source_size, target`` from one row per (source, block) with ``_words``; one row per source."""
    totals = sizes.groupBy("_key").agg(F.sum("_words").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy("_key")) - 1) % len(weights)
    listed = totals.withColumn("turn", turn)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)
    rows = listed.select("_key", "turn", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(float(cap))).alias("most"))
    rows = rows.withColumn("ratio", F.col("most") / F.col("w"))
    by_ratio = Window.orderBy("ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    held, used = F.coalesce(F.sum("most").over(by_ratio), F.lit(0.0)), F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0))
    # with the sources of the smallest ratios full, the others share the rest by weight; the level is the highest such share
    share_left = (F.sum("source_size").over(every) * F.lit(float(share)) - held) / (F.sum("w").over(every) - used)
    leveled = rows.withColumn("part", share_left)
    leveled = leveled.withColumn("level", F.max("part").over(every))
    return leveled.select("_key", "turn", "source_size", F.least("most", F.col("level") * F.col("w")).alias("target"))


def when_reached(demand: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of a schedule reaches a share ``demand`` of its whole."""
    spans, total = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        spans.append((t0, t1, r0, r1, total))
        total += (r0 + r1) / 2 * (t1 - t0)
    out = None
    for t0, t1, r0, r1, before in reversed(spans):
        left = demand * F.lit(total) - F.lit(before)
        root = F.sqrt(F.lit(r0 * r0) + left * F.lit(2 * (r1 - r0) / (t1 - t0)))
        at = F.lit(t0) + left * F.lit(2.0) / (root + F.lit(r0))
        out = at if out is None else F.when(demand * F.lit(total) < F.lit(before + (r0 + r1) / 2 * (t1 - t0)), at).otherwise(out)
    return out


def mix(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: Sequence[float] = WEIGHTS,
    schedules: Sequence = SCHEDULES, share: float = SHARE, cap: float = CAP, digits: int = BLOCK_DIGITS,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken, position``.

    ``taken`` counts the words the mix takes of a document, repeats included, and
    ``position`` is the training time of its first copy (null when none is taken). The words
    taken of a source add up to its rounded target.
    """
    new = {"size", "source_size", "target", "taken", "position", "_turn", "_start"}
    kept = [c for c in docs.columns if c.lower() not in new]
    hashed = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    # the caller's columns are one struct meanwhile, whatever they are called
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{key}`").alias("_id"), word_count(text).alias("size"),
        hashed.alias("_hash"), F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("~")).alias("_key"),
    ).withColumn("_block", F.substring("_hash", 1, digits))
    blocks = sized.groupBy("_key", "_block").agg(F.sum("size").alias("_words"))
    targets = source_targets(blocks, weights, share, cap)
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_key", "_block", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"))
    facts = offsets.join(targets, "_key")
    inside = Window.partitionBy("_key", "_block").orderBy("_hash", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(facts, ["_key", "_block"])
    placed = placed.withColumn("_start", F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal, whole = F.floor(F.col("target") + 0.5), F.greatest("source_size", F.lit(1))
    rest = goal - F.floor(goal / whole) * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_start"), F.lit(0)), F.col("size"))
    taken = (F.floor(goal / whole) * F.col("size") + part).cast("long")
    demand = F.col("_start") / F.greatest("target", F.lit(1.0))
    position = F.coalesce(*[F.when(F.col("turn") == i, when_reached(demand, knots)) for i, knots in enumerate(schedules)])
    out = placed.withColumn("taken", taken).withColumn("position", F.when(F.col("taken") > 0, position))
    return out.select(*[F.col(f"_row.`{c}`") for c in kept], "size", "source_size", "target", "taken", "position", F.col("turn").alias("_turn"), "_start")


def in_training_order(mixed: DataFrame, repeat: bool = False, schedules: Sequence = SCHEDULES) -> DataFrame:
    """The rows range-sorted by position; with ``repeat`` one row for each copy, at that copy's own position."""
    if repeat:
        copies = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
        many = mixed.filter("taken > 0").select(F.struct("*").alias("row"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
        demand = (F.col("row._start") + F.col("copy") * F.col("row.source_size")) / F.greatest("row.target", F.lit(1.0))
        at = F.coalesce(*[F.when(F.col("row._turn") == i, when_reached(demand, knots)) for i, knots in enumerate(schedules)])
        mixed = many.select(*[at.alias(c) if c == "position" else F.col(f"row.`{c}`") for c in mixed.columns])
    # documents that the mix leaves out have no position; their place on the tape spreads them
    order = [F.col("position").asc_nulls_last(), F.col("_start")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_turn", "_start")
