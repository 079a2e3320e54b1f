"""Key comparisons, duplicate groups and size-checked broadcasts.

Group facts (how often does a key occur, is it unique) are computed by
``groupBy`` and joined back instead of by a window: partial aggregation
collapses a hot key before the shuffle, and the join-back is a skew-splittable
or, when the fact table is small, a broadcast join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.spec import SpecError

BROADCAST_LIMIT = 32 * 1024 * 1024


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of ``keys`` between two aliased frames."""
    if not keys:
        raise SpecError("a merge or key join needs at least one key column")
    return reduce(and_, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def any_null(keys: list[str]) -> Column:
    return reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (no job runs).

    Scans count their files, so the figure is an upper bound for filters and
    projections and a gross over-estimate for joins: safe for deciding that
    something is small.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only where the plan's size estimate is within ``limit``.

    Beyond it the frame is returned as it is and the planner shuffles both sides.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def duplicate_keys(df: DataFrame, keys: list[str], count_as: str = "copies") -> DataFrame:
    """Key groups with more than one row; nulls group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)


def mark_by_keys(df: DataFrame, keys: list[str], facts: DataFrame) -> DataFrame:
    """Left-join one-row-per-key ``facts`` onto ``df`` with null-safe keys."""
    extra = [c for c in facts.columns if c not in keys]
    return df.alias("l").join(facts.alias("r"), same_key("l", "r", keys), "left").select(
        "l.*", *[F.col(f"r.`{c}`") for c in extra]
    )


def one_row_per_key(df: DataFrame, keys: list[str], what: str, ignore_nulls: bool = False) -> DataFrame:
    """``df`` unchanged, with a plan that fails when a key occurs twice.

    The duplicate groups are counted with partial aggregation and reduced to a
    single number, so neither the hot key nor the list of duplicates ever
    reaches one task. ``ignore_nulls`` lets keys with a null part repeat.
    """
    counted = df.filter(~any_null(keys)) if ignore_nulls else df
    bad = duplicate_keys(counted, keys).agg(F.count(F.lit(1)).alias("n")).scalar()
    message = F.concat(F.lit(f"{what}: "), bad.cast("string"), F.lit(f" duplicate keys on {', '.join(keys)}"))
    return df.filter(F.when(bad > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
