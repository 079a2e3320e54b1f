"""Running totals and row numbers over groups too large for one task.

A plain window sorts each partition inside one task. That is right for ordinary
groups and impossible for a group holding a third of the table, or for a
whole-table numbering. ``cumulate`` range-partitions the rows by (group, order),
so that a large group spreads over many ranges, totals each (group, range), and
adds the totals of the ranges before to a window inside the range. Every row is
counted, so the result equals that of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.operators.keys import same_key
from tableloom.session import settle

Order = list[tuple[str, str]]  # (column, "asc" | "desc")


def sort_columns(order: Order) -> list[Column]:
    return [F.col(f"`{c}`").asc() if d == "asc" else F.col(f"`{c}`").desc() for c, d in order]


def range_count(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions, which its owner sized to the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_ranges(df: DataFrame, keys: list[str], order: Order, ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of (keys, order), the number of a row's range in ``__range``.

    Equal (keys, order) fall into one range, and ranges ascend with the order.
    The result is written to the shared folder: partition numbers are facts of
    one execution and must not change when a lost task is repeated.
    """
    by = [*[F.col(f"`{k}`").asc() for k in keys], *sort_columns(order)]
    parts = df.repartitionByRange(ranges or range_count(df), *by)
    return settle(parts.withColumn("__range", F.spark_partition_id()), "ranges")


def cumulate(
    df: DataFrame,
    keys: list[str],
    order: Order,
    sums: dict[str, str] | None = None,
    lows: dict[str, str] | None = None,
    highs: dict[str, str] | None = None,
    ranges: int | None = None,
    lead: int | None = None,
) -> DataFrame:
    """Inclusive running sums, minima and maxima per group in ``order``.

    ``sums``/``lows``/``highs`` map an output column to the input column. The
    (keys, order) combination must be unique; callers aggregate ties first.
    Ranges are cut on the first ``lead`` order columns (default: all), which
    keeps wide tie-breakers out of the partitioning.
    """
    kinds = [(F.sum, sums or {}), (F.min, lows or {}), (F.max, highs or {})]
    ranged = with_ranges(df, keys, order[:lead], ranges)
    both = [*keys, "__range"]
    local = Window.partitionBy(*both).orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumns({f"__l_{o}": fn(F.col(f"`{c}`")).over(local) for fn, m in kinds for o, c in m.items()})
    totals = ranged.groupBy(*both).agg(*[fn(F.col(f"`{c}`")).alias(f"__t_{o}") for fn, m in kinds for o, c in m.items()])
    # One row per (group, range): a group has at most as many as there are ranges.
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*both, *[fn(f"__t_{o}").over(earlier).alias(f"__s_{o}") for fn, m in kinds for o in m])
    joined = within.alias("l").join(starts.alias("r"), same_key("l", "r", both), "left").select(
        "l.*", *[F.col(f"r.__s_{o}") for _, m in kinds for o in m]
    )

    def combined(fn, o: str) -> Column:
        here, start = F.col(f"__l_{o}"), F.col(f"__s_{o}")
        if fn is F.sum:
            return F.coalesce(here + start, here, start)
        return (F.least if fn is F.min else F.greatest)(here, start)

    out = joined.withColumns({o: combined(fn, o) for fn, m in kinds for o in m})
    return out.select(*df.columns, *[o for _, m in kinds for o in m if o not in df.columns])


def number_rows(df: DataFrame, order: Order, output: str, ranges: int | None = None) -> DataFrame:
    """``row_number`` over the whole table for a unique ``order``, without one task sorting it."""
    ones = df.withColumn("__one", F.lit(1).cast("long"))
    return cumulate(ones, [], order, sums={output: "__one"}, ranges=ranges).drop("__one")
