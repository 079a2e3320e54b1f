"""Recurring multi-step patterns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.operators.keys import mark_by_keys, one_row_per_key, same_key
from tableloom.operators.numbering import cumulate
from tableloom.session import once


def running_total_with_reset(
    df: DataFrame, keys: list[str], order: list[str], value: str, reset: str, output: str = "running_total"
) -> DataFrame:
    """Running sum that starts again at every row where ``reset`` holds.

    The number of resets so far is itself a running sum and names the segment;
    the total is the running sum within it. Both are split over ranges of the
    order columns, so a key may be of any size. ``keys`` and ``order`` together
    must be unique.
    """
    sort = [(c, "asc") for c in order]
    flagged = df.withColumns(
        {"__reset": F.when(F.expr(reset), 1).otherwise(0).cast("bigint"), "__v": F.coalesce(F.col(value), F.lit(0))}
    )
    segments = once(cumulate(flagged, keys, sort, sums={"__segment": "__reset", "__all": "__v"}), "segments")
    # The total before a segment is the running sum just ahead of its first row.
    ahead = segments.groupBy(*keys, "__segment").agg(F.min(F.struct(*order, (F.col("__all") - F.col("__v")).alias("b"))).alias("f"))
    starts = ahead.select(*keys, "__segment", F.col("f.b").alias("__before"))
    joined = mark_by_keys(segments, [*keys, "__segment"], starts)
    return joined.select(*df.columns, (F.col("__all") - F.col("__before")).alias(output))


def rollup_with_adjustments(
    df: DataFrame, keys: list[str], measure: str, expected: DataFrame, label: str = "adjustment"
) -> DataFrame:
    """Base rows plus one adjustment row per group whose sum misses ``expected``."""
    got = df.groupBy(*keys).agg(F.sum(measure).alias("__got"))
    want = expected.select(*keys, F.col(measure).alias("__want"))
    gap = want.alias("r").join(got.alias("l"), same_key("r", "l", keys), "left")
    missing = gap.select(
        *[F.col(f"r.`{k}`") for k in keys],
        (F.col("r.__want") - F.coalesce(F.col("l.__got"), F.lit(0))).alias(measure),
        F.lit(label).alias("row_kind"),
    ).filter(F.col(measure) != 0)
    return df.withColumn("row_kind", F.lit("base")).unionByName(missing, allowMissingColumns=True)


def generate_rows(df: DataFrame, start: Column, stop: Column, step: Column, output: str) -> DataFrame:
    """One row per value between ``start`` and ``stop``."""
    return df.withColumn(output, F.explode(F.sequence(start, stop, step)))


def lookup_with_fallback(
    df: DataFrame, lookups: list[tuple[str, DataFrame, list[str]]], value: str, default: str, output: str
) -> DataFrame:
    """First lookup table that knows the row's keys wins; the source is named.

    Each entry is ``(name, table, keys)`` with ``value`` a column of the table.
    """
    out, values, sources = df, [], []
    for i, (name, table, keys) in enumerate(lookups):
        facts = one_row_per_key(table.select(*keys, F.col(value).alias(f"__v{i}")), keys, f"lookup {name}")
        out = out.join(facts, keys, "left")
        values.append(F.col(f"__v{i}"))
        sources.append(F.when(F.col(f"__v{i}").isNotNull(), F.lit(name)))
    return out.select(
        *df.columns,
        F.coalesce(*values, F.lit(default)).alias(output),
        F.coalesce(*sources, F.lit("default")).alias(f"{output}_source"),
    )


def placeholder_members(facts: DataFrame, dimension: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Dimension rows to add for facts that arrived before their member."""
    used = facts.select(*[F.col(a).alias(b) for a, b in keys]).distinct().dropna()
    names_ = [b for _, b in keys]
    missing = used.join(dimension.select(*names_), names_, "left_anti")
    rest = [F.lit(None).cast(t).alias(c) for c, t in dimension.dtypes if c not in names_]
    return missing.select(*names_, *rest).select(*dimension.columns).withColumn("is_placeholder", F.lit(True))


def split_transform_union(df: DataFrame, branches: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """Different column expressions per kind of row, in one projection.

    ``branches`` lists (condition, {column: expression}); the first condition
    that holds applies, rows without one pass unchanged. Because every branch
    keeps the rows, conditional columns replace filter and union.
    """
    which = reduce(
        lambda acc, i: acc.when(F.expr(branches[i][0]), F.lit(i)), range(len(branches)), F.when(F.lit(False), F.lit(-1))
    ).otherwise(F.lit(-1))
    tagged = df.withColumn("__branch", which)
    columns = list(dict.fromkeys(c for _, exprs in branches for c in exprs))
    made = {}
    for c in columns:
        value = F.when(F.lit(False), F.lit(None))
        for i, (_, exprs) in enumerate(branches):
            if c in exprs:
                value = value.when(F.col("__branch") == i, F.expr(exprs[c]))
        made[c] = value.otherwise(F.col(f"`{c}`") if c in df.columns else F.lit(None))
    return tagged.withColumns(made).drop("__branch")
