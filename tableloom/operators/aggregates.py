"""Grouping, pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.spec import SpecError, check_columns, choice

AGGREGATES = {
    "sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max, "first": F.first, "last": F.last,
    "count_distinct": F.count_distinct,
}
PIVOT_AGGREGATES = tuple(k for k in AGGREGATES if k != "count_distinct")


def aggregate(
    df: DataFrame, group_by: list[str], columns: list[str], functions: list[str], outputs: list[str]
) -> DataFrame:
    """Pairwise aggregates; without grouping columns one row comes back.

    All functions combine before the shuffle, so a hot group costs one partial
    row per task; distinct counts shuffle on (group, value) first.
    """
    if not len(columns) == len(functions) == len(outputs):
        raise SpecError("aggregate_data: column_name, aggregation and output_column_name differ in length")
    check_columns(df, [c for c in [*group_by, *columns] if c != "*"], "aggregate_data")
    chosen = [choice(f, AGGREGATES, "aggregation") for f in functions]
    aggs = [
        (F.count(F.lit(1)) if c == "*" and f == "count" else AGGREGATES[f](F.col(f"`{c}`"))).alias(o)
        for c, f, o in zip(columns, chosen, outputs)
    ]
    return df.groupBy(*group_by).agg(*aggs)


def pivot(
    df: DataFrame,
    group_by: list[str],
    pivot_column: str,
    columns: list[str],
    functions: list[str],
    values: list | None = None,
) -> DataFrame:
    """Pivot; without ``values`` Spark discovers them in one extra aggregate.

    Result columns keep Spark's own names: the pivot value for one aggregate,
    value and aggregate for several.
    """
    if len(columns) != len(functions):
        raise SpecError("pivot_data: value_column and aggregation differ in length")
    check_columns(df, [*group_by, pivot_column, *columns], "pivot_data")
    aggs = [AGGREGATES[choice(f, PIVOT_AGGREGATES, "aggregation")](F.col(c)) for c, f in zip(columns, functions)]
    return df.groupBy(*group_by).pivot(pivot_column, values).agg(*aggs)


def unpivot(df: DataFrame, ids: list[str], values: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Columns to rows; null values stay."""
    check_columns(df, [*ids, *values], "unpivot_data")
    return df.unpivot(ids, values, variable, value)
