"""Unions and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tableloom.operators.project import ordering
from tableloom.spec import check_columns, choice


def union_all(
    df: DataFrame, others: list[DataFrame], by: str = "by_name", allow_missing: bool = True, deduplicate: bool = False
) -> DataFrame:
    """Stack frames by name or position, optionally keeping distinct rows only."""
    if choice(by, ("by_name", "by_position"), "union_type") == "by_name":
        out = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=allow_missing), others, df)
    else:
        out = reduce(DataFrame.union, others, df)
    return out.dropDuplicates() if deduplicate else out


def drop_duplicates(
    df: DataFrame, columns: list[str] | None = None, order_by: list[str] | None = None, directions: str | None = None
) -> DataFrame:
    """One row per key: any row, or the first by ``order_by`` (descending by default).

    The ordered form is ``row_number() = 1``; Spark limits each key to its best
    row within every map task before the shuffle (WindowGroupLimit), so a hot
    key sends one row per task instead of all its rows.
    """
    columns = columns or None
    check_columns(df, [*(columns or []), *(order_by or [])], "drop_duplicates")
    if not order_by:
        return df.dropDuplicates(columns)
    keys = columns or df.columns
    spec = Window.partitionBy(*keys).orderBy(*ordering(order_by, directions, default="desc"))
    return df.withColumn("__rn", F.row_number().over(spec)).filter("__rn = 1").drop("__rn")
