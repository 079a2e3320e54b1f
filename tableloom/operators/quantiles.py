"""Exact quantiles without a per-task value table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tableloom.operators.numbering import cumulate


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """Linearly interpolated quantiles as one row ``(n, q)`` with ``q`` an array.

    Values are counted (map-side combined), the counts are accumulated in value
    order over split ranges, and only the rows around each wanted position
    survive the filter: memory per task does not depend on the data.
    """
    values = df.select(F.col(f"`{column}`").cast("double").alias("v")).filter("v IS NOT NULL")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    total = values.agg(F.count(F.lit(1))).scalar()
    upto = cumulate(counts, [], [("v", "asc")], sums={"last": "c"}).withColumn("n", total)
    at = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    inside = lambda pos: (F.col("last") - F.col("c") <= pos) & (pos < F.col("last"))
    wanted = reduce(lambda a, b: a | b, [inside(F.floor(p)) | inside(F.ceil(p)) for p in at])
    near = upto.filter(wanted)
    low = [F.max(F.when(inside(F.floor(p)), F.col("v"))) for p in at]
    high = [F.max(F.when(inside(F.ceil(p)), F.col("v"))) for p in at]
    part = [F.max(p - F.floor(p)) for p in at]
    q = F.array(*[lo + (hi - lo) * fr for lo, hi, fr in zip(low, high, part)])
    return near.agg(F.coalesce(F.max("n"), F.lit(0).cast("bigint")).alias("n"), q.alias("q"))
