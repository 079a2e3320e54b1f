"""Split windows equal Spark's own on skewed groups, ties, nulls and equal rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from tableloom.operators.numbering import number_rows
from tableloom.operators.quantiles import exact_quantiles
from tableloom.operators.sets import drop_duplicates
from tableloom.operators.windows import add_window
from tableloom.spec import SpecError


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, many ties, some nulls, some equal rows."""
    base = spark.range(600).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'cold' END AS g",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE cast(id % 40 AS int) END AS o", "cast(id % 13 AS bigint) AS v", "id % 300 AS id",
    )
    return base


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("fn", ["rank", "dense_rank", "sum", "avg", "count", "min", "max"])
@pytest.mark.parametrize("keys", [["g"], []])
def test_ordered_function(skewed, fn, direction, keys):
    column = None if fn in ("rank", "dense_rank") else "v"
    got = add_window(skewed, fn, "w", keys, ["o"], direction, column, hot_rows=100, ranges=5)
    spec = Window.partitionBy(*keys).orderBy(getattr(F.col("o"), direction)())
    made = getattr(F, fn)("v") if column else getattr(F, fn)()
    want = skewed.withColumn("w", made.over(spec))
    shown = lambda df: sorted(map(repr, df.select("g", "o", "v", "id", F.col("w").cast("double")).collect()))
    assert shown(got) == shown(want)


@pytest.mark.parametrize("keys", [["g"], []])
def test_row_number_is_dense_and_ordered(skewed, keys):
    got = add_window(skewed, "row_number", "w", keys, ["o", "id"], ["desc", "asc"], hot_rows=100, ranges=5)
    spec = Window.partitionBy(*keys).orderBy(F.desc("o"), F.asc("id"))
    want = skewed.withColumn("w", F.row_number().over(spec))
    shown = lambda df: sorted(map(repr, df.select("g", "o", "id", F.col("w").cast("int")).collect()))
    assert shown(got) == shown(want)


@pytest.mark.parametrize("fn", ["sum", "count", "max", "first_value"])
def test_unordered_function_on_hot_groups(skewed, fn):
    got = add_window(skewed, fn, "w", ["g"], column="v", hot_rows=100)
    if fn == "first_value":
        assert got.groupBy("g").agg(F.count_distinct("w").alias("n")).filter("n > 1").isEmpty()
        return
    want = skewed.withColumn("w", getattr(F, fn)("v").over(Window.partitionBy("g")))
    assert sorted(map(repr, got.select("g", "id", "w").collect())) == sorted(map(repr, want.select("g", "id", "w").collect()))


def test_first_value_ordered_on_hot_groups(skewed):
    got = add_window(skewed, "first_value", "w", ["g"], ["o", "id"], "asc", "v", hot_rows=100)
    spec = Window.partitionBy("g").orderBy("o", "id")
    want = skewed.withColumn("w", F.first("v").over(spec))
    assert sorted(map(repr, got.select("g", "id", "w").collect())) == sorted(map(repr, want.select("g", "id", "w").collect()))


def test_numbering_a_table(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = number_rows(df, [("k", "asc")], "n", ranges=8).collect()
    assert all(r["n"] == r["k"] + 1 for r in got)


def test_exact_quantiles(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v")).union(spark.range(50).select(F.lit(3.0)))
    row = exact_quantiles(df, "v", [0.25, 0.5, 1.0]).first()
    values = sorted([float(i) for i in range(101)] + [3.0] * 50)
    def at(p):
        pos = p * (len(values) - 1)
        lo = int(pos)
        return values[lo] + (values[min(lo + 1, len(values) - 1)] - values[lo]) * (pos - lo)
    assert row["n"] == 151
    assert row["q"] == pytest.approx([at(0.25), at(0.5), at(1.0)])


def test_ordered_dedup_limits_groups_before_the_shuffle(skewed):
    plan = drop_duplicates(skewed, ["g"], ["o", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_bad_windows_raise(skewed):
    with pytest.raises(SpecError):
        add_window(skewed, "ntile", "w", ["g"], ["o"])
    with pytest.raises(SpecError):
        add_window(skewed, "rank", "w", ["g"])
    with pytest.raises(SpecError):
        add_window(skewed, "sum", "w", ["g"])
    with pytest.raises(SpecError):
        add_window(skewed, "rank", "w", ["g"], ["o"], "sideways")
