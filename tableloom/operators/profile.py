"""Column profiles, value distributions and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableloom.operators.numbering import range_count
from tableloom.spec import check_columns

ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per column, from one aggregate over all columns.

    Distinct counts are sketches unless ``exact_distinct``. Mean and deviation
    are given for numbers, minimum and maximum for numbers and dates.
    """
    none = F.lit(None)
    lines = []
    measured: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for i, f in enumerate(df.schema.fields):
        col = F.col(f"`{f.name}`")
        number, ordered = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, ORDERED)
        simple = not isinstance(f.dataType, (T.MapType,))
        distinct = F.count_distinct(col) if exact_distinct else F.approx_count_distinct(col)
        measured[f"d{i}"] = distinct if simple else none.cast("bigint")
        measured[f"k{i}"] = F.count(col)
        measured[f"a{i}"] = F.avg(col.cast("double")) if number else none.cast("double")
        measured[f"s{i}"] = F.stddev_samp(col.cast("double")) if number else none.cast("double")
        measured[f"l{i}"] = F.min(col).cast("string") if ordered else none.cast("string")
        measured[f"h{i}"] = F.max(col).cast("string") if ordered else none.cast("string")
        missing = F.col("rows") - F.col(f"k{i}")
        share = F.round(F.try_divide(missing * 100.0, F.col("rows")), 4)
        lines.append(
            F.struct(
                F.lit(f.name).alias("Column_Name"),
                F.lit(f.dataType.simpleString()).alias("Data_Type"),
                F.col("rows").alias("Total_Rows"),
                F.lit(len(df.columns)).alias("Total_Columns"),
                F.col(f"d{i}").alias("Approx_Distinct_Values"),
                missing.alias("Null_Count"),
                share.alias("Null_Percent"),
                F.round(F.col(f"a{i}"), 4).alias("Mean"),
                F.round(F.col(f"s{i}"), 4).alias("Std_Dev"),
                F.col(f"l{i}").alias("Min"),
                F.col(f"h{i}").alias("Max"),
            )
        )
    # A task keeps every different value it reads, so exact counts are taken of as many small parts as the session has partitions.
    parts = df.repartition(range_count(df)) if exact_distinct else df
    return parts.agg(*[v.alias(k) for k, v in measured.items()]).select(F.inline(F.array(*lines)))


def top_values(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column, ties by value.

    Counting is map-side combined; the ranking keeps ``n`` rows per task and
    column before its shuffle (WindowGroupLimit).
    """
    check_columns(df, columns, "top_values")
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])))
    counts = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def freshness(df: DataFrame, column: str, now: Column) -> DataFrame:
    """Newest value of a time column and its age in hours."""
    newest = F.max(F.col(f"`{column}`"))
    hours = (F.unix_micros(now) - F.unix_micros(newest.cast("timestamp"))) / F.lit(3.6e9)
    return df.agg(newest.alias("newest"), F.round(hours, 4).alias("age_hours"))


def compare_profiles(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new measures of each column side by side."""
    measures = ("Total_Rows", "Approx_Distinct_Values", "Null_Percent", "Mean")
    side = lambda df, tag: df.select("Column_Name", *[F.col(m).alias(f"{tag}_{m}") for m in measures])
    return side(old, "Old").join(side(new, "New"), "Column_Name", "full_outer")
