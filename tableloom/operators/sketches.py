"""Profiles that add up: each load is measured once, and measures of loads are united without reading them again.

``measure`` turns a load into one row: counts, ends, means and squared deviations of each column, a HyperLogLog
sketch of its values and a KLL sketch of its numbers. ``unite`` adds such rows up, and ``described`` writes them
as one row for each column. Everything but the distinct counts and quantiles is exact.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableloom.operators.profile import ORDERED
from tableloom.sources.store import TableStore
from tableloom.spec import SpecError

#: Logarithm of the number of HyperLogLog registers, and the size of the KLL sketch.
REGISTERS, QUANTILES = 12, 200
#: Relative standard error of a distinct count, and the error in rank of a quantile that 99 of 100 sketches keep.
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (REGISTERS / 2), 0.0133
#: Types whose values a distinct sketch takes as they are; others are sketched by a hash.
_PLAIN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _number(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def measure(df: DataFrame) -> DataFrame:
    """One row about ``df``, in one aggregate: ``rows`` and, for the column at place ``i``, ``known_i``, ``distinct_i``,
    ``low_i`` and ``high_i`` (ordered types), ``mean_i``, ``squares_i`` and ``spread_i`` (numbers)."""
    out: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        col = F.col(f"`{f.name}`")
        out.append(F.count(col).alias(f"known_{i}"))
        if not isinstance(f.dataType, T.MapType):
            value = col if isinstance(f.dataType, _PLAIN) else F.when(col.isNotNull(), F.xxhash64(col))
            out.append(F.hll_sketch_agg(value, F.lit(REGISTERS)).alias(f"distinct_{i}"))
        if isinstance(f.dataType, ORDERED):
            out += [F.min(col).alias(f"low_{i}"), F.max(col).alias(f"high_{i}")]
        if _number(f):
            value = col.cast("double")
            out += [
                F.avg(value).alias(f"mean_{i}"), (F.var_pop(value) * F.count(value)).alias(f"squares_{i}"),
                F.kll_sketch_agg_double(value, F.lit(QUANTILES)).alias(f"spread_{i}"),
            ]
    return df.agg(*out)


def unite(measures: DataFrame) -> DataFrame:
    """The measures of several loads as those of all their rows.

    Deviations are taken from the common mean, which a first aggregate over the few rows gives.
    """
    have = measures.columns
    means = [c[5:] for c in have if c.startswith("mean_")]
    known = lambda i: F.col(f"known_{i}")
    mean = lambda i: F.try_divide(F.sum(F.col(f"mean_{i}") * known(i)), F.sum(known(i)))
    centre = measures.agg(F.struct(F.lit(0).alias("none"), *[mean(i).alias(f"m{i}") for i in means]).alias("c")).scalar()
    out: list[Column] = []
    for c in have:
        kind, _, i = c.partition("_")
        col = F.col(c)
        if kind in ("rows", "known"):
            out.append(F.sum(col).alias(c))
        elif kind in ("low", "high"):
            out.append((F.min if kind == "low" else F.max)(col).alias(c))
        elif kind == "distinct":
            out.append(F.hll_union_agg(col).alias(c))
        elif kind == "spread":
            out.append(F.kll_merge_agg_double(col).alias(c))
        elif kind == "mean":
            out.append(mean(i).alias(c))
        elif kind == "squares":
            away = F.col(f"mean_{i}") - F.col("__centre")[f"m{i}"]
            out.append(F.sum(col + known(i) * away * away).alias(c))
    return measures.withColumn("__centre", centre).agg(*out)


def described(measures: DataFrame, schema: T.StructType, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A profile with one row for each column, from the united measures of its loads."""
    lines = []
    none = F.lit(None)
    for i, f in enumerate(schema.fields):
        known, ordered = F.col(f"known_{i}"), isinstance(f.dataType, ORDERED)
        missing = F.col("rows") - known
        ends = [F.col(f"{end}_{i}").cast("string") if ordered else none.cast("string") for end in ("low", "high")]
        at = [F.when(known > 0, F.kll_sketch_get_quantile_double(F.col(f"spread_{i}"), F.lit(q))) if _number(f) else none.cast("double") for q in quantiles]
        lines.append(F.struct(
            F.lit(f.name).alias("Column_Name"), F.lit(f.dataType.simpleString()).alias("Data_Type"), F.col("rows").alias("Total_Rows"),
            F.lit(len(schema)).alias("Total_Columns"),
            (none.cast("bigint") if isinstance(f.dataType, T.MapType) else F.hll_sketch_estimate(F.col(f"distinct_{i}"))).alias("Approx_Distinct_Values"),
            missing.alias("Null_Count"), F.round(F.try_divide(missing * 100.0, F.col("rows")), 4).alias("Null_Percent"),
            (F.round(F.col(f"mean_{i}"), 4) if _number(f) else none.cast("double")).alias("Mean"),
            (F.round(F.sqrt(F.when(known > 1, F.col(f"squares_{i}") / (known - 1))), 4) if _number(f) else none.cast("double")).alias("Std_Dev"),
            ends[0].alias("Min"), ends[1].alias("Max"), F.array(*at).alias("Quantiles"),
        ))
    return measures.select(F.inline(F.array(*lines)))


def add_load(store: TableStore, name: str, df: DataFrame, load: str) -> None:
    """Measure a load and keep its row in the table ``name``. A load measured again counts once, with its newest row."""
    store.append_rows(name, measure(df).withColumns({"load": F.lit(load), "measured_at": F.current_timestamp(), "layout": F.lit(df.schema.json())}))


def profile_of_loads(store: TableStore, name: str, loads: list[str] | None = None) -> DataFrame:
    """The profile of all measured loads, or of the given ones, without reading their rows."""
    kept = store.read(name)
    kept = kept if loads is None else kept.filter(F.col("load").isin(loads))
    newest = Window.partitionBy("load").orderBy(F.desc("measured_at"))
    kept = kept.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")
    layouts = [r[0] for r in kept.select("layout").distinct().limit(2).collect()]
    if len(layouts) != 1:
        raise SpecError(f"the loads of '{name}' have several layouts or none; profile them apart")
    return described(unite(kept.drop("load", "measured_at", "layout")), T.StructType.fromJson(json.loads(layouts[0])))
