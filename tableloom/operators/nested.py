"""Arrays, structs and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableloom.spec import SpecError, check_columns, type_of


def explode_array(df: DataFrame, column: str, output: str | None = None, keep_nulls: bool = False) -> DataFrame:
    """One row per element; ``keep_nulls`` keeps rows whose array is null or empty."""
    check_columns(df, [column], "explode_array")
    fn = F.explode_outer if keep_nulls else F.explode
    exploded = df.withColumn(output or column, fn(F.col(f"`{column}`")))
    return exploded.drop(column) if output and output != column else exploded


def flatten_struct(
    df: DataFrame, column: str, prefix: str | None = None, fields: list[str] | None = None, drop_original: bool = True
) -> DataFrame:
    """Struct fields become columns named ``prefix`` + field."""
    check_columns(df, [column], "flatten_struct")
    dtype = type_of(df, column)
    if not isinstance(dtype, T.StructType):
        raise SpecError(f"flatten_struct: '{column}' is {dtype.simpleString()}, not a struct")
    prefix = f"{column}_" if prefix is None else prefix
    wanted = [f.name for f in dtype.fields if not fields or f.name in fields]
    out = df.withColumns({f"{prefix}{name}": F.col(f"`{column}`.`{name}`") for name in wanted})
    return out.drop(column) if drop_original else out


def attributes_to_json(df: DataFrame, keys: list[str], name: str, value: str, fixed: dict[str, Column]) -> DataFrame:
    """Assemble name/value rows into one JSON object per key group.

    Names and values are collected as one array of structs so they stay aligned.
    A repeated attribute keeps the last value (``mapKeyDedupPolicy=LAST_WIN``).
    A group holds one configured step, so its size is bounded by that step's attributes.
    """
    head = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fixed.items()])
    pairs = F.sort_array(F.collect_list(F.struct(F.col(name).alias("key"), F.col(value).alias("value"))))
    merged = F.map_from_entries(F.concat(head, F.col("pairs")) if fixed else F.col("pairs"))
    return df.groupBy(*keys).agg(pairs.alias("pairs")).select(*keys, F.to_json(merged).alias("step_json"))


def rows_from_json(df: DataFrame, column: str, element_ddl: str) -> DataFrame:
    """A JSON array column to one row per element with typed fields."""
    parsed = F.from_json(F.col(f"`{column}`"), f"array<struct<{element_ddl}>>")
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.inline(parsed))
