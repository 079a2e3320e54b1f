"""Null and value replacement with literals converted to each column's type."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableloom.spec import SpecError, check_columns, choice, flag, names, text, type_of

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def literal_for(value: str, dtype: T.DataType, what: str) -> Column:
    """``value`` as a literal of ``dtype``, checked when the plan is built."""
    try:
        if isinstance(dtype, T.StringType):
            return F.lit(value)
        if isinstance(dtype, INTEGERS):
            return F.lit(int(value)).cast(dtype)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.lit(float(value)).cast(dtype)
        if isinstance(dtype, T.DecimalType):
            return F.lit(Decimal(value)).cast(dtype)
        if isinstance(dtype, T.BooleanType):
            return F.lit({"true": True, "false": False}[value.lower()])
        if isinstance(dtype, T.DateType):
            return F.lit(date.fromisoformat(value))
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return F.lit(datetime.fromisoformat(value)).cast(dtype)
    except (ValueError, KeyError, ArithmeticError) as err:
        raise SpecError(f"{what}: '{value}' is not a {dtype.simpleString()}") from err
    raise SpecError(f"{what}: type {dtype.simpleString()} is not supported")


def drop_null_rows(df: DataFrame, columns: list[str], logic: str = "any") -> DataFrame:
    check_columns(df, columns, "drop_rows")
    return df.dropna(how=choice(logic, ("any", "all"), "logic"), subset=columns)


def fill_nulls(df: DataFrame, columns: list[str], default: str) -> DataFrame:
    check_columns(df, columns, "replace_with_default")
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`"), literal_for(default, type_of(df, c), "replace_with_default")) for c in columns}
    )


def nullify_values(df: DataFrame, columns: list[str], values: list[str], empty_too: bool = False) -> DataFrame:
    """Listed values become null; text is compared after trimming."""
    check_columns(df, columns, "convert_values_to_null")
    if not values and not empty_too:
        raise SpecError("convert_values_to_null: give values_to_convert or convert_empty_space")
    out = {}
    for c in columns:
        col, dtype = F.col(f"`{c}`"), type_of(df, c)
        is_text = isinstance(dtype, T.StringType)
        wanted = [literal_for(v, dtype, "convert_values_to_null") for v in values]
        wanted += [F.lit("")] if empty_too and is_text else []
        if wanted:
            out[c] = F.when((F.trim(col) if is_text else col).isin(*wanted), F.lit(None)).otherwise(col)
    return df.withColumns(out) if out else df


def replace_values(df: DataFrame, columns: list[str], values: list[str], replacement: str) -> DataFrame:
    """Listed values become ``replacement``, both typed like the column."""
    check_columns(df, columns, "replace_values")
    if not values:
        raise SpecError("replace_values: 'values_to_replace' must be given")
    out = {}
    for c in columns:
        col, dtype = F.col(f"`{c}`"), type_of(df, c)
        wanted = [literal_for(v, dtype, "replace_values") for v in values]
        out[c] = F.when(col.isin(*wanted), literal_for(replacement, dtype, "replace_values")).otherwise(col)
    return df.withColumns(out)


def handle_nulls(df: DataFrame, step: dict) -> DataFrame:
    """The ``apply_null_handling`` step: dispatch on its action."""
    action = choice(text(step, "action"), ("drop_rows", "replace_with_default", "convert_values_to_null"), "action")
    columns = names(text(step, "column_name"))
    if action == "drop_rows":
        return drop_null_rows(df, columns, text(step, "logic", "any"))
    if action == "replace_with_default":
        return fill_nulls(df, columns, text(step, "default_value").strip())
    values = names(step.get("values_to_convert"), step.get("values_delimiter", ","))
    return nullify_values(df, columns, values, flag(step.get("convert_empty_space")))
