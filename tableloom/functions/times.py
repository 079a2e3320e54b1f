"""Date and time operations of the ``transform_datetime`` step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.spec import check_columns, choice, text

PARTS = {
    "year": F.year, "month": F.month, "day": F.dayofmonth, "dayofmonth": F.dayofmonth, "dayofweek": F.dayofweek,
    "dayofyear": F.dayofyear, "hour": F.hour, "minute": F.minute, "second": F.second, "quarter": F.quarter,
    "weekofyear": F.weekofyear,
}
NOW = {"current_date": F.current_date, "current_timestamp": F.current_timestamp}
OTHERS = ("add_days", "subtract_days", "add_months", "date_diff", "format_date", "to_timestamp")


def transform_datetime(df: DataFrame, step: dict) -> DataFrame:
    operation = choice(text(step, "operation"), [*PARTS, *NOW, *OTHERS], "operation")
    output = text(step, "output_column_name").strip()
    if operation in NOW:
        return df.withColumn(output, NOW[operation]())
    column = text(step, "column_name").strip()
    check_columns(df, [column], "transform_datetime")
    return df.withColumn(output, _value(df, F.col(f"`{column}`"), operation, step))


def _value(df: DataFrame, col: Column, operation: str, step: dict) -> Column:
    if operation in PARTS:
        return PARTS[operation](col)
    if operation == "add_days":
        return F.date_add(col, int(text(step, "days")))
    if operation == "subtract_days":
        return F.date_sub(col, int(text(step, "days")))
    if operation == "add_months":
        return F.add_months(col, int(text(step, "months")))
    if operation == "date_diff":
        end = text(step, "end_date_column").strip()
        check_columns(df, [end], "transform_datetime")
        return F.datediff(F.col(f"`{end}`"), col)
    if operation == "format_date":
        return F.date_format(col, text(step, "date_format"))
    fmt = step.get("timestamp_format")
    return F.to_timestamp(col, fmt) if fmt else F.to_timestamp(col)
