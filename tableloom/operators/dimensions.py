"""Surrogate keys, unknown members, key lookups and the date dimension."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableloom.operators.keys import any_null, broadcast_if_small, one_row_per_key, same_key
from tableloom.operators.numbering import cumulate, number_rows
from tableloom.operators.scd2 import ACTIVE
from tableloom.session import once
from tableloom.spec import SpecError, check_columns

UNKNOWN = -1


def assign_surrogate_keys(df: DataFrame, keys: list[str], column: str, existing: DataFrame | None = None) -> DataFrame:
    """Put an integer key first: reused for known members, numbered on for new ones.

    New members are numbered in key order above the largest key ever given
    (closed versions included), rows with a null key before the others. Numbering splits the key range, so no task
    sorts the whole table. A repeated non-null key fails the plan.
    """
    check_columns(df, keys, "create_surrogate_key")
    data = once(df.drop(column) if column in df.columns else df, "surrogates")
    existing = once(existing, "dimension") if existing is not None else None
    checked = one_row_per_key(data, keys, "surrogate key input", ignore_nulls=True)
    if existing is None:
        known, top, fresh = None, F.lit(0).cast("bigint"), checked
    else:
        live = existing.filter(F.col(ACTIVE) == 1) if ACTIVE in existing.columns else existing
        members = live.filter(F.col(f"`{column}`") != UNKNOWN).select(*keys, F.col(f"`{column}`").cast("bigint"))
        members = one_row_per_key(members, keys, "active dimension rows")
        found = checked.alias("l").join(members.alias("r"), same_key("l", "r", keys), "left")
        found = once(found.select(F.col(f"r.`{column}`"), "l.*"), "surrogates")
        known = found.filter(F.col(f"`{column}`").isNotNull())
        fresh = found.filter(F.col(f"`{column}`").isNull()).drop(column)
        top = F.coalesce(existing.agg(F.max(F.col(f"`{column}`").cast("bigint"))).scalar(), F.lit(0))
        top = F.greatest(top, F.lit(0))
    order = [(k, "asc") for k in keys]
    blank = fresh.filter(any_null(keys))
    numbered = number_rows(fresh.filter(~any_null(keys)), order, "__n")
    if not blank.isEmpty():
        before = blank.agg(F.count(F.lit(1))).scalar()
        numbered = numbered.withColumn("__n", F.col("__n") + before)
        numbered = _number_with_nulls(blank, keys, order).unionByName(numbered)
    made = numbered.select((F.col("__n") + top).cast("bigint").alias(column), *data.columns)
    return made if known is None else known.unionByName(made)


def _number_with_nulls(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Null keys may repeat; a row hash and the row itself make the order unique."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    rows = rows.withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    by = [*order, ("__tie", "asc"), *[(c, "asc") for c in rest]]
    upto = cumulate(rows, [], by, sums={"__last": "__copies"}, lead=len(order) + 1)
    copies = F.sequence(F.col("__last") - F.col("__copies") + 1, F.col("__last"))
    return upto.select(*df.columns, F.explode(copies).alias("__n"))


def unknown_member(schema: T.StructType, column: str, delete_column: str | None = None) -> dict:
    """Values of the ``-1`` row: typed stand-ins where a value is required, else null."""
    row = {}
    for f in schema.fields:
        if f.name == ACTIVE:
            row[f.name] = 1
        elif f.name == delete_column:
            row[f.name] = "0" if isinstance(f.dataType, T.StringType) else 0
        elif f.name == column:
            row[f.name] = UNKNOWN
        else:
            row[f.name] = None if f.nullable else _stand_in(f.dataType)
    return row


def _stand_in(dtype: T.DataType):
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return -1.0
    if isinstance(dtype, T.DecimalType):
        return Decimal(-1)
    if isinstance(dtype, T.IntegralType):
        return -1
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return datetime(1900, 1, 1)
    if isinstance(dtype, T.DateType):
        return date(1900, 1, 1)
    return "-1"


def append_unknown_member(df: DataFrame, column: str, delete_column: str | None = None) -> DataFrame:
    row = unknown_member(df.schema, column, delete_column)
    one = df.sparkSession.createDataFrame([tuple(row[c] for c in df.columns)], df.schema)
    return df.unionByName(one)


def attach_surrogate_key(
    facts: DataFrame,
    dimension: DataFrame,
    condition: str,
    key: str,
    output: str,
    join_columns: list[str],
    extra: list[str] | None = None,
    delete_column: str | None = None,
) -> DataFrame:
    """Look up the dimension key by ``condition`` over facts ``a`` and active members ``b``.

    Facts without a member get ``-1``. Active rows must be unique on ``join_columns``.
    """
    if output.lower() in {c.lower() for c in facts.columns}:
        raise SpecError(f"attach_dimension_surrogate_key: column '{output}' exists already")
    live = dimension.filter(F.col(ACTIVE) == 1) if ACTIVE in dimension.columns else dimension
    wanted = list(dict.fromkeys([key, *join_columns, *(extra or [])]))
    check_columns(live, wanted, "attach_dimension_surrogate_key")
    members = one_row_per_key(live.select(*wanted), join_columns, "dimension")
    joined = facts.alias("a").join(broadcast_if_small(members).alias("b"), F.expr(condition), "left")
    found = F.coalesce(F.col(f"b.`{key}`"), F.lit(UNKNOWN)).alias(output)
    return joined.select(found, "a.*", *[F.col(f"b.`{c}`") for c in extra or []])


def date_dimension(
    spark: SparkSession,
    start: str = "1950-01-01",
    end: str = "2050-12-31",
    key: str = "date_sk",
    padded_month: bool = True,
    unknown_row: bool = True,
) -> DataFrame:
    """One row per day with calendar attributes and descending sort columns."""
    day = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day")))
    return calendar(spark.range(1).select(day.alias("Date")), key, padded_month, unknown_row)


def calendar(days: DataFrame, key: str = "date_sk", padded_month: bool = True, unknown_row: bool = True) -> DataFrame:
    """Calendar attributes for a frame with one ``Date`` column of distinct days."""
    # Names and order of the calendar attributes.
    d = F.col("Date")
    number = F.date_format(d, "yyyyMMdd").cast("int")
    month: Column = F.year(d) * 100 + F.month(d) if padded_month else F.concat(F.year(d), F.month(d)).cast("int")
    out = days.select(
        number.alias(key),
        d,
        F.date_format(d, "yyyy-MM-dd").alias("Date_Text"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("Month_Name"),
        F.date_format(d, "MMM").alias("Month_Name_Abbrev"),
        F.dayofmonth(d).alias("Day"),
        F.date_format(d, "EEEE").alias("Day_Name"),
        F.dayofweek(d).alias("Day_Of_Week"),
        F.weekofyear(d).alias("Week_Of_Year"),
        F.dayofweek(d).isin(1, 7).alias("Is_Weekend"),
        F.concat_ws(", ", F.date_format(d, "MMM"), F.year(d).cast("string")).alias("Month_Year"),
        (-F.year(d)).alias("Sort_Year"),
        (-F.quarter(d)).alias("Sort_Quarter"),
        (-F.month(d)).alias("Sort_Month"),
        (-number).alias("Sort_Day"),
        (-F.dayofweek(d)).alias("Sort_Day_Of_Week"),
        (-F.weekofyear(d)).alias("Sort_Week_Of_Year"),
        (-month).alias("Sort_Year_Month"),
    )
    if not unknown_row:
        return out
    nothing = [F.lit(UNKNOWN).alias(key) if c == key else F.lit(None).cast(t).alias(c) for c, t in out.dtypes]
    return out.unionByName(days.sparkSession.range(1).select(*nothing))
