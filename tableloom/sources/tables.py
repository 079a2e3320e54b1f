"""Incremental table reads by high-water mark or change feed, and JDBC."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tableloom.operators.merge import change_feed, initial_feed
from tableloom.session import settle
from tableloom.spec import SpecError, check_columns, choice, names

# Marks that mean "never read" and "read everything again".
FIRST_MARKS = {"datetime": "1900-01-01 00:00:00", "numeric": "-1"}
RELOAD_MARKS = {"datetime": "1900-01-01 14:44:44", "numeric": "-2"}
FEED_KINDS = ("insert", "update_postimage", "delete")


def after_mark(
    df: DataFrame, columns: str | list[str], kind: str = "datetime", mark: str | None = None
) -> DataFrame:
    """Rows whose mark column (any of several) lies beyond ``mark``; all rows at first.

    A plain comparison with a literal, so it is pushed into the scan.
    """
    cols = names(columns)
    check_columns(df, cols, "high-water mark")
    choice(kind, FIRST_MARKS, "mark type")
    if mark in (None, "", FIRST_MARKS[kind], RELOAD_MARKS[kind]):
        return df
    bound = F.lit(mark).cast("timestamp") if kind == "datetime" else F.lit(mark).cast("decimal(38,6)")
    if kind == "numeric" and str(mark).lstrip("+-").isdigit():
        bound = F.lit(int(mark))
    return df.filter(reduce(or_, [F.col(f"`{c}`") > bound for c in cols]))


def next_mark(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """The mark to keep, the greatest of the columns' maxima, as one row ``watermark_value``."""
    cols = names(columns)
    check_columns(df, cols, "high-water mark")
    tops = [F.max(F.col(f"`{c}`")) for c in cols]
    return df.agg((F.greatest(*tops) if len(tops) > 1 else tops[0]).cast("string").alias("watermark_value"))


def read_changes(
    current: DataFrame,
    previous: DataFrame | None,
    keys: list[str],
    version: int,
    at,
    from_version: int | None = None,
) -> tuple[DataFrame, int]:
    """Changes since the last read and the version to start from next.

    Without an earlier snapshot every row is an insert. When ``from_version``
    has not been reached yet, the result is empty with the right columns.
    """
    if previous is None:
        return initial_feed(current, version, at), version + 1
    if from_version is not None and from_version > version:
        return initial_feed(current.limit(0), version, at), from_version
    feed = change_feed(previous, current, keys, version, at)
    return feed.filter(F.col("_change_type").isin(*FEED_KINDS)), version + 1


#: Ranges in which a database counts the rows of one hot value.
BUCKETS = 4096


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 8,
    predicates: list[str] | None = None,
    properties: dict | None = None,
) -> DataFrame:
    """A database table read in parallel, by column stride or by predicates."""
    props = {**(properties or {}), **({"driver": driver} if driver else {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column:
        if bounds is None:
            raise SpecError("a partitioned database read needs the column's bounds")
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def date_predicates(column: str, edges: list[str], literal: str = "DATE '{}'") -> list[str]:
    """Half-open ranges over ascending ``edges`` that cover every row once, nulls included.

    ``literal`` is how the database writes a date.
    """
    at = [literal.format(e) for e in edges]
    ranges = [f"{column} < {at[0]} OR {column} IS NULL"]
    ranges += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return [*ranges, f"{column} >= {at[-1]}"]


def depth_predicates(
    spark: SparkSession, url: str, table: str, driver: str, column: str, parts: int = 8, within: str | None = None,
    literal: str = "DATE '{}'", bucket: str = "({column} - {low}) / {step}", properties: dict | None = None,
) -> list[str]:
    """Conditions that cut a database table into ``parts`` of nearly equally many rows, each row in one of them.

    The database counts its rows by value of ``column`` (dates or whole numbers) and only these counts travel; an equi-depth
    histogram of them gives the edges. A value with more than an eighth of a part, a hot day, is cut further by
    ranges of the whole-number column ``within``, counted by the database inside that value. So a part is at most a
    quarter larger or smaller than the mean, if ``within`` tells the rows of a hot value apart. ``literal`` is how the database
    writes a value, ``bucket`` how it divides whole numbers.
    """
    def counted(sql: str) -> DataFrame:
        return settle(read_jdbc(spark, url, f"({sql}) counted", driver, properties=properties).toDF("v", "n"), "histogram")

    values = counted(f"SELECT {column} AS v, COUNT(*) AS n FROM {table} GROUP BY {column}")
    total = values.agg(F.sum("n")).first()[0] or 0
    depth = max(1, -(-total // parts))
    fine = max(1, depth // 8)
    known = values.filter("v IS NOT NULL")
    hot = known.filter(F.col("n") > fine).orderBy("v").collect() if within else []
    pieces = [(lo, None, n) for lo, n in _runs(known, fine, [r["v"] for r in hot])]
    for v, n in hot:
        here = f"{column} = {literal.format(v)}"
        ends = read_jdbc(spark, url, f"(SELECT MIN({within}) AS lo, MAX({within}) AS hi, COUNT({within}) AS n FROM {table} WHERE {here}) ends", driver, properties=properties).first()
        pieces.append((v, (None,), n - ends[2]))
        if ends[2]:
            low, step = int(ends[0]), max(1, -(-(int(ends[1]) - int(ends[0]) + 1) // BUCKETS))
            b = bucket.format(column=within, low=low, step=step)
            inner = counted(f"SELECT b AS v, COUNT(*) AS n FROM (SELECT {b} AS b FROM {table} WHERE {here} AND {within} IS NOT NULL) x GROUP BY b")
            pieces += [(v, (low + int(first) * step,), m) for first, m in _runs(inner, fine)]
    pieces.sort(key=lambda p: (p[0], p[1] is not None and p[1] != (None,), p[1] if p[1] and p[1][0] is not None else ()))
    conditions = _conditions(pieces, column, within, literal)
    parted: dict[int, list[str]] = {}
    before = 0
    for (_, _, n), condition in zip(pieces, conditions):
        parted.setdefault(before // depth, []).append(condition)
        before += n
    if before < total or not parted:
        parted.setdefault(max(parted, default=0), []).append(f"{column} IS NULL")
    return [" OR ".join(f"({c})" for c in listed) for listed in parted.values()]


def _runs(counts: DataFrame, fine: int, hot: list | None = None) -> list[tuple]:
    """First value and rows of each run of neighbouring values with about ``fine`` rows; a run ends at a hot value.

    ``counts`` has one row for each value the database grouped by, so it fits a task where the table does not.
    """
    side = F.lit(0)
    for v in hot or []:
        side = side + F.when(F.col("v") > F.lit(v), 1).otherwise(0)
    cool = counts.filter(~F.col("v").isin(hot)) if hot else counts
    inside = Window.partitionBy("side").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranged = cool.withColumn("side", side).withColumn("before", F.sum("n").over(inside) - F.col("n"))
    cut = ranged.groupBy("side", F.floor(F.col("before") / fine).alias("run")).agg(F.min("v").alias("lo"), F.sum("n").alias("n"))
    return [(r["lo"], r["n"]) for r in cut.orderBy("lo").collect()]


def _conditions(pieces: list[tuple], column: str, within: str | None, literal: str) -> list[str]:
    """A condition for each piece in order. Ranges reach to the next piece, so that no value falls between two."""
    out = []
    for at, (v, sub, _) in enumerate(pieces):
        before, after = pieces[at - 1] if at else None, pieces[at + 1] if at + 1 < len(pieces) else None
        if sub is None:
            low = [] if before is None else [f"{column} {'>=' if before[1] is None else '>'} {literal.format(v if before[1] is None else before[0])}"]
            high = [] if after is None else [f"{column} < {literal.format(after[0])}"]
            out.append(" AND ".join([*low, *high]) or f"{column} IS NOT NULL")
            continue
        here = f"{column} = {literal.format(v)}"
        if sub == (None,):
            out.append(f"{here} AND {within} IS NULL")
            continue
        first = before is None or before[0] != v or before[1] == (None,)
        last = after is None or after[0] != v
        low = "" if first else f" AND {within} >= {sub[0]}"
        high = f" AND {within} IS NOT NULL" if last else f" AND {within} < {after[1][0]}"
        out.append(here + low + high)
    return out


def with_mark(query: str, mark: str) -> str:
    """Put the mark into an extraction query."""
    return query.replace("{WATERMARKVALUE}", mark)
