"""``add_window_function`` with groups of any size.

The group sizes are counted first (map-side combined, one small job). Without
an oversized group all functions of a step run in one Spark window over one
shuffle. Oversized groups are split off, and for them

* functions without order are aggregated per group and joined back;
* ordered functions aggregate ties, window ranges of the order columns
  separately (``numbering.cumulate``) and join the results back on
  (group, order value).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.operators.keys import mark_by_keys, same_key
from tableloom.operators.numbering import cumulate
from tableloom.operators.project import ordering
from tableloom.session import once
from tableloom.spec import SpecError, check_columns, choice, names

RANKS = ("row_number", "rank", "dense_rank")
VALUES = ("first_value", "last_value")
TOTALS = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}
FUNCTIONS = (*RANKS, *VALUES, *TOTALS)

HOT_ROWS = 10_000_000


@dataclass(frozen=True)
class WindowColumn:
    """One window function; the frame is Spark's default: the whole group
    without order, up to the current row's peers with it."""

    function: str
    output: str
    keys: list[str] = field(default_factory=list)
    order: list[tuple[str, str]] = field(default_factory=list)
    column: str | None = None

    @staticmethod
    def make(function, output, partition_by=None, order_by=None, directions="asc", column=None) -> WindowColumn:
        fn = choice(function, FUNCTIONS, "window function")
        by, dirs = names(order_by), [d.lower() for d in names(directions)] or ["asc"]
        dirs = dirs * len(by) if len(dirs) == 1 else dirs
        if len(dirs) != len(by) and by:
            raise SpecError("add_window_function: order_by and order_direction differ in length")
        if fn not in RANKS and not column:
            raise SpecError(f"add_window_function: 'column_name' must be given for {fn}")
        if fn in RANKS and not by:
            raise SpecError(f"add_window_function: 'order_by' must be given for {fn}")
        ordering(by, dirs, "asc")
        return WindowColumn(fn, output, names(partition_by), list(zip(by, dirs)), column)

    def sorts(self) -> list[Column]:
        return ordering([c for c, _ in self.order], [d for _, d in self.order], "asc")

    def reads(self) -> list[str]:
        return [*self.keys, *[c for c, _ in self.order], *([self.column] if self.column else [])]

    def plain(self) -> Column:
        spec = Window.partitionBy(*self.keys)
        return _plain(self.function, self.column).over(spec.orderBy(*self.sorts()) if self.order else spec)


def hot_limit(df: DataFrame) -> int:
    """Rows above which a group is split; ``spark.tableloom.window.hotRows`` overrides."""
    return int(df.sparkSession.conf.get("spark.tableloom.window.hotRows", str(HOT_ROWS)))


def add_window(
    df: DataFrame, function: str, output: str, partition_by=None, order_by=None, directions="asc",
    column: str | None = None, hot_rows: int | None = None, ranges: int | None = None,
) -> DataFrame:
    """Add one window column."""
    made = WindowColumn.make(function, output, partition_by, order_by, directions, column)
    return add_windows(df, [made], hot_rows, ranges)


def add_windows(df: DataFrame, columns: list[WindowColumn], hot_rows: int | None = None, ranges: int | None = None) -> DataFrame:
    """Add window columns that share their partitioning keys and do not read each other."""
    keys = columns[0].keys
    for w in columns:
        check_columns(df, w.reads(), "add_window_function")
        if w.keys != keys:
            raise SpecError("window columns added together need the same partition_by")
    df = once(df, "windows")
    if not keys:
        return _oversized(df, columns, ranges)
    limit = hot_limit(df) if hot_rows is None else hot_rows
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(*keys)
    if hot.isEmpty():
        return df.withColumns({w.output: w.plain() for w in columns})
    hot = once(hot, "hot")
    ordinary = df.alias("l").join(hot.alias("r"), same_key("l", "r", keys), "left_anti")
    split = df.alias("l").join(hot.alias("r"), same_key("l", "r", keys), "left_semi")
    small = ordinary.withColumns({w.output: w.plain() for w in columns})
    return small.unionByName(_oversized(split, columns, ranges).select(*small.columns))


def _oversized(df: DataFrame, columns: list[WindowColumn], ranges: int | None) -> DataFrame:
    """All functions over groups too large for one task, one after the other."""
    unordered = [w for w in columns if not w.order]
    if unordered:
        df = _unordered(once(df, "split"), unordered)
    for w in columns:
        if w.order and w.function == "first_value":
            df = _first(once(df, "split"), w)
        elif w.order:
            df = _split(once(df, "split"), w.function, w.output, w.keys, w.order, w.column, ranges)
        # sums of sums are wider than a plain window's sum; a column keeps its type however large a group grows
        plain = df.select(w.plain().alias("x")).schema["x"].dataType
        if w.keys and df.schema[w.output].dataType != plain:
            df = df.withColumn(w.output, F.col(f"`{w.output}`").cast(plain))
    return df


def _plain(fn: str, column: str | None) -> Column:
    if fn in RANKS:
        return getattr(F, fn)()
    return {"first_value": F.first, "last_value": F.last, **TOTALS}[fn](F.col(f"`{column}`"))


def _unordered(df: DataFrame, columns: list[WindowColumn]) -> DataFrame:
    """One aggregate for all functions, joined back on the keys."""
    keys = columns[0].keys
    outputs = [w.output for w in columns]
    made = [_plain(w.function, w.column).alias(w.output) for w in columns]
    kept = df.drop(*outputs)
    if not keys:
        totals = df.agg(*made).select(F.struct("*")).scalar()
        return kept.withColumn("__t", totals).select("*", *[F.col(f"__t.`{o}`") for o in outputs]).drop("__t")
    return mark_by_keys(kept, keys, df.groupBy(*keys).agg(*made))


def _first(df: DataFrame, w: WindowColumn) -> DataFrame:
    """The first row per group by ``row_number() = 1`` (limited map-side), joined back."""
    value = F.col(f"`{w.column}`").alias(w.output)
    kept = df.drop(w.output)
    if not w.keys:
        return kept.withColumn(w.output, df.orderBy(*w.sorts()).limit(1).select(value).scalar())
    spec = Window.partitionBy(*w.keys).orderBy(*w.sorts())
    first = df.withColumn("__rn", F.row_number().over(spec)).filter("__rn = 1")
    return mark_by_keys(kept, w.keys, first.select(*w.keys, value))


def _split(df: DataFrame, fn: str, output: str, keys: list[str], order: list, column: str | None, ranges: int | None) -> DataFrame:
    by = [c for c, _ in order]
    one = F.lit(1).cast("long")
    if fn == "row_number":
        # Equal rows are interchangeable: count them, number the counts, expand again.
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__tie", tie)
        extra = [(c, "asc") for c in ["__tie", *df.columns] if c not in by]
        last = cumulate(
            rows, keys, [*order, *extra], sums={"__last": "__copies"}, ranges=ranges, lead=len(order) + 1
        )
        kind = "int" if keys else "bigint"  # a whole table may have more rows than an int counts
        numbers = F.sequence((F.col("__last") - F.col("__copies") + 1).cast(kind), F.col("__last").cast(kind))
        return last.select(*df.columns, F.explode(numbers).alias(output))
    group = list(dict.fromkeys([*keys, *by]))
    base = df.groupBy(*group)
    value = F.col(f"`{column}`") if column else None
    if fn in ("rank", "dense_rank"):
        peers = base.agg(F.count(F.lit(1)).alias("__n")).withColumn("__one", one)
        totals = cumulate(peers, keys, order, sums={"__upto": "__n", "__dense": "__one"}, ranges=ranges)
        result = F.col("__upto") - F.col("__n") + 1 if fn == "rank" else F.col("__dense")
        facts = totals.select(*group, result.cast("int" if keys else "bigint").alias(output))
    elif fn == "last_value":
        facts = base.agg(F.last(value).alias(output))
    elif fn in ("min", "max"):
        peers = base.agg(TOTALS[fn](value).alias("__v"))
        which = {"lows" if fn == "min" else "highs": {"__r": "__v"}}
        facts = cumulate(peers, keys, order, ranges=ranges, **which).select(*group, F.col("__r").alias(output))
    else:
        peers = base.agg(F.sum(value).alias("__v"), F.count(value).alias("__n")) if fn != "count" else base.agg(
            F.count(value).alias("__n")
        )
        sums = {"__c": "__n"} if fn == "count" else {"__s": "__v", "__c": "__n"}
        totals = cumulate(peers, keys, order, sums=sums, ranges=ranges)
        result = {"count": F.col("__c"), "sum": F.col("__s") if fn == "sum" else None}.get(fn)
        if fn == "avg":
            result = F.try_divide(F.col("__s"), F.col("__c"))
        facts = totals.select(*group, result.alias(output))
    return mark_by_keys(df.drop(output) if output in df.columns else df, group, facts)
