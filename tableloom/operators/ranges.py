"""Joins on ranges alone: bins of matching width instead of comparing every row with every row.

A condition such as ``a.t >= b.start AND a.t < b.stop`` says that two intervals meet (a point is an interval without
length). Each interval has a level, the power of four next above its length, and covers at most two bins of that
level's width. Two intervals can only meet in a bin of the longer one's level. So each row stands in its bins at its own
level and at the higher levels that occur, the bins are joined by equality, a pair is taken in its first common
bin, and the whole condition decides at the end. Rows multiply by twice the number of levels at most, whatever
the lengths are, and the pairs looked at are within a constant factor of intervals that really lie side by side.
Where one side has points only, which stand in one bin of each level, bins are ``FINE`` times narrower: an interval stands in a few more
of them, and few points beside it are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableloom.operators.numbering import range_count
from tableloom.session import settle
from tableloom.spec import SpecError

#: The level of intervals without a finite end; they meet everything in one bin.
ENDLESS = 2048
#: Levels are so many powers of two apart.
STEP = 2
#: So many bins in a level's width where one side has no length.
FINE = 8
# Comparisons by name, with the place of the lesser side.
_LESSER = {"LessThan": 0, "LessThanOrEqual": 0, "GreaterThan": 1, "GreaterThanOrEqual": 1}
_EQUAL = ("EqualTo", "EqualNullSafe")


@dataclass(frozen=True)
class Order:
    """One side's expression is at most the other's; ``unless_null`` names a side whose null means no bound."""

    lesser: tuple[str, str]  # side, SQL
    greater: tuple[str, str]
    unless_null: str | None = None


@dataclass(frozen=True)
class Reading:
    """What a join condition says: whether it has an equality between the sides, and its orders."""

    equality: bool
    orders: list[Order]

    def interval(self) -> tuple[Order, Order] | None:
        """Two orders of opposite direction, those with a common expression first; None if there are none."""
        up = [o for o in self.orders if o.lesser[0] == "a"]
        down = [o for o in self.orders if o.lesser[0] == "b"]
        both = [(x, y) for x in up for y in down]
        # x: a.lo <= b.hi, y: b.lo <= a.hi
        return min(both, key=lambda p: (p[0].lesser != p[1].greater) and (p[0].greater != p[1].lesser), default=None)


def _children(node) -> list:
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _sides(node) -> set[str]:
    """The aliases an expression refers to; a name without alias counts as both."""
    if _name(node) == "UnresolvedAttribute":
        parts = node.nameParts()
        first = parts.apply(0).lower()
        return {first} if parts.size() > 1 and first in ("a", "b") else {"a", "b"}
    return set().union(*[_sides(c) for c in _children(node)])


def _parts(node) -> list:
    """The conjuncts of a condition; BETWEEN is two of them."""
    if _name(node) == "And":
        return [p for c in _children(node) for p in _parts(c)]
    return [node]


def _order(node) -> list[Order]:
    kind, kids = _name(node), _children(node)
    if kind in _LESSER:
        low = kids[_LESSER[kind]]
        high = kids[1 - _LESSER[kind]]
        sides = _sides(low), _sides(high)
        if sides in (({"a"}, {"b"}), ({"b"}, {"a"})):
            return [Order((min(sides[0]), low.sql()), (min(sides[1]), high.sql()))]
    if kind == "Between" or kind == "UnresolvedFunction" and node.nameParts().mkString(".").lower() == "between":
        value, low, high = kids[:3]
        out = []
        for lesser, greater in ((low, value), (value, high)):
            sides = _sides(lesser), _sides(greater)
            if sides in (({"a"}, {"b"}), ({"b"}, {"a"})):
                out.append(Order((min(sides[0]), lesser.sql()), (min(sides[1]), greater.sql())))
        return out
    if kind == "Or":
        for null, other in (kids, kids[::-1]):
            if _name(null) == "IsNull" and len(found := _order(other)) == 1:
                free = _children(null)[0].sql()
                for side in (found[0].lesser, found[0].greater):
                    if side[1] == free:
                        return [Order(found[0].lesser, found[0].greater, side[0])]
    return []


def read_condition(spark: SparkSession, condition: str) -> Reading:
    """What ``condition`` over the aliases ``a`` and ``b`` says; Spark's own parser reads it."""
    parts = _parts(spark._jsparkSession.sessionState().sqlParser().parseExpression(condition))
    equal = any(
        _name(p) in _EQUAL and tuple(map(frozenset, map(_sides, _children(p)))) in ((frozenset("a"), frozenset("b")), (frozenset("b"), frozenset("a")))
        for p in parts
    )
    return Reading(equal, [o for p in parts for o in _order(p)])


def _number(df: DataFrame, sql: str, open_end: float | None) -> Column:
    """An end of an interval as a double; conversion keeps the order, so bins lose nothing."""
    value = F.expr(sql)
    kind = df.select(value.alias("x")).schema["x"].dataType
    if isinstance(kind, T.TimestampNTZType):
        value = value.cast("timestamp")
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        raise SpecError(f"join_data: '{sql}' has no range of numbers or times")
    value = value.cast("double")
    return value if open_end is None else F.coalesce(value, F.lit(open_end))


def _laid(df: DataFrame, side: str, low: Column, high: Column) -> DataFrame:
    """``df`` with the ends of its interval in order and its level; rows without an interval meet nothing and go."""
    ends = df.select(side, "uid", low.alias("x"), high.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    laid = ends.select(side, "uid", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
    length = F.col("hi") - F.col("lo")
    finite = (F.abs("lo") < float("inf")) & (F.abs("hi") < float("inf")) & (length < float("inf"))
    level = (F.ceil(F.log2(F.when(length > 0, length)) / STEP) * STEP).cast("int")
    return laid.withColumn("level", F.when(~finite, F.lit(ENDLESS)).otherwise(level))


def _spread(laid: DataFrame, levels: list[int], parts: int, at_home: bool = False) -> DataFrame:
    """Each row in its bins at its level and, unless ``at_home``, the higher ones that occur, ``parts`` bins in a level's width."""
    own = F.coalesce("level", F.lit(levels[0]))
    higher = F.col("own") if at_home else F.explode(F.filter(F.array(*map(F.lit, levels)), lambda x: x >= F.col("own")))
    at = laid.withColumn("own", own).withColumn("at", higher)
    width = F.pow(F.lit(2.0), F.col("at")) / parts
    place = lambda c: F.when(F.col("at") == ENDLESS, F.lit(0.0)).otherwise(F.floor(F.col(c) / width).cast("double"))
    binned = at.withColumns({"first": place("lo"), "last": place("hi")})
    # so few bins at most that they are named by their distance from both ends; doubles of one size may lie further apart than a bin is wide
    bins = F.array_distinct(F.array("first", *[F.least(F.col("first") + n, F.col("last")) for n in range(1, parts)], "last"))
    return binned.withColumn("bin", F.explode(bins))


def range_join(a: DataFrame, b: DataFrame, condition: str, kind: str, orders: tuple[Order, Order]) -> DataFrame:
    """Rows of ``a`` and ``b`` as structs of these names, joined on ``condition``; ``orders`` is the interval read from it."""
    spark = a.sparkSession
    up, down = orders

    def keyed(df: DataFrame, side: str) -> DataFrame:
        # a row may meet thousands, so bytes do not tell the work: neighbours of few files would share a task
        spread = df.select(F.struct("*").alias(side)).repartition(range_count(df))
        return settle(spread.withColumn("uid", F.monotonically_increasing_id()), "ranged")

    a, b = keyed(a, "a"), keyed(b, "b")
    ends = lambda order, side, sign: sign * float("inf") if order.unless_null == side else None
    left = _laid(a, "a", _number(a, up.lesser[1], ends(up, "a", -1)), _number(a, down.greater[1], ends(down, "a", 1)))
    right = _laid(b, "b", _number(b, down.lesser[1], ends(down, "b", -1)), _number(b, up.greater[1], ends(up, "b", 1)))
    found = left.select("level", F.lit("a").alias("side")).union(right.select("level", F.lit("b"))).distinct().collect()
    levels = sorted({r[0] for r in found if r[0] is not None}) or [0]
    long = {r[1] for r in found if r[0] is not None}
    # points have the lowest level and one bin in each, so intervals meet them at their own level only, and once
    points = long != {"a", "b"}
    parts = FINE if points else 1
    l = _spread(left, levels, parts, points and "a" in long).withColumnsRenamed({"uid": "ua"})  # noqa: E741
    r = _spread(right, levels, parts, points and "b" in long).withColumnsRenamed({"uid": "ub", "own": "other", "first": "begin"})
    once = F.lit(True) if points else (F.col("at") == F.greatest("own", "other")) & (F.col("bin") == F.greatest("first", "begin"))
    pairs = l.select("a", "ua", "own", "at", "bin", "first").join(r.select("b", "ub", "other", "at", "bin", "begin"), ["at", "bin"])
    pairs = pairs.filter(once & F.expr(condition)).select("a", "b", "ua", "ub")
    if kind == "inner":
        return pairs.select("a", "b")
    none = lambda df, side: F.lit(None).cast(df.schema[side].dataType).alias(side)
    if kind in ("left_semi", "left_anti"):
        return a.join(pairs.select(F.col("ua").alias("uid")).distinct(), "uid", kind).select("a")
    pairs = settle(pairs, "pairs")
    alone = a.join(pairs.select(F.col("ua").alias("uid")).distinct(), "uid", "left_anti")
    out = pairs.select("a", "b").unionByName(alone.select("a", none(b, "b")))
    if kind == "full_outer":
        other = b.join(pairs.select(F.col("ub").alias("uid")).distinct(), "uid", "left_anti")
        out = out.unionByName(other.select(none(a, "a"), "b"))
    return out
