"""``join_data``: free SQL condition over aliases ``a`` and ``b``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators.keys import BROADCAST_LIMIT, broadcast_if_small, estimated_bytes
from tableloom.operators.ranges import range_join, read_condition
from tableloom.spec import SpecError, check_columns, choice, names

# Accepted join types and the Spark join each one means.
JOIN_TYPES = {
    "inner": "inner", "left": "left", "left_outer": "left", "outer": "full_outer", "full_outer": "full_outer",
    "semi": "left_semi", "left_semi": "left_semi", "anti": "left_anti", "left_anti": "left_anti",
}


def join_data(
    a: DataFrame,
    b: DataFrame,
    condition: str,
    how: str = "inner",
    left_columns: str = "*",
    right_columns: str = "*",
    broadcast: bool = False,
) -> DataFrame:
    """Join on ``condition`` and select columns from both sides.

    A broadcast wish is honoured only if the right side's estimated size is
    small enough; otherwise both sides are shuffled and AQE splits hot keys. A condition
    without an equality between the sides is joined by bins of the range it says. If it says none, one
    side has to be small enough to be broadcast, because every row would meet every row.
    """
    kind = JOIN_TYPES[choice(how, JOIN_TYPES, "join_type")]
    if not condition.strip():
        raise SpecError("join_data: 'join_condition' must be given")
    left = a.columns if left_columns.strip() == "*" else names(left_columns)
    right = b.columns if right_columns.strip() == "*" else names(right_columns)
    check_columns(a, left, "join_data left_columns")
    reading = read_condition(a.sparkSession, condition)
    if reading.equality:
        joined = a.alias("a").join((broadcast_if_small(b) if broadcast else b).alias("b"), F.expr(condition), kind)
    elif interval := reading.interval():
        joined = range_join(a, b, condition, kind, interval)
    elif kind != "full_outer" and estimated_bytes(b) <= BROADCAST_LIMIT:
        joined = a.alias("a").join(F.broadcast(b).alias("b"), F.expr(condition), kind)
    else:
        raise SpecError(f"join_data: '{condition}' has neither an equality nor a range between a and b, and b is too large to be sent to every task")
    if kind in ("left_semi", "left_anti"):
        return joined.select(*[F.col(f"a.`{c}`") for c in left])
    check_columns(b, right, "join_data right_columns")
    if clash := {c.lower() for c in left} & {c.lower() for c in right}:
        raise SpecError(f"join_data: columns on both sides, list what to keep: {', '.join(sorted(clash))}")
    return joined.select(*[F.col(f"a.`{c}`") for c in left], *[F.col(f"b.`{c}`") for c in right])
