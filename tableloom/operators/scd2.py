"""Type-2 history as one plan over target and batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.operators.keys import broadcast_if_small, one_row_per_key, same_key
from tableloom.operators.merge import DeleteFlag
from tableloom.session import once
from tableloom.spec import is_metadata, type_of

START, END, ACTIVE = "scd_start_date", "scd_end_date", "scd_active"
BEGINNING = "1900-01-01 00:00:00"


def add_history_columns(df: DataFrame, ts: str, delete: DeleteFlag | None = None) -> DataFrame:
    """History columns of a first load; rows already deleted start out closed."""
    at = F.col(f"`{ts}`").cast("timestamp")
    gone = delete.holds(F.col(f"`{delete.column}`")) if delete else F.lit(False)
    return df.withColumns(
        {START: at, END: F.when(gone, at).cast("timestamp"), ACTIVE: F.when(gone, F.lit(0)).otherwise(F.lit(1))}
    )


def compared_columns(
    columns: list[str], keys: list[str], excluded: list[str | None], delete: DeleteFlag | None
) -> list[str]:
    """Columns whose change makes a new version: no keys, clocks or bookkeeping (but the delete flag)."""
    skip = {c for c in [*keys, *excluded] if c}
    flag = delete.column.lower() if delete else None
    return [c for c in columns if c not in skip and (not is_metadata(c) or c.lower() == flag)]


def merge_history(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    ts: str,
    delete: DeleteFlag | None = None,
    surrogate: str | None = None,
    mark_columns: list[str] | None = None,
) -> DataFrame:
    """Target after the batch.

    Versions that are closed already pass through. The active version of each
    key is joined with the batch once; every joined pair expands into the rows
    it becomes: unchanged; closed plus new version; closed by deletion (which
    also takes the batch's values); new key; never-seen key that arrives deleted.
    """
    source = one_row_per_key(once(source, "batch"), keys, "history source")
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    types = {c: type_of(target if c in target.columns else source, c) for c in columns}
    given = set(source.columns)
    watched = compared_columns(
        [c for c in source.columns if c in target.columns], keys, [surrogate, ts, *(mark_columns or [])], delete
    )
    active = target.filter(F.col(ACTIVE) == 1).withColumn("__t", F.lit(True))
    both = active.alias("t").join(
        source.withColumn("__s", F.lit(True)).alias("s"), same_key("t", "s", keys), "full_outer"
    )
    in_t, in_s = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    differs = F.lit(False)
    for c in watched:
        differs = differs | ~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    gone = delete.holds(F.col(f"s.`{delete.column}`")) if delete else F.lit(False)
    at = F.col(f"s.`{ts}`").cast("timestamp")

    def old(c: str) -> Column:
        return F.col(f"t.`{c}`") if c in target.columns else F.lit(None).cast(types[c])

    def new(c: str) -> Column:
        return F.col(f"s.`{c}`") if c in given else F.lit(None).cast(types[c])

    def version(pick, start: Column, end: Column, live: int | Column) -> Column:
        special = {START: start, END: end, ACTIVE: F.lit(live) if isinstance(live, int) else live}
        fields = [(special[c] if c in special else pick(c)).cast(types[c]).alias(c) for c in columns]
        return F.struct(*fields)

    none = F.lit(None).cast("timestamp")
    started = F.col(f"t.`{START}`")
    keep = version(old, started, F.col(f"t.`{END}`"), F.col(f"t.`{ACTIVE}`"))
    closed = version(old, started, at, 0)
    opened = version(new, at, none, 1)
    taken = version(lambda c: new(c) if c in given else old(c), started, at, 0)
    stillborn = version(new, at, at, 0)
    rows = (
        F.when(in_t & in_s & gone, F.array(taken))
        .when(in_t & (~in_s | ~differs), F.array(keep))
        .when(in_t, F.array(closed, opened))
        .when(gone, F.array(stillborn))
        .otherwise(F.array(opened))
    )
    past = target.filter(F.coalesce(F.col(ACTIVE) != 1, F.lit(True)))
    past = past.select(*[F.col(f"`{c}`") if c in past.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])
    return past.unionByName(both.select(F.inline(rows)))


def backdate_single_versions(target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with one version are taken to have always been so."""
    lone = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")
    joined = target.alias("t").join(lone.withColumn("__lone", F.lit(True)).alias("s"), same_key("t", "s", keys), "left")
    start = F.when(F.col("s.__lone"), F.lit(BEGINNING).cast("timestamp")).otherwise(F.col(f"t.`{START}`"))
    return joined.select(*[(start if c == START else F.col(f"t.`{c}`")).alias(c) for c in target.columns])


def as_of(facts: DataFrame, history: DataFrame, keys: list[tuple[str, str]], at: str, columns: list[str]) -> DataFrame:
    """Left-join each fact to the version in force at ``at``."""
    cond = (F.col(f"a.`{at}`") >= F.col(f"b.`{START}`")) & (
        (F.col(f"a.`{at}`") < F.col(f"b.`{END}`")) | F.col(f"b.`{END}`").isNull()
    )
    for left, right in keys:
        cond = cond & (F.col(f"a.`{left}`") == F.col(f"b.`{right}`"))
    joined = facts.alias("a").join(broadcast_if_small(history).alias("b"), cond, "left")
    return joined.select("a.*", *[F.col(f"b.`{c}`") for c in columns])
