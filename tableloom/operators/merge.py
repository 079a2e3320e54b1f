"""Merging a batch into a target as a pure function of two frames.

Plain files have no row-level update, so a merge returns the target's next
state. Two equivalent plans are used:

* a small batch (by Catalyst's size estimate) is broadcast and streamed against
  the target, which is then neither shuffled nor sorted; the rows to insert come
  from a second, key-only pass over the target;
* otherwise one full outer join on the keys.

Keys compare null-safely. A key that occurs twice in the batch fails the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableloom.operators.keys import BROADCAST_LIMIT, estimated_bytes, mark_by_keys, one_row_per_key, same_key
from tableloom.session import once
from tableloom.spec import CHANGE_COLUMNS, CREATED, SpecError, check_columns, choice, type_of

MERGE_TYPES = (
    "append", "overwrite", "merge", "merge_and_delete", "merge_mark_unmatched_deleted", "merge_mark_all_deleted",
    "replace_where", "scd2",
)


@dataclass(frozen=True)
class DeleteFlag:
    """Column and value by which a source says that a row is gone."""

    column: str
    value: str

    def literal(self) -> Column:
        """Digits compare as a number, anything else as text."""
        return F.lit(int(self.value)) if self.value.isdigit() else F.lit(self.value)

    def holds(self, column: Column) -> Column:
        """True for flagged rows; a null flag is not flagged."""
        return F.coalesce(column == self.literal(), F.lit(False))


def _aligned(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the union of their columns; missing ones are null."""
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    def widen(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(type_of(other, c)).alias(c) for c in columns]
        )
    return widen(target, source), widen(source, target), columns


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    delete: DeleteFlag | None = None,
    unmatched: Callable[[str], Column] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Next state of ``target``: matched rows updated, new rows inserted.

    Matched rows keep their keys and creation time. With ``delete``, matched
    rows flagged in the source disappear, while unmatched source rows are
    inserted even if flagged. ``unmatched`` gives new column values for target
    rows the source does not have.
    """
    given = source.columns
    source = once(source, "batch")
    source = one_row_per_key(source.drop(*CHANGE_COLUMNS) if delete is None else source, keys, "merge source")
    gone = None
    if delete is not None:
        check_columns(source, [delete.column], "delete flag")
        source = source.withColumn("__gone", delete.holds(F.col(f"`{delete.column}`")))
        if delete.column in CHANGE_COLUMNS:
            target = target.drop(*CHANGE_COLUMNS)
        source = source.drop(*CHANGE_COLUMNS)
        gone = F.coalesce(F.col("s.__gone"), F.lit(False))
    target, wide, columns = _aligned(target, source.drop("__gone"))
    if gone is not None:
        wide = source.select(
            "__gone",
            *[F.col(f"`{c}`") if c in source.columns else F.lit(None).cast(type_of(target, c)).alias(c) for c in columns],
        )
    updated = [c for c in columns if c not in keys and c != CREATED and c in given]
    wide = wide.withColumn("__in_s", F.lit(True))
    match = same_key("t", "s", keys)

    def matched_value(c: str) -> Column:
        mine = F.col(f"t.`{c}`")
        new = F.when(F.col("s.__in_s"), F.col(f"s.`{c}`"))
        other = mine if unmatched is None else unmatched(c)
        return (new.otherwise(other) if c in updated else mine).alias(c)

    if estimated_bytes(source) <= broadcast_limit:
        kept = target.alias("t").join(F.broadcast(wide).alias("s"), match, "left")
        kept = kept.filter(~gone) if gone is not None else kept
        kept = kept.select(*[matched_value(c) for c in columns])
        known = target.select(*keys).alias("t").join(F.broadcast(wide.select(*keys)).alias("s"), match, "inner")
        known = known.select(*[F.col(f"s.`{k}`") for k in keys]).distinct()
        fresh = wide.alias("s").join(F.broadcast(known).alias("t"), match, "left_anti")
        return kept.unionByName(fresh.select(*[F.col(f"s.`{c}`") for c in columns]))
    both = target.withColumn("__in_t", F.lit(True)).alias("t").join(wide.alias("s"), match, "full_outer")
    if gone is not None:
        both = both.filter(~(F.col("t.__in_t").isNotNull() & gone))
    return both.select(
        *[F.when(F.col("t.__in_t"), matched_value(c)).otherwise(F.col(f"s.`{c}`")).alias(c) for c in columns]
    )


def merge(target: DataFrame, source: DataFrame, keys: list[str], **options) -> DataFrame:
    return upsert(target, source, keys, **options)


def merge_and_delete(target: DataFrame, source: DataFrame, keys: list[str], delete: DeleteFlag, **options) -> DataFrame:
    return upsert(target, source, keys, delete=delete, **options)


def merge_mark_unmatched(
    target: DataFrame, source: DataFrame, keys: list[str], delete: DeleteFlag, given_flags: bool = False, **options
) -> DataFrame:
    """Source rows are live (or as flagged already); target rows the source no longer has are flagged."""
    dtype = type_of(target, delete.column)
    live = source.withColumn(delete.column, F.col(f"`{delete.column}`").cast(dtype) if given_flags else F.lit(None).cast(dtype))
    def marked(c: str) -> Column:
        return delete.literal().cast(dtype) if c == delete.column else F.col(f"t.`{c}`")
    return upsert(target, live, keys, unmatched=marked, **options)


def merge_mark_all(target: DataFrame, source: DataFrame, keys: list[str], delete: DeleteFlag, **options) -> DataFrame:
    """The source lists deletions only: every source row is flagged, then merged."""
    dtype = type_of(target, delete.column)
    return upsert(target, source.withColumn(delete.column, delete.literal().cast(dtype)), keys, **options)


def overwrite(target: DataFrame, source: DataFrame) -> DataFrame:
    return source


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def first_load(source: DataFrame) -> DataFrame:
    return source.drop(*CHANGE_COLUMNS)


def is_ranged(source: DataFrame, column: str) -> bool:
    """Whether a batch covers a range of ``column`` (dates and numbers) or the values it has."""
    return isinstance(type_of(source, column), (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def in_range(source: DataFrame, column: str) -> Column:
    """True between the smallest and the largest value of ``column`` in the batch, a one-row subquery; else false."""
    value = F.col(f"`{column}`")
    low, high = source.agg(F.min(value)).scalar(), source.agg(F.max(value)).scalar()
    return F.coalesce(value.between(low, high), F.lit(False))


def replace_where(
    target: DataFrame, source: DataFrame, column: str, max_values: int | None = None
) -> DataFrame:
    """Replace the part of the target the batch covers.

    Dates and numbers: the range between the batch's smallest and largest
    value, a one-row subquery. Other types: the batch's distinct values by an
    anti join, so there is no limit unless ``max_values`` asks for one. A batch
    row with a null value lies outside both and fails the plan.
    """
    check_columns(source, [column], "replace_where")
    value = F.col(f"`{column}`")
    refuse = F.raise_error(F.lit(f"replace_where: null '{column}' in the batch")).cast("boolean")
    checked = source.filter(F.when(value.isNull(), refuse).otherwise(F.lit(True)))
    if is_ranged(source, column):
        kept = target.filter(~in_range(source, column))
    else:
        values = source.select(value).filter(value.isNotNull()).distinct()
        if max_values is not None:
            n = values.agg(F.count(F.lit(1))).scalar()
            over = F.raise_error(F.lit(f"replace_where: more than {max_values} distinct values")).cast("boolean")
            checked = checked.filter(F.when(n > max_values, over).otherwise(F.lit(True)))
        kept = target.join(values, column, "left_anti").select(*target.columns)
    return kept.unionByName(checked, allowMissingColumns=True)


def latest_per_key(source: DataFrame, keys: list[str], batch_columns: list[str]) -> DataFrame:
    """One pass instead of one merge per batch key, ascending.

    The last batch of a key decides its values, the first its creation time.
    Two rows of one key in the same batch are kept, so the merge still refuses them.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").desc() for c in batch_columns])
    last = source.withColumn("__r", F.rank().over(order)).filter("__r = 1").drop("__r")
    if CREATED not in source.columns:
        return last
    born = source.groupBy(*keys).agg(F.min_by(CREATED, F.struct(*batch_columns)).alias("__born"))
    joined = last.alias("t").join(born.alias("s"), same_key("t", "s", keys), "left")
    return joined.select(*[F.col("s.__born" if c == CREATED else f"t.`{c}`").alias(c) for c in last.columns])


def last_batch_live(source: DataFrame, keys: list[str], batch_columns: list[str], delete: DeleteFlag) -> DataFrame:
    """Net effect of mark-unmatched batches: keys of the last batch are live, all earlier ones are flagged."""
    newest = source.agg(F.max(F.struct(*[F.col(f"`{c}`") for c in batch_columns]))).scalar()
    kind = type_of(source, delete.column) if delete.column in source.columns else "string"
    live = F.struct(*[F.col(f"`{c}`") for c in batch_columns]) == newest
    return latest_per_key(source, keys, batch_columns).withColumn(
        delete.column, F.when(live, F.lit(None)).otherwise(delete.literal().cast(kind))
    )


def net_effect(
    target: DataFrame, source: DataFrame, keys: list[str], batch_columns: list[str], delete: DeleteFlag
) -> tuple[DataFrame, DataFrame]:
    """Target and source for one ``merge_and_delete`` that does what one merge per batch would.

    In the order of its batches, a flagged row removes a key that is there, any other row sets its values, and a row
    for an absent key begins it anew, even a flagged one. So a row without flag always leaves the key there, and every
    flagged row turns it over. What a key's batches come to follows from a few aggregates, which Spark combines before
    the shuffle and joins back, however many batches a key has:

    * its last row, and its last flagged row;
    * the number of flagged rows that end with the latter, back to the last row without flag before it or to the
      start: together with what was there before, its parity says whether the key is there after them;
    * the first row behind them, which begins the key anew if it is not.

    Keys removed and begun again leave the target first, so that they get a new creation time.
    """
    source = one_row_per_key(once(source, "batches"), [*keys, *batch_columns], "merge source")
    order = F.struct(*[F.col(f"`{c}`") for c in batch_columns])
    created = F.col(f"`{CREATED}`") if CREATED in source.columns else F.lit(None).cast("timestamp")
    steps = source.select(*[F.col(f"`{k}`") for k in keys], order.alias("__o"), delete.holds(F.col(f"`{delete.column}`")).alias("__gone"), created.alias("__at"))
    ends = steps.groupBy(*keys).agg(F.max("__o").alias("__last"), F.max(F.when(F.col("__gone"), F.col("__o"))).alias("__flag"))
    seen = mark_by_keys(steps, keys, ends)
    before, after = F.col("__o") < F.col("__flag"), F.col("__flag").isNull() | (F.col("__o") > F.col("__flag"))
    alive = ~F.col("__gone")
    edges = seen.groupBy(*keys, "__last", "__flag").agg(
        F.max(F.when(alive & before, F.col("__o"))).alias("__live"),
        F.min_by("__at", F.when(alive & after, F.col("__o"))).alias("__behind"),
        F.min_by("__at", F.when(F.col("__gone") & (F.col("__o") == F.col("__flag")), F.col("__o"))).alias("__turned"),
    )
    edges = once(edges, "edges")
    counted = mark_by_keys(steps.filter("__gone").select(*keys, "__o"), keys, edges.select(*keys, "__live"))
    flags = counted.filter(F.col("__live").isNull() | (F.col("__o") > F.col("__live"))).groupBy(*keys).agg(F.count(F.lit(1)).alias("__flags"))
    have = target.select(*keys).distinct().withColumn("__have", F.lit(True))
    known = mark_by_keys(mark_by_keys(edges, keys, flags), keys, have).withColumn("__have", F.coalesce("__have", F.lit(False)))
    odd = F.coalesce(F.col("__flags") % 2 == 1, F.lit(False))
    there = (F.col("__live").isNotNull() | F.col("__have")) != odd  # after the last flagged row
    ended = F.coalesce(F.col("__flag") == F.col("__last"), F.lit(False))
    state = known.select(
        *[F.col(f"`{k}`") for k in keys], "__have", F.col("__last").alias("__row"), (there | ~ended).alias("__stays"),
        (F.col("__flag").isNotNull() | ~F.col("__have")).alias("__fresh"),
        F.when(F.col("__flag").isNotNull() & there, F.col("__turned")).otherwise(F.col("__behind")).alias("__born"),
    )
    state = once(state, "net")
    rows = mark_by_keys(source.withColumn("__o", order), keys, state).filter((F.col("__o") == F.col("__row")) & (F.col("__stays") | F.col("__have")))

    def value(c: str) -> Column:
        column = F.col(f"`{c}`")
        if c == CREATED:
            column = F.when(F.col("__stays") & F.col("__fresh"), F.col("__born")).otherwise(column)
        if c == delete.column:
            column = F.when(F.col("__stays"), column).otherwise(delete.literal().cast(type_of(source, c)))
        return column.alias(c)

    reborn = state.filter("__have AND __stays AND __fresh").select(*keys)
    left = target.alias("t").join(reborn.alias("s"), same_key("t", "s", keys), "left_anti")
    return left, rows.select(*[value(c) for c in source.columns])


def change_feed(
    previous: DataFrame, current: DataFrame, keys: list[str], version: int, at: Column
) -> DataFrame:
    """Row changes between two snapshots, one per key: insert, update_postimage or delete.

    Deleted rows carry their last values; unchanged rows do not appear. Rows are
    compared column by column, so there are no hash collisions.
    """
    previous, current, columns = _aligned(previous, current)
    rest = [c for c in columns if c not in keys]
    p = previous.withColumn("__p", F.lit(True)).alias("t")
    c = current.withColumn("__c", F.lit(True)).alias("s")
    both = p.join(c, same_key("t", "s", keys), "full_outer")
    same = F.lit(True)
    for name in rest:
        same = same & F.col(f"t.`{name}`").eqNullSafe(F.col(f"s.`{name}`"))
    kind = (
        F.when(F.col("t.__p").isNull(), F.lit("insert"))
        .when(F.col("s.__c").isNull(), F.lit("delete"))
        .when(~same, F.lit("update_postimage"))
    )
    pick = lambda n: F.when(F.col("s.__c"), F.col(f"s.`{n}`")).otherwise(F.col(f"t.`{n}`")).alias(n)
    changed = both.select(*[pick(n) for n in columns], kind.alias("_change_type")).filter("_change_type IS NOT NULL")
    return changed.withColumns({"_commit_version": F.lit(version).cast("bigint"), "_commit_timestamp": at})


def initial_feed(current: DataFrame, version: int, at: Column) -> DataFrame:
    """The first read of a change feed: the whole table as inserts."""
    stamps = {"_commit_version": F.lit(version).cast("bigint"), "_commit_timestamp": at}
    return current.withColumns({"_change_type": F.lit("insert"), **stamps})


FEED_DELETE = DeleteFlag("_change_type", "delete")


def apply_merge(
    kind: str,
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    delete: DeleteFlag | None = None,
    replace_column: str | None = None,
    batch_columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """Next target state for a merge type; without a target it is a first load."""
    kind = choice(kind, MERGE_TYPES, "merge type")
    if target is None:
        return first_load(source)
    if kind == "append":
        return append(target, source)
    if kind == "overwrite":
        return overwrite(target, source)
    if kind == "replace_where":
        if not replace_column:
            raise SpecError("replace_where needs a column")
        return replace_where(target, source, replace_column)
    if batch_columns and kind == "merge_and_delete" and delete is not None:
        target, source = net_effect(target, source, keys, batch_columns, delete)
    elif batch_columns and kind == "merge_mark_unmatched_deleted" and delete is not None:
        source = last_batch_live(source, keys, batch_columns, delete)
        return merge_mark_unmatched(target, source, keys, delete, given_flags=True, **options)
    elif batch_columns:
        source = latest_per_key(source, keys, batch_columns)
    if kind == "merge":
        return merge(target, source, keys, **options)
    if delete is None:
        raise SpecError(f"{kind} needs a delete column and value")
    by_flag = {
        "merge_and_delete": merge_and_delete,
        "merge_mark_unmatched_deleted": merge_mark_unmatched,
        "merge_mark_all_deleted": merge_mark_all,
    }
    return by_flag[kind](target, source, keys, delete, **options)
