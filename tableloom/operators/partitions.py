"""Which partitions of a target a batch touches, so that a run need not rewrite the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.operators.keys import broadcast_if_small, same_key
from tableloom.operators.merge import in_range, is_ranged
from tableloom.spec import SpecError, check_columns, type_of

#: Merge types whose effect is confined to the partitions of matched and incoming rows.
CONFINED = ("merge", "merge_and_delete", "merge_mark_all_deleted", "replace_where")


def touched(kind: str, target: DataFrame, source: DataFrame, by: list[str], keys: list[str], column: str | None = None) -> DataFrame:
    """Distinct values of ``by`` that the merge may change: those of the batch and of the rows it replaces.

    Replaced rows are found by reading the replaced column, or the keys, only; where the table is partitioned by
    the replaced column Spark lists partitions and reads nothing.
    """
    check_columns(source, by, "partition columns")
    values = [F.col(f"`{c}`") for c in by]
    if kind == "replace_where":
        if not column:
            raise SpecError("replace_where needs a column")
        if is_ranged(source, column):
            hit = target.filter(in_range(source, column))
        else:
            hit = target.join(source.select(column).distinct(), column, "left_semi")
    else:
        have = target.select(*dict.fromkeys([*keys, *by])).alias("t")
        hit = have.join(broadcast_if_small(source.select(*keys).distinct()).alias("s"), same_key("t", "s", keys), "left_semi")
    return hit.select(*values).union(source.select(*values)).distinct()


def pruned(target: DataFrame, spots: DataFrame, by: list[str]) -> DataFrame:
    """The rows of ``target`` in the partitions ``spots``.

    Partition values become literals, so that Spark prunes files while it plans. The driver holds the list of
    all partitions of a table it reads anyway.
    """
    rows = [tuple(r[c] for c in by) for r in spots.collect()]
    return target.filter(_among(rows, by))


def _among(rows: list[tuple], by: list[str]) -> Column:
    """Whether the partition columns have one of the given combinations of values."""
    first, *rest = by
    column = F.col(f"`{first}`")
    if not rest:
        return column.isin([v for v, in rows])
    groups: dict = {}
    for value, *more in rows:
        groups.setdefault(value, []).append(tuple(more))
    found = F.lit(False)
    for value, more in groups.items():
        found = found | ((column == value) & _among(more, rest))
    return found


def emptied(scope: DataFrame, result: DataFrame, by: list[str]) -> list[str]:
    """Folders of the partitions in ``scope`` for which ``result`` has no row."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    have = scope.select(*[F.col(f"`{c}`") for c in by], folder.alias("__folder")).distinct()
    left = result.select(*by).distinct()
    return [r["__folder"] for r in have.join(left, by, "left_anti").select("__folder").distinct().collect()]
