"""The ordered list of transformation steps, by category name."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tableloom.functions import text as text_ops, times
from tableloom.operators import aggregates, dimensions, joins, nested, nulls, project, resolve, sets, windows
from tableloom.sources.store import TableStore
from tableloom.spec import SpecError, choice, flag, names, text

Hook = Callable[..., DataFrame]


@dataclass
class StepContext:
    """What steps may need besides the frame: tables, hooks, the target's keys."""

    store: TableStore
    hooks: dict[str, Hook] = field(default_factory=dict)
    metadata: dict[str, Any] = field(default_factory=dict)
    primary_keys: list[str] = field(default_factory=list)
    target: DataFrame | None = None
    merge_type: str = "merge"
    delete_column: str | None = None
    dimension_key: str | None = None


Step = Callable[[DataFrame, dict, StepContext], DataFrame]


def _columns(step: dict, key: str = "column_name") -> list[str]:
    return names(text(step, key))


def _split_values(step: dict, key: str) -> list[str]:
    return names(text(step, key), step.get("values_delimiter", ","))


def _sort_order(step: dict) -> str | None:
    return step.get("order_direction") or step.get("sort_direction")


def _surrogate(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    choice(text(step, "type", "auto_increment"), ["auto_increment"], "surrogate key type")
    column = text(step, "column_name").strip()
    out = dimensions.assign_surrogate_keys(df, ctx.primary_keys, column, ctx.target)
    if ctx.target is None or ctx.merge_type == "overwrite":
        return dimensions.append_unknown_member(out, column, ctx.delete_column)
    return out


def _attach(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    key = step.get("dimension_table_key_column_name") or ctx.dimension_key
    if not key:
        raise SpecError("attach_dimension_surrogate_key: 'dimension_table_key_column_name' must be given")
    condition = text(step, "dimension_table_join_logic")
    joined_on = re.findall(r"\bb\.(?:`([^`]+)`|(\w+))", condition, re.IGNORECASE)
    return dimensions.attach_surrogate_key(
        df,
        ctx.store.read(text(step, "dimension_table_name").strip()),
        condition,
        key,
        text(step, "dimension_key_output_column_name").strip(),
        list(dict.fromkeys(quoted or plain for quoted, plain in joined_on)),
        names(step.get("dimension_columns_to_add_to_fact")),
    )


def _join(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    return joins.join_data(
        df,
        ctx.store.read(text(step, "right_table_name").strip()),
        text(step, "join_condition"),
        text(step, "join_type", "inner"),
        text(step, "left_columns", "*"),
        text(step, "right_columns", "*"),
        flag(step.get("broadcast_hint")),
    )


def _union(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    return sets.union_all(
        df,
        [ctx.store.read(n) for n in _columns(step, "union_tables")],
        text(step, "union_type", "by_name"),
        flag(step.get("allow_missing_columns"), True),
        flag(step.get("deduplicate")),
    )


def _entities(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    query = step.get("secondary_dataset_query")
    secondary = ctx.store.spark.sql(query) if query else None
    if secondary is None and step.get("secondary_table_name"):
        secondary = ctx.store.read(step["secondary_table_name"])
    return resolve.resolve_step(df, resolve.MatchSpec.parse(step), secondary)


def _custom(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    """Call registered functions in order; each sees the step's own settings."""
    for name in _columns(step, "functions_to_execute"):
        if name not in ctx.hooks:
            raise SpecError(f"custom function '{name}' is not registered")
        df = ctx.hooks[name](new_data=df, metadata={**ctx.metadata, "function_config": step}, spark=ctx.store.spark)
    return df


def _hash(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    columns = text(step, "column_name", "*")
    return project.add_row_hash(
        df,
        None if columns.strip() == "*" else names(columns),
        text(step, "output_column_name", "row_hash").strip(),
        text(step, "hash_algorithm", "xxhash64").strip().lower(),
    )


def _dedup(df: DataFrame, step: dict, ctx: StepContext) -> DataFrame:
    columns = text(step, "column_name", "*")
    keys = [] if columns.strip() == "*" else names(columns)
    return sets.drop_duplicates(df, keys, names(step.get("order_by")), _sort_order(step))


STEPS: dict[str, Step] = {
    "columns_to_rename": lambda df, s, c: project.rename_columns(
        df, _columns(s, "existing_column_name"), _columns(s, "new_column_name")
    ),
    "derived_column": lambda df, s, c: project.derive_column(df, text(s, "column_name").strip(), text(s, "expression")),
    "remove_columns": lambda df, s, c: project.remove_columns(df, _columns(s)),
    "select_columns": lambda df, s, c: project.select_columns(
        df, _columns(s), flag(s.get("retain_metadata_columns"), True)
    ),
    "filter_data": lambda df, s, c: project.filter_rows(df, text(s, "filter_logic")),
    "sort_data": lambda df, s, c: project.sort_rows(df, _columns(s), names(s.get("sort_direction"))),
    "create_surrogate_key": _surrogate,
    "attach_dimension_surrogate_key": _attach,
    "entity_resolution": _entities,
    "drop_duplicates": _dedup,
    "change_data_types": lambda df, s, c: project.change_types(df, _columns(s), text(s, "new_type")),
    "apply_null_handling": lambda df, s, c: nulls.handle_nulls(df, s),
    "replace_values": lambda df, s, c: nulls.replace_values(
        df, _columns(s), _split_values(s, "values_to_replace"), str(s.get("replacement_value", ""))
    ),
    "mask_sensitive_data": lambda df, s, c: project.mask_columns(
        df, _columns(s), s.get("upper_char", "X"), s.get("lower_char", "X"), s.get("digit_char", "X"), s.get("other_char")
    ),
    "add_row_hash": _hash,
    "pivot_data": lambda df, s, c: aggregates.pivot(
        df, _columns(s, "group_columns"), text(s, "pivot_column").strip(), _columns(s, "value_column"),
        _columns(s, "aggregation"), names(s.get("pivot_values")) or None,
    ),
    "unpivot_data": lambda df, s, c: aggregates.unpivot(
        df, _columns(s, "id_columns"), _columns(s, "value_columns"), text(s, "variable_name", "variable"),
        text(s, "value_name", "value"),
    ),
    "join_data": _join,
    "add_window_function": lambda df, s, c: windows.add_windows(df, [_window_column(s)]),
    "aggregate_data": lambda df, s, c: aggregates.aggregate(
        df, names(s.get("group_by_columns")), _columns(s), _columns(s, "aggregation"), _columns(s, "output_column_name")
    ),
    "transform_datetime": lambda df, s, c: times.transform_datetime(df, s),
    "union_data": _union,
    "custom_transformation_function": _custom,
    "explode_array": lambda df, s, c: nested.explode_array(
        df, text(s, "column_name").strip(), (s.get("output_column_name") or "").strip() or None, flag(s.get("preserve_nulls"))
    ),
    "flatten_struct": lambda df, s, c: nested.flatten_struct(
        df, text(s, "column_name").strip(), s.get("prefix"), names(s.get("fields_to_include")),
        flag(s.get("drop_original"), True),
    ),
    "split_column": lambda df, s, c: text_ops.split_column(
        df, text(s, "column_name").strip(), s.get("delimiter", ","), _columns(s, "output_column_names"),
        int(s.get("max_splits", -1)), flag(s.get("drop_original")),
    ),
    "concat_columns": lambda df, s, c: text_ops.concat_columns(
        df, _columns(s), text(s, "output_column_name").strip(), s.get("separator", ""), text(s, "null_handling", "skip"),
        flag(s.get("drop_original")),
    ),
    "conditional_column": lambda df, s, c: project.conditional_column(
        df, text(s, "column_name").strip(), _split_values(s, "conditions"), _split_values(s, "values"), s.get("default_value")
    ),
    "string_functions": lambda df, s, c: text_ops.apply_string_function(
        df, text(s, "column_name"), text(s, "function"), text(s, "output_column_name").strip()
    ),
    "normalize_text": lambda df, s, c: text_ops.normalize_columns(
        df, text(s, "column_name"), names(text(s, "operations", "trim,lowercase,collapse_whitespace")),
        (s.get("output_column_name") or "").strip() or None,
    ),
}


def _window_column(step: dict) -> windows.WindowColumn:
    return windows.WindowColumn.make(
        text(step, "window_function"), text(step, "output_column_name").strip(), step.get("partition_by"),
        step.get("order_by"), step.get("order_direction") or "asc", (step.get("column_name") or "").strip() or None,
    )


def _window_runs(steps: Iterable[dict]) -> Iterable[dict | list[windows.WindowColumn]]:
    """Consecutive window steps over the same groups become one; others pass."""
    run: list[windows.WindowColumn] = []
    for step in steps:
        if step.get("Category") == "add_window_function":
            made = _window_column(step)
            apart = run and (made.keys != run[0].keys or {w.output for w in run} & {made.output, *made.reads()})
            if apart:
                yield run
                run = []
            run.append(made)
            continue
        if run:
            yield run
            run = []
        yield step
    if run:
        yield run


def apply_steps(df: DataFrame, steps: Iterable[dict], ctx: StepContext) -> DataFrame:
    """Run the steps in order; nothing executes here beyond what a step itself settles."""
    for step in _window_runs(steps):
        if isinstance(step, list):
            df = windows.add_windows(df, step)
            continue
        category = step.get("Category", "")
        if category not in STEPS:
            raise SpecError(f"unknown step '{category}'; known: {', '.join(STEPS)}")
        df = STEPS[category](df, step, ctx)
    return df
