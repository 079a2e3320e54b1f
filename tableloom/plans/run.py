"""One run of one table: read, shape, transform, check, compare schemas, write, log."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableloom.functions.dbtypes import ColumnDef, apply_source_types, not_null_checks
from tableloom.functions.names import add_timestamps, cleanse_columns, cleanse_names, clean_strings
from tableloom.operators import schema as schemas
from tableloom.operators.merge import FEED_DELETE, DeleteFlag, apply_merge, first_load
from tableloom.operators.partitions import CONFINED, emptied, pruned, touched
from tableloom.operators.project import order_columns
from tableloom.operators.quality import QualityFailure, run_quality
from tableloom.operators.scd2 import add_history_columns, backdate_single_versions, merge_history
from tableloom.plans import control
from tableloom.plans.steps import Hook, StepContext, apply_steps
from tableloom.session import scratch, settle
from tableloom.sources.files import FileSpec, read_changed_files, read_files, read_new_folders
from tableloom.sources.store import TableStore, write_output
from tableloom.sources.tables import FIRST_MARKS, after_mark, next_mark, read_changes
from tableloom.spec import NoDataFound, SpecError

SCHEMA_ID = "delta__schema_id"
SCHEMA_LOG = "Table_ID int, Target_Entity string, Schema_ID string, Schema_Details string, Schema_Arrival_Time timestamp, Date_Key int"
SCHEMA_CHANGES = (
    "Table_ID int, Target_Entity string, Change_Type string, Column_Name string, Data_Type_Details string, Schema_Arrival_Time timestamp, Date_Key int"
)
DEFAULT_MERGE = {"bronze": "append", "silver": "merge", "gold": "merge"}


@dataclass
class SourceSpec:
    """Where rows come from: one of table, paths, wildcard folder, staging folder or function."""

    table: str | None = None
    paths: list[str] | None = None
    wildcard_folder: str | None = None
    wildcard_pattern: str | None = None
    staging_folder: str | None = None
    files: FileSpec | None = None
    function: Callable | None = None
    mark_columns: list[str] = field(default_factory=list)
    mark_kind: str = "datetime"
    change_feed_keys: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class OutputSpec:
    """How ``output_file`` writes: the spec's target is the path of the one file, with date and time marks; without ``single`` of a folder."""

    delimiter: str | None = None
    single: bool = True


@dataclass
class TableSpec:
    """Everything that describes one target table."""

    target: str
    source: SourceSpec
    layer: str = "silver"
    primary_keys: list[str] = field(default_factory=list)
    name_rules: dict = field(default_factory=dict)
    column_defs: list[ColumnDef] = field(default_factory=list)
    trim_strings: str | None = None
    blank_to_null: str | None = None
    steps: list[dict] = field(default_factory=list)
    checks: list[dict] = field(default_factory=list)
    if_duplicate_keys: str = "fail"
    merge_type: str | None = None
    delete: DeleteFlag | None = None
    replace_column: str | None = None
    output: OutputSpec | None = None
    schema_id: bool = False
    partition_by: list[str] = field(default_factory=list)
    batch_columns: list[str] = field(default_factory=list)
    batch_id: int | None = None
    source_timestamp: str | None = None
    dimension_key: str | None = None
    contract: str | None = None
    fail_on_schema_change: bool = False
    fail_on_type_change: bool = False
    table_id: int | None = None
    full_reload: bool = False


@dataclass
class RunResult:
    status: str
    mark: str | None
    results: list[dict]
    schema_changes: list[dict]
    version: int | None = None
    rows: int = 0
    quarantined: int = 0


def read_source(
    spark: SparkSession, store: TableStore, spec: SourceSpec, mark: str | None, seen_version: int | None = None
) -> tuple[DataFrame, str | None]:
    """Rows newer than ``mark`` and the mark to keep."""
    if spec.function is not None:
        made = spec.function({"watermark_value": mark, "watermark_columns": spec.mark_columns}, spark)
        return made if isinstance(made, tuple) else (made, mark)
    if spec.wildcard_folder or spec.staging_folder:
        if spec.files is None:
            raise SpecError("a folder source needs a file specification")
        if spec.wildcard_folder:
            first = mark or FIRST_MARKS["datetime"]
            df, new = read_changed_files(spark, spec.wildcard_folder, spec.files, first, spec.wildcard_pattern)
        else:
            df, new = read_new_folders(spark, spec.staging_folder, spec.files, mark or FIRST_MARKS["numeric"])
        if df is None:
            raise NoDataFound("no new files")
        return df, new
    if spec.paths:
        return read_files(spark, spec.paths, spec.files or FileSpec("parquet")), mark
    if not spec.table:
        raise SpecError("a source needs a table, paths, a folder or a function")
    table = store.read(spec.table)
    if spec.change_feed_keys:
        version = store.version(spec.table) or 0
        previous = store.read(spec.table, int(mark) - 1) if mark not in (None, "", *FIRST_MARKS.values()) and int(mark) > 0 else None
        df, after = read_changes(table, previous, spec.change_feed_keys, version, F.current_timestamp())
        return df, str(after)
    if not spec.mark_columns:
        return table, mark
    rows = after_mark(table, spec.mark_columns, spec.mark_kind, mark)
    new = next_mark(rows, spec.mark_columns).first()[0]
    return rows, new or mark


def run_table(
    spark: SparkSession,
    store: TableStore,
    spec: TableSpec,
    mark: str | None = None,
    hooks: dict[str, Hook] | None = None,
    now: datetime | None = None,
) -> RunResult:
    """Carry out one run and append its log rows.

    A first run without rows is an error; later runs without rows end as
    processed with the mark unchanged. Failed checks stop the run before the
    target is touched.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    log_id = str(uuid.uuid4())
    first_run = spec.full_reload or "/" not in spec.target and not store.exists(spec.target)
    mark = None if spec.full_reload else mark
    try:
        with scratch(spark):
            result = _run(spark, store, spec, mark, hooks or {}, now, first_run, log_id)
    except NoDataFound:
        if first_run:
            raise
        result = RunResult(control.PROCESSED, mark, [], [])
    except Exception as err:
        results = err.results if isinstance(err, QualityFailure) else []
        _log(spark, store, spec, RunResult(control.FAILED, mark, results, []), now, log_id)
        raise
    _log(spark, store, spec, result, now, log_id)
    return result


def _run(spark, store, spec, mark, hooks, now, first_run, log_id) -> RunResult:
    df, new_mark = read_source(spark, store, spec.source, mark)
    if spec.contract:
        schemas.check_contract(df, spec.contract)
    keys = cleanse_names(spec.primary_keys, spec.name_rules) if spec.name_rules else spec.primary_keys
    df = cleanse_columns(df, spec.name_rules) if spec.name_rules else df
    df = apply_source_types(df, spec.column_defs) if spec.column_defs else df
    df = add_timestamps(clean_strings(df, spec.trim_strings, spec.blank_to_null), F.lit(now))
    kind, delete = _merge_type(spec), FEED_DELETE if spec.source.change_feed_keys else spec.delete
    target = None if first_run or kind == "output_file" else store.read(spec.target)
    ctx = StepContext(
        store, hooks, {"target": spec.target, "log_id": log_id}, keys, target, kind,
        delete.column if delete else None, spec.dimension_key,
    )
    df = apply_steps(df, spec.steps, ctx)
    if first_run and kind == "scd2":
        df = add_history_columns(df, spec.source_timestamp, delete)
    outcome = run_quality(
        order_columns(df), [*not_null_checks(spec.column_defs), *spec.checks], [*keys, *spec.batch_columns],
        spec.if_duplicate_keys, store.read, target, F.lit(now), materialize=True,
    )
    # counted while the flags were written
    rows, held = outcome.sizes()
    if rows + held == 0:
        raise NoDataFound("no rows after the transformation steps")
    results = outcome.stop_on_failure()
    known = target.drop(SCHEMA_ID).schema if target is not None else outcome.clean.schema
    changes = schemas.apply_drift_policy(
        schemas.schema_changes(known, outcome.clean.schema) if target is not None else [],
        spec.fail_on_schema_change, spec.fail_on_type_change, first_run,
    )
    clean = outcome.clean
    if spec.schema_id:
        # the identity of the columns that the source and the steps gave, not of those that runs add
        own = T.StructType([f for f in clean.schema if not f.name.startswith("delta__")])
        clean = clean.withColumn(SCHEMA_ID, F.lit(schemas.fingerprint(own)))
    version = _write(store, spec, target, clean, kind, keys, delete, now)
    _log_schema(spark, store, spec, clean.schema, changes, now)
    if held:
        store.append_rows(f"{spec.target.rsplit('/', 1)[-1].split('.')[0] if '/' in spec.target else spec.target}_quarantined", outcome.quarantined)
    return RunResult(control.PROCESSED, new_mark, results, changes, version, rows, held)


def _merge_type(spec: TableSpec) -> str:
    if spec.merge_type:
        return spec.merge_type
    if "/" in spec.target:
        return "output_file"
    if spec.delete or spec.source.change_feed_keys:
        return "merge_and_delete"
    return DEFAULT_MERGE.get(spec.layer, "merge")


def _write(store, spec: TableSpec, target, clean, kind: str, keys: list[str], delete: DeleteFlag | None, now: datetime) -> int | None:
    """Bring the target to its next state and give its version.

    Appends add files. In a partitioned table a merge that is confined to the partitions it touches rewrites these
    alone. Everything else writes the whole next state.
    """
    if kind == "output_file":
        how = spec.output or OutputSpec()
        write_output(first_load(order_columns(clean)), spec.target, how.delimiter, now, how.single)
        return None
    if target is not None and kind == "append":
        return store.append(spec.target, order_columns(clean), spec.batch_id)
    by = spec.partition_by or (store.partitioned_by(spec.target) if target is not None else [])
    kinds = dict(target.dtypes) if target is not None else {}
    same_types = all(kinds.get(c, t) == t for c, t in clean.dtypes)
    if not (target is not None and kind in CONFINED and same_types and by and by == store.partitioned_by(spec.target)):
        return store.write(spec.target, _next_state(target, clean, spec, kind, keys, delete), spec.batch_id, by or None)
    spots = settle(touched(kind, target, clean, by, keys, spec.replace_column), "partitions")
    scope = pruned(target, spots, by)
    result = settle(_next_state(scope, clean, spec, kind, keys, delete), "partitions")
    return store.replace_partitions(spec.target, result, spec.batch_id, emptied(scope, result, by))


def _next_state(target, clean, spec: TableSpec, kind: str, keys: list[str], delete: DeleteFlag | None) -> DataFrame:
    if kind == "scd2" and target is not None:
        merged = merge_history(target, clean, keys, spec.source_timestamp, delete, spec.dimension_key, spec.source.mark_columns)
    else:
        merged = apply_merge(kind, target, clean, keys, delete, spec.replace_column, spec.batch_columns)
    return order_columns(backdate_single_versions(merged, keys) if kind == "scd2" else merged)


def _log(spark, store, spec: TableSpec, result: RunResult, now: datetime, log_id: str) -> None:
    store_name, _, entity = (spec.layer, "", spec.target) if "/" in spec.target else spec.target.rpartition(".")
    run = {
        "Log_ID": log_id, "Table_ID": spec.table_id, "Target_Datastore": store_name or spec.layer,
        "Target_Entity": entity, "Data_Source_Details": spec.source.table or spec.source.wildcard_folder,
        "Ingestion_Start_Time": now, "Ingestion_End_Time": datetime.now(timezone.utc).replace(tzinfo=None),
        "Ingestion_Status": result.status, "Processing_Phase": "Batch", "Watermark_Value": result.mark,
        "Records_Processed": result.rows, "Quarantined_Records": result.quarantined, "Date_Key": control.date_key(now),
        **control.lineage_label(None, spec.source.table, spec.layer, entity),
    }
    store.append_rows("log.runs", control.log_rows(spark, [run], control.RUN_LOG))
    notes = [
        {
            "Log_ID": log_id, "Table_ID": spec.table_id, "Table_Name": entity, "Datastore_Name": store_name,
            "Data_Quality_Category": r["category"], "Data_Quality_Result": r["outcome"],
            "Data_Quality_Message": r["message"], "Rows_Impacted": r["rows_impacted"],
            "Data_Quarantined": r["quarantined"], "Rows_Quarantined": r["rows_quarantined"],
            "Ingestion_Start_Time": now, "Ingestion_End_Time": now, "Date_Key": control.date_key(now),
        }
        for r in result.results
    ]
    if notes:
        store.append_rows("log.quality", control.log_rows(spark, notes, control.DQ_LOG))


def _log_schema(spark, store, spec: TableSpec, schema: T.StructType, changes: list[dict], now: datetime) -> None:
    """Keep a new schema of the target, and what changed, in the schema logs."""
    details, id_ = schema.simpleString(), schemas.fingerprint(T.StructType([f for f in schema if not f.name.startswith("delta__")]))
    seen = store.exists("log.schemas") and not store.read("log.schemas").filter((F.col("Target_Entity") == spec.target) & (F.col("Schema_ID") == id_)).isEmpty()
    if not seen:
        row = (spec.table_id, spec.target, id_, details, now, control.date_key(now))
        store.append_rows("log.schemas", spark.createDataFrame([row], SCHEMA_LOG))
    if changes:
        rows = [(spec.table_id, spec.target, c["Change_Type"], c["Column_Name"], c["Data_Type_Details"], now, control.date_key(now)) for c in changes]
        store.append_rows("log.schema_changes", spark.createDataFrame(rows, SCHEMA_CHANGES))


def micro_batches(
    spark: SparkSession, store: TableStore, spec: TableSpec, hooks: dict[str, Hook] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that runs ``spec`` on each micro-batch once.

    The batch takes the place of the spec's source. Its id is committed in the
    pointer of the version it makes, so a batch replayed after a failure is skipped or done, never doubled.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        last = store.batch(spec.target)
        if (last is None or batch_id > last) and not batch.isEmpty():
            source = SourceSpec(function=lambda metadata, session: batch)
            run_table(spark, store, replace(spec, source=source, batch_id=batch_id), hooks=hooks)

    return handle
