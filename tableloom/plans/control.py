"""Control tables, run log and the questions asked of them before and after runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tableloom.operators.merge import upsert
from tableloom.operators.nested import attributes_to_json, rows_from_json
from tableloom.sources.tables import FIRST_MARKS, RELOAD_MARKS
from tableloom.spec import SpecError

# Columns of the control and log tables.
ORCHESTRATION = (
    "Trigger_Name string, Order_Of_Operations int, Table_ID int, Target_Datastore string, Target_Entity string, "
    "Primary_Keys string, Processing_Method string, Ingestion_Active int"
)
PRIMARY_CONFIG = (
    "Table_ID int, Configuration_Category string, Configuration_Name string, Configuration_Value string"
)
ADVANCED_CONFIG = (
    "Table_ID int, Configuration_Category string, Configuration_Name string, "
    "Configuration_Name_Instance_Number int, Configuration_Attribute_Name string, Configuration_Attribute_Value string"
)
DATASTORE = (
    "Datastore_Name string, Datastore_Kind string, Medallion_Layer string, Workspace_ID string, Workspace_URL string, "
    "SQL_Warehouse_ID string, Catalog_Name string, Connection_Details string"
)
RUN_LOG = (
    "Log_ID string, Table_ID int, Source_Medallion_Layer string, Source_Type string, Data_Source_Details string, "
    "Target_Medallion_Layer string, Target_Type string, Target_Datastore string, Target_Entity string, "
    "Ingestion_Start_Time timestamp, Ingestion_End_Time timestamp, Ingestion_Status string, Processing_Phase string, "
    "Watermark_Value string, Records_Processed bigint, Quarantined_Records bigint, Job_Run_URL string, "
    "Trigger_Name string, Trigger_Step int, Trigger_Execution_ID string, Trigger_Execution_Start_Time timestamp, "
    "Date_Key int"
)
DQ_LOG = (
    "Log_ID string, Datastore_Name string, Table_ID int, Table_Name string, Data_Quality_Category string, "
    "Data_Quality_Result string, Data_Quality_Message string, Rows_Impacted bigint, Data_Quarantined string, "
    "Rows_Quarantined bigint, Ingestion_Start_Time timestamp, Ingestion_End_Time timestamp, Job_Run_URL string, "
    "Date_Key int"
)
SCHEMA_LOG = (
    "Table_ID int, Datastore_Name string, Table_Name string, Schema_ID string, Schema_Details string, "
    "Schema_Arrival_Time timestamp, Job_Run_URL string, Date_Key int"
)
ACTIVITY_LOG = (
    "Table_ID int, Log_ID string, Sequence_Number int, Log_Timestamp timestamp, Log_Level string, Step_Name string, "
    "Step_Number int, Message string, Source_Type string"
)
# Merge types that look at a delete column, and run states.
DELETE_AWARE = ("merge_and_delete", "merge_mark_unmatched_deleted", "merge_mark_all_deleted", "scd2")
STARTED, PROCESSED, FAILED, FULL_RELOAD = "Started", "Processed", "Failed", "FULL_RELOAD"


def trigger_tables(
    orchestration: DataFrame, primary: DataFrame, trigger: str, start_step: int = 0, table_ids: list[int] | None = None
) -> DataFrame:
    """Active tables of a trigger by step, from ``start_step`` on (which is how a run restarts)."""
    wanted = orchestration.filter(
        (F.col("Trigger_Name") == trigger) & (F.col("Order_Of_Operations") >= start_step) & (F.col("Ingestion_Active") == 1)
    )
    if table_ids:
        wanted = wanted.filter(F.col("Table_ID").isin(table_ids))
    settings = config_values(primary, {
        "source_store": ("source_details", "datastore_name"),
        "staging": ("source_details", "staging_lakehouse_name"),
        "environment": ("other_settings", "spark_environment_id"),
    })
    joined = wanted.join(settings, "Table_ID", "left")
    parts = ["Table_ID", "Processing_Method", "Target_Datastore", "Target_Entity", "source_store", "staging", "environment"]
    detail = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return joined.groupBy("Trigger_Name", "Order_Of_Operations").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("Table_ID", detail.alias("d")))), lambda x: x["d"]), ",")
        .alias("Pipeline_Table_Details")
    )


def config_values(primary: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Chosen settings per table as columns, one aggregate instead of a join each."""
    picks = []
    for alias, (category, name) in wanted.items():
        hit = (F.col("Configuration_Category") == category) & (F.col("Configuration_Name") == name)
        picks.append(F.max(F.when(hit, F.col("Configuration_Value"))).alias(alias))
    return primary.groupBy("Table_ID").agg(*picks)


def config_map(primary: DataFrame) -> DataFrame:
    """All settings of a table as ``category_name -> value``."""
    entry = F.struct(F.concat_ws("_", "Configuration_Category", "Configuration_Name").alias("key"), F.col("Configuration_Value").alias("value"))
    return primary.groupBy("Table_ID").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("settings"))


def last_status(log: DataFrame) -> DataFrame:
    """Smallest status of each table's latest execution; ``Failed`` if it never ran."""
    latest = log.groupBy("Table_ID").agg(F.max("Trigger_Execution_Start_Time").alias("t"))
    batch = log.filter("Processing_Phase = 'Batch'").alias("l")
    found = latest.alias("r").join(
        batch, (F.col("l.Table_ID") == F.col("r.Table_ID")) & (F.col("l.Trigger_Execution_Start_Time") == F.col("r.t")), "left"
    )
    return found.groupBy(F.col("r.Table_ID").alias("Table_ID")).agg(
        F.coalesce(F.min("l.Ingestion_Status"), F.lit(FAILED)).alias("Last_Ingestion_Status")
    )


def high_water_marks(log: DataFrame, primary: DataFrame, phase: str = "Batch") -> DataFrame:
    """Mark per table and datastore: that of the latest processed run, or the type's default.

    ``max_by`` on the end time combines before the shuffle. A run logged as
    ``FULL_RELOAD`` becomes the type's reload mark.
    """
    kinds = config_values(primary, {"kind": ("watermark_details", "data_type")})
    done = log.filter((F.col("Processing_Phase") == phase) & (F.col("Ingestion_Status") == PROCESSED))
    last = done.groupBy("Table_ID", F.lower("Target_Datastore").alias("Target_Datastore")).agg(
        F.max_by("Watermark_Value", F.struct(F.coalesce("Ingestion_End_Time", F.lit("0001-01-01").cast("timestamp")), "Log_ID")).alias("mark"),
        F.count(F.lit(1)).alias("matched_records"),
    )
    everything = log.select("Table_ID", F.lower("Target_Datastore").alias("Target_Datastore")).distinct()
    joined = everything.join(last, ["Table_ID", "Target_Datastore"], "left").join(kinds, "Table_ID", "left")
    dated = F.coalesce("kind", F.lit("datetime")) == "datetime"
    pick = lambda marks: F.when(dated, F.lit(marks["datetime"])).otherwise(F.lit(marks["numeric"]))
    numeric_text = F.col("mark").rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$")
    dated_mark = F.when(numeric_text, F.col("mark")).otherwise(F.col("mark").try_cast("timestamp").cast("string"))
    known = F.when(F.col("mark") == FULL_RELOAD, pick(RELOAD_MARKS)).when(dated, dated_mark).otherwise(F.col("mark"))
    value = F.when(F.coalesce(known, F.lit("")) == "", pick(FIRST_MARKS)).otherwise(known)
    return joined.select(
        "Table_ID", "Target_Datastore", value.alias("watermark_value"),
        F.coalesce("matched_records", F.lit(0)).alias("matched_records"),
        F.when(known.isin(*RELOAD_MARKS.values()), F.lit("Yes")).alias("full_reload"),
    )


def in_flight(log: DataFrame, now: Column) -> DataFrame:
    """Tables with a staging run of the last 24 hours that only ever started, and its log ids."""
    stuck = log.filter("Processing_Phase = 'Staging'").groupBy("Table_ID", "Log_ID").agg(
        F.min("Ingestion_Status").alias("s")
    ).filter(F.col("s") == STARTED)
    recent = log.filter(F.col("Ingestion_Start_Time") > now - F.expr("interval 24 hours"))
    blocking = recent.join(stuck.select("Table_ID", "Log_ID"), ["Table_ID", "Log_ID"], "left_semi")
    return blocking.groupBy("Table_ID").agg(
        F.array_join(F.array_sort(F.collect_set("Log_ID")), ", ").alias("blocking_log_ids")
    )


def assert_not_in_flight(log: DataFrame, table_id: int, now: Column) -> None:
    found = in_flight(log.filter(F.col("Table_ID") == table_id), now).first()
    if found:
        raise SpecError(f"another run of table {table_id} is in progress or was interrupted: {found['blocking_log_ids']}")


def steps_as_json(advanced: DataFrame, category: str) -> DataFrame:
    """Each configured step of a table as one JSON object, in order."""
    chosen = advanced.filter(F.col("Configuration_Category") == category)
    keys = ["Table_ID", "Configuration_Name", "Configuration_Name_Instance_Number"]
    return attributes_to_json(
        chosen, keys, "Configuration_Attribute_Name", "Configuration_Attribute_Value",
        {"Category": F.col("Configuration_Name")},
    )


def find_datastore(datastores: DataFrame, name: str) -> DataFrame:
    """The datastore of that name (any case), or an error naming the valid ones."""
    hit = datastores.filter(F.lower("Datastore_Name") == name.lower())
    if hit.isEmpty():
        known = [r[0] for r in datastores.select("Datastore_Name").distinct().orderBy("Datastore_Name").collect()]
        raise SpecError(f"datastore '{name}' not found; available: {', '.join(known) or '(none)'}")
    return hit


def due_for_profiling(
    orchestration: DataFrame, primary: DataFrame, profiles: DataFrame, trigger: str, now: Column
) -> DataFrame:
    """Tables whose profile is older than their frequency allows, or that have none."""
    frequency = F.trim(F.lower(F.coalesce("freq", F.lit("weekly"))))
    last = profiles.groupBy("Table_ID").agg(F.max("Data_Profile_Execution_Time").alias("Last_Run_Datetime"))
    settings = primary.filter("Configuration_Name = 'data_profiling_frequency'").groupBy("Table_ID").agg(
        F.max("Configuration_Value").alias("freq")
    )
    tables = orchestration.filter(
        (F.col("Trigger_Name") == trigger) & (F.col("Ingestion_Active") == 1) & ~F.col("Target_Entity").contains("/")
    )
    age = F.datediff(now, F.col("Last_Run_Datetime"))
    joined = tables.join(settings, "Table_ID", "left").join(last, "Table_ID", "left").select(
        "Table_ID", "Target_Datastore", "Target_Entity", frequency.alias("Data_Profiling_Frequency"),
        "Last_Run_Datetime", age.alias("Days_Since_Last_Run"),
    )
    every = F.expr("CASE Data_Profiling_Frequency WHEN 'monthly' THEN 30 WHEN 'weekly' THEN 7 WHEN 'daily' THEN 1 END")
    due = (F.col("Days_Since_Last_Run") >= every) | F.col("Last_Run_Datetime").isNull()
    return joined.filter((F.col("Data_Profiling_Frequency") != "never") & due)


def latest_schemas(schema_log: DataFrame) -> DataFrame:
    """The newest schema record of each table."""
    newest = F.max_by(F.struct("Schema_ID", "Schema_Details", "Schema_Arrival_Time"), "Schema_Arrival_Time")
    return schema_log.groupBy("Table_ID").agg(newest.alias("s")).select("Table_ID", "s.*")


def log_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """Records as typed log rows; absent fields are null."""
    fields = [part.split()[0] for part in ddl.split(",")]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], ddl)


def date_key(at: datetime) -> int:
    return int(at.strftime("%Y%m%d"))


def reset_mark(spark: SparkSession, table_id: int, datastore: str, at: datetime, log_id: str) -> DataFrame:
    """A log row after which the next run reads everything again."""
    row = {
        "Log_ID": log_id, "Table_ID": table_id, "Target_Datastore": datastore, "Ingestion_Start_Time": at,
        "Ingestion_End_Time": at, "Ingestion_Status": PROCESSED, "Processing_Phase": "Batch",
        "Watermark_Value": FULL_RELOAD, "Date_Key": date_key(at),
    }
    return log_rows(spark, [row], RUN_LOG)


def notifications(results: DataFrame, column: str = "results") -> DataFrame:
    """Quality results logged as JSON to one row per result."""
    return rows_from_json(
        results, column,
        "outcome string, category string, message string, quarantined string, rows_impacted bigint, rows_quarantined bigint",
    )


def activity_rows(messages: DataFrame, column: str = "entries") -> DataFrame:
    """Log entries kept as a JSON array to activity rows."""
    return rows_from_json(
        messages, column, "sequence int, at timestamp, level string, step string, step_number int, message string"
    )


def upsert_datastores(current: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(current, changes, ["Datastore_Name"])


def lineage_label(source_datastore: str | None, source: str | None, target_datastore: str, target: str) -> dict[str, str]:
    """Layer and type labels that a run log row carries for its source and target."""
    def layer(name: str | None) -> str:
        low = (name or "").lower()
        return next((x.title() for x in ("bronze", "silver", "gold") if x in low), "External")

    def kind(entity: str | None) -> str:
        return "File" if entity and "/" in entity else "Table"

    return {
        "Source_Medallion_Layer": layer(source_datastore), "Source_Type": kind(source),
        "Target_Medallion_Layer": layer(target_datastore), "Target_Type": kind(target),
    }


def config_conflicts(settings: DataFrame) -> DataFrame:
    """Settings that contradict each other, one row per broken rule.

    ``settings`` comes from ``config_map``.
    """
    setting = lambda k: F.lower(F.trim(F.coalesce(F.col("settings")[k], F.lit(""))))
    has = lambda k: setting(k) != ""
    source = lambda k: has(f"source_details_{k}")
    own_table, own_file, own_source = (source(f"custom_{k}_function") for k in ("table_ingestion", "file_ingestion", "source"))
    staging, wildcard = source("staging_folder_path"), source("wildcard_folder_path")
    feed = setting("watermark_details_use_change_data_feed") == "true"
    delete, merge = has("target_details_column_to_mark_source_data_deletion"), setting("target_details_merge_type")
    value = has("target_details_delete_rows_with_value")
    rules = {
        "table_name with a custom ingestion function": source("table_name") & (own_table | own_file | own_source),
        "staging folder with wildcard folder": staging & wildcard,
        "staging folder with custom table function": staging & own_table,
        "custom source function with a folder": own_source & (staging | wildcard),
        "custom source with custom table function": own_source & own_table,
        "change feed with a delete column": feed & delete,
        "change feed with a mark column": feed & has("watermark_details_column_name"),
        "merge type ignores the delete column": (merge != "") & ~merge.isin(*DELETE_AWARE) & (delete | value),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in rules.items()]))
    return settings.select("Table_ID", F.explode(broken).alias("conflict"))
