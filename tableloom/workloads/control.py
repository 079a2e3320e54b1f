"""Queries of the control tables, the run log, monitoring and lineage.

Control and log rows are derived from the test tables: an event is a log row,
a supplier an orchestrated table, a part a configured step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import nested, profile as profiles, schema as schemas
from tableloom.plans import control, lineage, monitor
from tableloom.workloads.registry import query


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


_LOG = """log AS (SELECT CAST(event_id // 2 AS VARCHAR) AS Log_ID, CAST(user_id % 40 AS INTEGER) AS Table_ID,
  CASE WHEN event_id % 3 = 0 THEN 'Silver' ELSE 'silver' END AS Target_Datastore, ts AS Ingestion_Start_Time,
  ts + to_seconds(CAST(floor(value) AS INTEGER)) AS Ingestion_End_Time,
  CASE WHEN event_id % 2 = 0 THEN 'Started' WHEN event_type = 'error' THEN 'Failed' WHEN event_type = 'signup' THEN 'Started' ELSE 'Processed' END AS Ingestion_Status,
  CASE WHEN user_id % 5 = 0 THEN 'Staging' ELSE 'Batch' END AS Processing_Phase,
  CASE WHEN event_id % 17 = 0 THEN 'FULL_RELOAD' WHEN user_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS Watermark_Value,
  CAST(floor(value * 10) AS BIGINT) AS Records_Processed, event_id % 4 AS Quarantined_Records,
  'trigger' || (user_id % 6) AS Trigger_Name, CAST(event_id // 50 AS VARCHAR) AS Trigger_Execution_ID,
  date_trunc('day', ts) AS Trigger_Execution_Start_Time FROM events)"""


def log(t) -> DataFrame:
    status = "CASE WHEN event_id % 2 = 0 THEN 'Started' WHEN event_type = 'error' THEN 'Failed' WHEN event_type = 'signup' THEN 'Started' ELSE 'Processed' END"
    mark = "CASE WHEN event_id % 17 = 0 THEN 'FULL_RELOAD' WHEN user_id % 3 = 0 THEN cast(event_id AS string) ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"
    return t.events.selectExpr(
        "cast(event_id div 2 AS string) AS Log_ID", "cast(user_id % 40 AS int) AS Table_ID",
        "CASE WHEN event_id % 3 = 0 THEN 'Silver' ELSE 'silver' END AS Target_Datastore", "cast(ts AS timestamp) AS Ingestion_Start_Time",
        "cast(ts AS timestamp) + make_dt_interval(0, 0, 0, floor(value)) AS Ingestion_End_Time", f"{status} AS Ingestion_Status",
        "CASE WHEN user_id % 5 = 0 THEN 'Staging' ELSE 'Batch' END AS Processing_Phase", f"{mark} AS Watermark_Value",
        "cast(floor(value * 10) AS bigint) AS Records_Processed", "event_id % 4 AS Quarantined_Records",
        "concat('trigger', user_id % 6) AS Trigger_Name", "cast(event_id div 50 AS string) AS Trigger_Execution_ID",
        "date_trunc('day', cast(ts AS timestamp)) AS Trigger_Execution_Start_Time",
    )


_NOTES = """notes AS (SELECT CAST(event_id // 2 AS VARCHAR) AS Log_ID, CAST(user_id % 40 AS INTEGER) AS Table_ID, event_type AS Data_Quality_Category,
  CASE WHEN event_id % 5 = 0 THEN 'Failure' WHEN event_id % 5 < 3 THEN 'Warning' ELSE 'Pass' END AS Data_Quality_Result,
  user_id AS Rows_Impacted, event_id % 7 AS Rows_Quarantined, ts AS Ingestion_End_Time FROM events)"""


def notes(t) -> DataFrame:
    return t.events.selectExpr(
        "cast(event_id div 2 AS string) AS Log_ID", "cast(user_id % 40 AS int) AS Table_ID", "event_type AS Data_Quality_Category",
        "CASE WHEN event_id % 5 = 0 THEN 'Failure' WHEN event_id % 5 < 3 THEN 'Warning' ELSE 'Pass' END AS Data_Quality_Result",
        "user_id AS Rows_Impacted", "event_id % 7 AS Rows_Quarantined", "cast(ts AS timestamp) AS Ingestion_End_Time",
    )


# Orchestrated tables from suppliers: table k reads table k / 3, and joins table k / 2.
_ORC = """orc AS (SELECT CAST(s_suppkey AS INTEGER) AS Table_ID, 'trigger' || (s_suppkey % 4) AS Trigger_Name, CAST(s_suppkey % 5 AS INTEGER) AS Order_Of_Operations,
  CASE WHEN s_suppkey % 2 = 0 THEN 'silver' ELSE 'gold' END AS Target_Datastore, CASE WHEN s_suppkey % 19 = 0 THEN 'out/t' ELSE 't' END || s_suppkey AS Target_Entity,
  'batch' AS Processing_Method, CASE WHEN s_suppkey % 11 = 0 THEN 0 ELSE 1 END AS Ingestion_Active FROM supplier)"""
_PRIMARY = """prim AS (SELECT CAST(s_suppkey AS INTEGER) AS Table_ID, unnest(['source_details', 'watermark_details', 'other_settings', 'source_details']) AS Configuration_Category,
  unnest(['datastore_name', 'data_type', 'data_profiling_frequency', 'table_name']) AS Configuration_Name,
  unnest(['ds' || s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN 'numeric' ELSE 'datetime' END,
    list_value('Daily', 'weekly', 'monthly', 'never')[CAST(s_suppkey % 4 AS INTEGER) + 1],
    CASE WHEN s_suppkey < 3 THEN 'landing.raw' ELSE CASE WHEN (s_suppkey // 3) % 2 = 0 THEN 'silver' ELSE 'gold' END || '.t' || (s_suppkey // 3) END]) AS Configuration_Value FROM supplier)"""


def orchestration(t) -> DataFrame:
    return t.supplier.selectExpr(
        "cast(s_suppkey AS int) AS Table_ID", "concat('trigger', s_suppkey % 4) AS Trigger_Name", "cast(s_suppkey % 5 AS int) AS Order_Of_Operations",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'silver' ELSE 'gold' END AS Target_Datastore",
        "concat(CASE WHEN s_suppkey % 19 = 0 THEN 'out/t' ELSE 't' END, s_suppkey) AS Target_Entity", "'batch' AS Processing_Method",
        "CASE WHEN s_suppkey % 11 = 0 THEN 0 ELSE 1 END AS Ingestion_Active",
    )


def _rows_of(names: list[str], rows: list[list[str]]) -> str:
    """SQL that unfolds one row into ``rows`` of expressions."""
    made = ["named_struct(" + ", ".join(f"'{n}', {e}" for n, e in zip(names, row)) + ")" for row in rows]
    return f"inline(array({', '.join(made)}))"


SETTING = ["Configuration_Category", "Configuration_Name", "Configuration_Value"]
ATTRIBUTE = ["Configuration_Name", "Configuration_Name_Instance_Number", "Configuration_Attribute_Name", "Configuration_Attribute_Value"]


def primary(t) -> DataFrame:
    layer = "CASE WHEN (s_suppkey div 3) % 2 = 0 THEN 'silver' ELSE 'gold' END"
    return t.supplier.selectExpr("cast(s_suppkey AS int) AS Table_ID", _rows_of(SETTING, [
        ["'source_details'", "'datastore_name'", "concat('ds', s_nationkey)"],
        ["'watermark_details'", "'data_type'", "CASE WHEN s_suppkey % 3 = 0 THEN 'numeric' ELSE 'datetime' END"],
        ["'other_settings'", "'data_profiling_frequency'", "element_at(array('Daily', 'weekly', 'monthly', 'never'), cast(s_suppkey % 4 + 1 AS int))"],
        ["'source_details'", "'table_name'", f"CASE WHEN s_suppkey < 3 THEN 'landing.raw' ELSE concat({layer}, '.t', s_suppkey div 3) END"],
    ]))


def advanced(t) -> DataFrame:
    """Two configured steps per table: a join with another table and a filter."""
    other = "concat(CASE WHEN (s_suppkey div 2) % 2 = 0 THEN 'silver' ELSE 'gold' END, '.t', s_suppkey div 2)"
    return t.supplier.selectExpr("cast(s_suppkey AS int) AS Table_ID", "'data_transformation_steps' AS Configuration_Category", _rows_of(ATTRIBUTE, [
        ["'join_data'", "1", "'right_table_name'", other],
        ["'join_data'", "1", "'join_condition'", "'a.k = b.k'"],
        ["'filter_data'", "2", "'filter_logic'", "concat('k > ', s_nationkey)"],
    ]))


@query("run_log_last_status", f"""
WITH {_LOG}, latest AS (SELECT Table_ID, max(Trigger_Execution_Start_Time) AS t FROM log GROUP BY 1)
SELECT l.Table_ID, coalesce((SELECT min(Ingestion_Status) FROM log WHERE log.Table_ID = l.Table_ID AND log.Trigger_Execution_Start_Time = l.t
  AND Processing_Phase = 'Batch'), 'Failed') AS Last_Ingestion_Status FROM latest l
""")
def run_log_last_status(t):
    return control.last_status(log(t))


@query("watermark_value", f"""
WITH {_LOG}, {_PRIMARY}, kind AS (SELECT Table_ID, Configuration_Value AS k FROM prim WHERE Configuration_Name = 'data_type'),
done AS (SELECT *, lower(Target_Datastore) AS d FROM log WHERE Processing_Phase = 'Batch' AND Ingestion_Status = 'Processed'),
last AS (SELECT Table_ID, d, Watermark_Value AS m, count(*) OVER (PARTITION BY Table_ID, d) AS n FROM done
  QUALIFY row_number() OVER (PARTITION BY Table_ID, d ORDER BY Ingestion_End_Time DESC, Log_ID DESC) = 1),
v AS (SELECT a.Table_ID, a.d, m, n, coalesce(k, 'datetime') AS k FROM (SELECT DISTINCT Table_ID, lower(Target_Datastore) AS d FROM log) a
  LEFT JOIN last USING (Table_ID, d) LEFT JOIN kind USING (Table_ID)),
w AS (SELECT *, CASE WHEN m = 'FULL_RELOAD' THEN CASE k WHEN 'datetime' THEN '1900-01-01 14:44:44' ELSE '-2' END ELSE m END AS x FROM v)
SELECT Table_ID, d AS Target_Datastore, coalesce(x, CASE k WHEN 'datetime' THEN '1900-01-01 00:00:00' ELSE '-1' END) AS watermark_value,
  coalesce(n, 0) AS matched_records, CASE WHEN x IN ('1900-01-01 14:44:44', '-2') THEN 'Yes' END AS full_reload FROM w
""")
def watermark_value(t):
    return control.high_water_marks(log(t), primary(t))


@query("in_flight", f"""
WITH {_LOG}, stuck AS (SELECT Table_ID, Log_ID FROM log WHERE Processing_Phase = 'Staging' GROUP BY ALL HAVING min(Ingestion_Status) = 'Started')
SELECT Table_ID, string_agg(DISTINCT Log_ID, ', ' ORDER BY Log_ID) AS blocking_log_ids FROM log SEMI JOIN stuck USING (Table_ID, Log_ID)
WHERE Ingestion_Start_Time > TIMESTAMP '2024-01-30' GROUP BY Table_ID
""")
def in_flight(t):
    return control.in_flight(log(t), now())


@query("trigger_tables", f"""
WITH {_ORC} SELECT Trigger_Name, Order_Of_Operations,
  string_agg(concat_ws(':', CAST(Table_ID AS VARCHAR), Processing_Method, Target_Datastore, Target_Entity, 'ds' || s_nationkey, '', ''), ',' ORDER BY Table_ID) AS Pipeline_Table_Details
FROM orc JOIN supplier ON s_suppkey = Table_ID WHERE Trigger_Name = 'trigger2' AND Order_Of_Operations >= 1 AND Ingestion_Active = 1 GROUP BY 1, 2
""")
def trigger_tables(t):
    return control.trigger_tables(orchestration(t), primary(t), "trigger2", 1)


@query("due_profiling", f"""
WITH {_ORC}, {_PRIMARY}, last AS (SELECT CAST(user_id AS INTEGER) AS Table_ID, max(ts) AS t FROM events WHERE user_id % 2 = 0 GROUP BY 1),
j AS (SELECT orc.Table_ID, Target_Datastore, Target_Entity, lower(Configuration_Value) AS f, CAST(date_diff('day', CAST(t AS DATE), DATE '2024-01-31') AS INTEGER) AS n
  FROM orc JOIN prim ON prim.Table_ID = orc.Table_ID AND Configuration_Name = 'data_profiling_frequency' LEFT JOIN last ON last.Table_ID = orc.Table_ID
  WHERE Trigger_Name = 'trigger1' AND Ingestion_Active = 1 AND Target_Entity NOT LIKE '%/%')
SELECT Table_ID, Target_Datastore, Target_Entity, f AS Data_Profiling_Frequency, n AS Days_Since_Last_Run FROM j
WHERE f <> 'never' AND (n IS NULL OR n >= CASE f WHEN 'monthly' THEN 30 WHEN 'weekly' THEN 7 WHEN 'daily' THEN 1 END)
""")
def due_profiling(t):
    taken = t.events.filter("user_id % 2 = 0").selectExpr("cast(user_id AS int) AS Table_ID", "cast(ts AS timestamp) AS Data_Profile_Execution_Time")
    return control.due_for_profiling(orchestration(t), primary(t), taken, "trigger1", now()).drop("Last_Run_Datetime")


@query("config_as_columns", f"""
WITH {_PRIMARY} SELECT Table_ID, max(Configuration_Value) FILTER (Configuration_Name = 'datastore_name') AS store,
  max(Configuration_Value) FILTER (Configuration_Name = 'data_type') AS kind FROM prim GROUP BY Table_ID
""")
def config_as_columns(t):
    return control.config_values(primary(t), {"store": ("source_details", "datastore_name"), "kind": ("watermark_details", "data_type")})


@query("config_conflicts", f"""
WITH {_PRIMARY} SELECT Table_ID, 'change feed with a mark column' AS conflict FROM prim WHERE Configuration_Name = 'datastore_name' AND Table_ID % 7 = 0
""")
def config_conflicts(t):
    feed = t.supplier.filter("s_suppkey % 7 = 0").selectExpr("cast(s_suppkey AS int) AS Table_ID", _rows_of(SETTING, [
        ["'watermark_details'", "'use_change_data_feed'", "'true'"], ["'watermark_details'", "'column_name'", "'ts'"],
    ]))
    return control.config_conflicts(control.config_map(primary(t).unionByName(feed)))


@query("steps_as_json", """
SELECT CAST(s_suppkey AS INTEGER) AS Table_ID, 'filter_data' AS Configuration_Name, 2 AS Configuration_Name_Instance_Number,
  '{"Category":"filter_data","filter_logic":"k > ' || s_nationkey || '"}' AS step_json FROM supplier
""")
def steps_as_json(t):
    return control.steps_as_json(advanced(t), "data_transformation_steps").filter("Configuration_Name = 'filter_data'")


@query("latest_schemas", """
SELECT CAST(user_id AS INTEGER) AS Table_ID, arg_max(event_type, event_id) AS Schema_ID, arg_max(props, event_id) AS Schema_Details FROM events GROUP BY user_id
""")
def latest_schemas(t):
    logged = t.events.selectExpr("cast(user_id AS int) AS Table_ID", "event_type AS Schema_ID", "props AS Schema_Details",
                                 "timestamp_seconds(event_id) AS Schema_Arrival_Time")
    return control.latest_schemas(logged).drop("Schema_Arrival_Time")


@query("schema_log_changes", """
SELECT event_id, 'Column Added' AS Change_Type, 'c' || user_id AS Column_Name, event_type AS Data_Type_Details FROM events
""")
def schema_log_changes(t):
    entry = F.struct(F.lit("Column Added").alias("Change_Type"), F.concat(F.lit("c"), "user_id").alias("Column_Name"), F.col("event_type").alias("Data_Type_Details"))
    packed = t.events.select("event_id", F.to_json(F.array(entry)).alias("changes"))
    return nested.rows_from_json(packed, "changes", schemas.CHANGE_DDL)


@query("quality_notifications", """
SELECT event_id, 'Warning' AS outcome, event_type AS category, 'bad' AS message, 'No' AS quarantined, user_id AS rows_impacted, CAST(NULL AS BIGINT) AS rows_quarantined
FROM events
""")
def quality_notifications(t):
    entry = F.struct(F.lit("Warning").alias("outcome"), F.col("event_type").alias("category"), F.lit("bad").alias("message"),
                     F.lit("No").alias("quarantined"), F.col("user_id").alias("rows_impacted"))
    return control.notifications(t.events.select("event_id", F.to_json(F.array(entry)).alias("results")))


@query("upsert_datastores", """
SELECT n_name AS "Datastore_Name", CASE WHEN n_regionkey = 2 THEN 'lake' ELSE 'warehouse' END AS "Datastore_Kind" FROM nation
""")
def upsert_datastores(t):
    old = t.nation.select(F.col("n_name").alias("Datastore_Name"), F.lit("warehouse").alias("Datastore_Kind"))
    new = t.nation.filter("n_regionkey = 2").select(F.col("n_name").alias("Datastore_Name"), F.lit("lake").alias("Datastore_Kind"))
    return control.upsert_datastores(old, new)


_SECONDS = "floor(epoch_us(Ingestion_End_Time) - epoch_us(Ingestion_Start_Time)) / 1e6"


@query("mon_run_performance", f"""
WITH {_LOG} SELECT Table_ID, Processing_Phase, count(*) AS Runs, round(avg({_SECONDS}), 3) AS Avg_Seconds, min({_SECONDS}) AS Min_Seconds,
  max({_SECONDS}) AS Max_Seconds, round(quantile_cont({_SECONDS}, 0.5), 3) AS Median_Seconds, round(quantile_cont({_SECONDS}, 0.95), 3) AS P95_Seconds,
  CAST(sum(Records_Processed) AS BIGINT) AS Records_Processed FROM log WHERE Ingestion_Status = 'Processed' GROUP BY 1, 2
""")
def mon_run_performance(t):
    return monitor.run_performance(log(t))


@query("mon_volume_trend", f"""
WITH {_LOG} SELECT Table_ID, CAST(Ingestion_End_Time AS DATE) AS Day, CAST(sum(Records_Processed) AS BIGINT) AS Processed,
  CAST(sum(Quarantined_Records) AS BIGINT) AS Quarantined, count(*) AS Runs FROM log WHERE Ingestion_Status = 'Processed' GROUP BY 1, 2
""")
def mon_volume_trend(t):
    return monitor.volume_trend(log(t))


@query("mon_trigger_reliability", f"""
WITH {_LOG} SELECT Trigger_Name, count(*) AS Runs, count(*) FILTER (Ingestion_Status = 'Failed') AS Failed_Runs,
  round(count(*) FILTER (Ingestion_Status = 'Failed') * 100.0 / count(*), 2) AS Failure_Percent FROM log WHERE Ingestion_Status <> 'Started' GROUP BY 1
""")
def mon_trigger_reliability(t):
    return monitor.trigger_reliability(log(t))


_NOW = "(SELECT max(Ingestion_End_Time) FROM log)"


@query("mon_last_days", f"""
WITH {_LOG}, l AS (SELECT * FROM log WHERE epoch_us(Ingestion_End_Time) >= epoch_us({_NOW}) - 129600000000)
SELECT 'volume' AS question, CAST(Table_ID AS VARCHAR) AS name, count(*) AS Runs FROM l WHERE Ingestion_Status = 'Processed' GROUP BY 2
UNION ALL SELECT 'failed', Trigger_Name, count(*) FILTER (Ingestion_Status = 'Failed') FROM l WHERE Ingestion_Status <> 'Started' GROUP BY 2
""")
def mon_last_days(t):
    """Volume and reliability of the last day and a half before the newest run."""
    rows = log(t)
    now = rows.agg(F.max("Ingestion_End_Time")).scalar()
    volume = monitor.volume_trend(rows, now, 1.5).groupBy(F.col("Table_ID").cast("string").alias("name")).agg(F.sum("Runs").alias("Runs"))
    failed = monitor.trigger_reliability(rows, now, 1.5).select(F.col("Trigger_Name").alias("name"), F.col("Failed_Runs").alias("Runs"))
    return volume.select(F.lit("volume").alias("question"), "name", "Runs").unionByName(failed.withColumn("question", F.lit("failed")))


@query("mon_active_runs", f"WITH {_LOG} SELECT Log_ID, Table_ID FROM log GROUP BY 1, 2 HAVING count(*) FILTER (Ingestion_Status <> 'Started') = 0")
def mon_active_runs(t):
    return monitor.active_runs(log(t)).drop("Started_At")


@query("mon_stale_logs", f"""
WITH {_LOG} SELECT Log_ID, Table_ID, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(min(Ingestion_Start_Time))) / 3.6e9, 3) AS Open_Hours FROM log
GROUP BY 1, 2 HAVING count(*) FILTER (Ingestion_Status <> 'Started') = 0 AND min(Ingestion_Start_Time) < TIMESTAMP '2024-01-21'
""")
def mon_stale_logs(t):
    return monitor.stale_logs(log(t), now(), 240).drop("Started_At")


@query("mon_recent_failures", f"WITH {_LOG} SELECT Log_ID, Table_ID, Trigger_Name FROM log WHERE Ingestion_Status = 'Failed' AND Ingestion_Start_Time >= TIMESTAMP '2024-01-28'")
def mon_recent_failures(t):
    return monitor.recent_failures(log(t), now(), 72).select("Log_ID", "Table_ID", "Trigger_Name")


@query("mon_recent_runs", f"""
WITH {_LOG} SELECT Log_ID, Ingestion_Status, round({_SECONDS}, 3) AS Duration_Seconds FROM log WHERE Table_ID = 7 AND Ingestion_Start_Time >= TIMESTAMP '2024-01-01'
ORDER BY Ingestion_Start_Time DESC, Log_ID, Ingestion_Status LIMIT 20
""")
def mon_recent_runs(t):
    return monitor.recent_runs(log(t), 7, now(), top=20).select("Log_ID", "Ingestion_Status", "Duration_Seconds")


@query("mon_watermark_progress", f"""
WITH {_LOG}, d AS (SELECT * FROM log WHERE Table_ID = 7 AND Processing_Phase = 'Batch' AND Ingestion_Status = 'Processed' ORDER BY Ingestion_End_Time DESC, Log_ID DESC LIMIT 21)
SELECT Table_ID, Log_ID, Watermark_Value, lag(Watermark_Value) OVER (ORDER BY Ingestion_End_Time, Log_ID) AS Previous_Watermark FROM d
""")
def mon_watermark_progress(t):
    return monitor.mark_progress(log(t), 7, 20).drop("Ingestion_End_Time")


@query("mon_watermark_comparison", f"""
WITH {_LOG}, d AS (SELECT *, row_number() OVER (PARTITION BY Table_ID ORDER BY Ingestion_End_Time, Log_ID) AS a,
  row_number() OVER (PARTITION BY Table_ID ORDER BY Ingestion_End_Time DESC, Log_ID DESC) AS z FROM log WHERE Processing_Phase = 'Batch' AND Ingestion_Status = 'Processed')
SELECT Table_ID, max(Watermark_Value) FILTER (a = 1) AS First_Watermark, max(Watermark_Value) FILTER (z = 1) AS Latest_Watermark, count(*) AS Runs FROM d GROUP BY 1
""")
def mon_watermark_comparison(t):
    return monitor.mark_comparison(log(t))


_PER_RUN = """per AS (SELECT Log_ID, count(*) FILTER (Data_Quality_Result = 'Warning') AS Warnings, count(*) FILTER (Data_Quality_Result = 'Failure') AS Failures,
  CAST(sum(Rows_Quarantined) AS BIGINT) AS Rows_Quarantined FROM notes GROUP BY 1)"""


@query("mon_runs_with_dq", f"""
WITH {_LOG}, {_NOTES}, {_PER_RUN} SELECT Log_ID, Table_ID, Ingestion_Status, coalesce(Warnings, 0) AS Warnings, coalesce(Failures, 0) AS Failures,
  coalesce(Rows_Quarantined, 0) AS Rows_Quarantined FROM log LEFT JOIN per USING (Log_ID) WHERE Ingestion_Status <> 'Started' AND Trigger_Execution_ID = '12'
""")
def mon_runs_with_dq(t):
    out = monitor.runs_with_quality(monitor.runs_of_execution(log(t), "12"), notes(t))
    return out.select("Log_ID", "Table_ID", "Ingestion_Status", "Warnings", "Failures", "Rows_Quarantined")


@query("mon_latest_run_with_dq", f"""
WITH {_LOG}, {_NOTES}, {_PER_RUN}, r AS (SELECT * FROM log WHERE Ingestion_Status <> 'Started'
  QUALIFY row_number() OVER (PARTITION BY Table_ID ORDER BY Ingestion_End_Time DESC, Log_ID DESC) = 1)
SELECT Log_ID, Table_ID, coalesce(Warnings, 0) AS Warnings, coalesce(Failures, 0) AS Failures FROM r LEFT JOIN per USING (Log_ID)
""")
def mon_latest_run_with_dq(t):
    return monitor.latest_run_with_quality(log(t), notes(t)).select("Log_ID", "Table_ID", "Warnings", "Failures")


@query("mon_dq_breakdown", f"""
WITH {_NOTES} SELECT Table_ID, Data_Quality_Category, Data_Quality_Result, count(*) AS Results, CAST(sum(Rows_Impacted) AS BIGINT) AS Rows_Impacted,
  CAST(sum(Rows_Quarantined) AS BIGINT) AS Rows_Quarantined FROM notes GROUP BY 1, 2, 3
""")
def mon_dq_breakdown(t):
    return monitor.dq_breakdown(notes(t))


@query("mon_dq_trend", f"""
WITH {_NOTES} SELECT Table_ID, CAST(Ingestion_End_Time AS DATE) AS Day, count(*) FILTER (Data_Quality_Result = 'Warning') AS Warnings,
  count(*) FILTER (Data_Quality_Result = 'Failure') AS Failures FROM notes GROUP BY 1, 2
""")
def mon_dq_trend(t):
    return monitor.dq_trend(notes(t))


@query("mon_dq_overview", f"""
WITH {_NOTES} SELECT Table_ID, count(*) FILTER (Data_Quality_Result <> 'Pass') AS Problems, count(*) AS Results FROM notes GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20
""")
def mon_dq_overview(t):
    return monitor.dq_overview(notes(t), 20)


@query("mon_latest_profile", """
SELECT CAST(user_id AS INTEGER) AS Table_ID, event_type AS Column_Name, arg_max(value, event_id) AS Mean FROM events GROUP BY 1, 2
""")
def mon_latest_profile(t):
    rows = t.events.selectExpr("cast(user_id AS int) AS Table_ID", "event_type AS Column_Name", "value AS Mean", "timestamp_seconds(event_id) AS Data_Profile_Execution_Time")
    return monitor.latest_profile(rows).drop("Data_Profile_Execution_Time")


@query("mon_trigger_overview", f"""
WITH {_ORC} SELECT Trigger_Name, count(DISTINCT Order_Of_Operations) AS Steps, count(*) AS Tables, count(*) FILTER (Ingestion_Active = 1) AS Active_Tables FROM orc GROUP BY 1
""")
def mon_trigger_overview(t):
    return monitor.trigger_overview(orchestration(t))


@query("mon_config_and_status", f"""
WITH {_ORC}, {_LOG}, latest AS (SELECT Table_ID, max(Trigger_Execution_Start_Time) AS t FROM log GROUP BY 1),
s AS (SELECT l.Table_ID, min(Ingestion_Status) AS st FROM latest l JOIN log ON log.Table_ID = l.Table_ID AND log.Trigger_Execution_Start_Time = l.t AND Processing_Phase = 'Batch' GROUP BY 1)
SELECT orc.Table_ID, Target_Entity, 'ds' || s_nationkey AS store, coalesce(st, 'Failed') AS Last_Ingestion_Status
FROM orc JOIN supplier ON s_suppkey = orc.Table_ID LEFT JOIN s ON s.Table_ID = orc.Table_ID
""")
def mon_config_and_status(t):
    out = monitor.config_and_status(orchestration(t), primary(t), log(t))
    return out.select("Table_ID", "Target_Entity", F.col("settings")["source_details_datastore_name"].alias("store"), "Last_Ingestion_Status")


@query("mon_activity_by_execution", """
SELECT CAST(event_id // 2 AS VARCHAR) AS Log_ID, CAST(event_id AS INTEGER) AS Sequence_Number, event_type AS Message FROM events WHERE event_id // 50 = 12
""")
def mon_activity_by_execution(t):
    entries = t.events.selectExpr("cast(event_id div 2 AS string) AS Log_ID", "cast(event_id AS int) AS Sequence_Number", "event_type AS Message")
    return monitor.activity(entries, log(t), Trigger_Execution_ID="12")


_EDGES = """edges AS (
  SELECT CASE WHEN s_suppkey < 3 THEN 'landing.raw' ELSE CASE WHEN (s_suppkey // 3) % 2 = 0 THEN 'silver' ELSE 'gold' END || '.' ||
      CASE WHEN 0 THEN '' ELSE 't' END || (s_suppkey // 3) END AS source, 'direct' AS relationship, s_suppkey AS k FROM supplier
  UNION ALL SELECT CASE WHEN (s_suppkey // 2) % 2 = 0 THEN 'silver' ELSE 'gold' END || '.t' || (s_suppkey // 2), 'join', s_suppkey FROM supplier)"""
_TARGET = "CASE WHEN k % 2 = 0 THEN 'silver' ELSE 'gold' END || CASE WHEN k % 19 = 0 THEN '.out/t' ELSE '.t' END || k"


@query("lineage_edges", f"""
WITH {_EDGES}, e AS (SELECT source, {_TARGET} AS target, relationship, 'trigger' || (k % 4) AS trg, CAST(k AS INTEGER) AS Table_ID FROM edges)
SELECT e.source, e.target, e.relationship, trg AS Trigger_Name, Table_ID, coalesce(m.trg2 <> trg, false) AS is_cross_trigger, coalesce(m.trg2, '') AS source_triggers
FROM e LEFT JOIN (SELECT DISTINCT {_TARGET} AS t, 'trigger' || (k % 4) AS trg2 FROM edges) m ON m.t = e.source
""")
def lineage_edges(t):
    return lineage.edges(orchestration(t), primary(t), advanced(t))


@query("lineage_depth", f"""
WITH RECURSIVE {_EDGES}, e AS (SELECT DISTINCT source, {_TARGET} AS target FROM edges), l AS (SELECT * FROM e WHERE source <> target),
walk AS (SELECT DISTINCT source AS node, 0 AS depth, source AS path FROM l WHERE source NOT IN (SELECT target FROM l)
  UNION ALL SELECT target, depth + 1, path || ' -> ' || target FROM walk JOIN l ON l.source = walk.node)
SELECT node, CAST(depth AS INTEGER) AS depth, path FROM walk QUALIFY row_number() OVER (PARTITION BY node ORDER BY depth DESC, path) = 1
""")
def lineage_depth(t):
    return lineage.depths(lineage.edges(orchestration(t), primary(t), advanced(t)))


@query("lineage_downstream", f"""
WITH RECURSIVE {_EDGES}, e AS (SELECT DISTINCT source, {_TARGET} AS target FROM edges WHERE source <> {_TARGET}),
walk AS (SELECT target AS node, 1 AS distance FROM e WHERE source = 'silver.t2' UNION SELECT e.target, distance + 1 FROM walk JOIN e ON e.source = walk.node)
SELECT node, CAST(min(distance) AS INTEGER) AS distance FROM walk GROUP BY 1
""")
def lineage_downstream(t):
    return lineage.downstream(lineage.edges(orchestration(t), primary(t), advanced(t)), "silver.t2")


@query("lineage_upstream", f"""
WITH RECURSIVE {_EDGES}, e AS (SELECT DISTINCT source, {_TARGET} AS target FROM edges WHERE source <> {_TARGET}),
walk AS (SELECT source AS node, 1 AS distance FROM e WHERE target = 'silver.t50' UNION SELECT e.source, distance + 1 FROM walk JOIN e ON e.target = walk.node)
SELECT node, CAST(min(distance) AS INTEGER) AS distance FROM walk GROUP BY 1
""")
def lineage_upstream(t):
    return lineage.upstream(lineage.edges(orchestration(t), primary(t), advanced(t)), "silver.t50")


@query("lineage_fingerprint", f"""
WITH {_EDGES}, e AS (SELECT DISTINCT source || '|' || relationship AS line, {_TARGET} AS target FROM edges)
SELECT target, md5(string_agg(line, ';' ORDER BY line)) AS fingerprint FROM e GROUP BY 1
""")
def lineage_fingerprint(t):
    return lineage.fingerprint(lineage.edges(orchestration(t), primary(t), advanced(t)))


def _profile_sql(table: str, columns: dict[str, str], total: int) -> str:
    lines = []
    for c, kind in columns.items():
        number = kind in ("int", "bigint", "double")
        lines.append(
            f"SELECT '{c}' AS \"Column_Name\", '{kind}' AS \"Data_Type\", count(*) AS \"Total_Rows\", {total} AS \"Total_Columns\", "
            f"count(DISTINCT {c}) AS \"Approx_Distinct_Values\", count(*) - count({c}) AS \"Null_Count\", "
            f"round((count(*) - count({c})) * 100.0 / count(*), 4) AS \"Null_Percent\", "
            + (f"round(avg(CAST({c} AS DOUBLE)), 4) AS \"Mean\", round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS \"Std_Dev\"" if number else "NULL AS \"Mean\", NULL AS \"Std_Dev\"")
            + f" FROM {table}"
        )
    return " UNION ALL ".join(lines)


_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query("profile_columns", _profile_sql("customer", _CUSTOMER, 5))
def profile_columns(t):
    return profiles.profile(t.customer, exact_distinct=True).drop("Min", "Max")


@query("profile_approximate")
def profile_approximate(t):
    return profiles.profile(t.orders)


@query("profile_compare", """
SELECT c AS "Column_Name", (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS "Old_Total_Rows", (SELECT count(*) FROM orders) AS "New_Total_Rows"
FROM (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS c)
""")
def profile_compare(t):
    old, new = profiles.profile(t.orders.filter("o_orderkey % 2 = 0")), profiles.profile(t.orders)
    return profiles.compare_profiles(old, new).select("Column_Name", "Old_Total_Rows", "New_Total_Rows")


@query("value_topn", """
WITH c AS (SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2)
SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank FROM c
QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) <= 5
""")
def value_topn(t):
    return profiles.top_values(t.orders, ["o_orderpriority", "o_custkey"], 5)


@query("profile_sample")
def profile_sample(t):
    return profiles.sample_rows(t.lineitem, 0.01)


@query("profile_freshness", """
SELECT strftime(max(ts), '%Y-%m-%d') AS newest, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9, 4) AS age_hours FROM events
""")
def profile_freshness(t):
    return profiles.freshness(t.events, "ts", now()).withColumn("newest", F.date_format("newest", "yyyy-MM-dd"))


@query("schema_diff", """
WITH o AS (SELECT 'c' || p_partkey AS c, lower(p_type) AS d FROM part WHERE p_partkey % 10 <> 0),
n AS (SELECT 'c' || p_partkey AS c, CASE WHEN p_partkey % 7 = 0 THEN 'string' ELSE lower(p_type) END AS d FROM part WHERE p_partkey % 11 <> 0)
SELECT CASE WHEN o.c IS NULL THEN 'Column Added' WHEN n.c IS NULL THEN 'Column Dropped' ELSE 'Column Type Changed' END AS "Change_Type", c AS "Column_Name",
  CASE WHEN o.c IS NULL THEN n.d WHEN n.c IS NULL THEN o.d ELSE o.d || ' --> ' || n.d END AS "Data_Type_Details"
FROM o FULL JOIN n USING (c) WHERE o.c IS NULL OR n.c IS NULL OR o.d <> n.d
""")
def schema_diff(t):
    """Two versions of a very wide schema, one column per part."""
    columns = t.part.selectExpr("concat('c', p_partkey) AS column_name", "lower(p_type) AS data_type", "p_partkey AS k")
    changed = columns.withColumn("data_type", F.expr("CASE WHEN k % 7 = 0 THEN 'string' ELSE data_type END"))
    return schemas.schema_diff(columns.filter("k % 10 <> 0"), changed.filter("k % 11 <> 0"))
