"""Monitoring questions over the run, quality, schema, profile and lineage tables.

Each is one filter, aggregate or join. Logs are append-only, so "latest" is a
``max_by`` that combines before the shuffle; status is read per log id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.plans.control import FAILED, PROCESSED, STARTED, config_map, last_status


def _since(df: DataFrame, column: str, now: Column, days: float | None) -> DataFrame:
    if days is None:
        return df
    return df.filter(F.unix_micros(F.col(column)) >= F.unix_micros(now) - F.lit(int(days * 86400 * 1_000_000)))


def _seconds() -> Column:
    micros = F.unix_micros("Ingestion_End_Time") - F.unix_micros("Ingestion_Start_Time")
    return F.round(micros / F.lit(1e6), 3)


def run_status(log: DataFrame, table_id: int | None = None, top: int | None = None) -> DataFrame:
    """Newest log rows, of one table or of all."""
    rows = log if table_id is None else log.filter(F.col("Table_ID") == table_id)
    return _first(rows.orderBy(F.desc("Ingestion_Start_Time"), "Log_ID", "Ingestion_Status"), top)


def _first(rows: DataFrame, top: int | None) -> DataFrame:
    return rows if top is None else rows.limit(top)


def recent_runs(log: DataFrame, table_id: int, now: Column, days: float = 30, top: int | None = None) -> DataFrame:
    rows = _since(log.filter(F.col("Table_ID") == table_id), "Ingestion_Start_Time", now, days)
    return run_status(rows.withColumn("Duration_Seconds", _seconds()), None, top)


def recent_failures(log: DataFrame, now: Column, hours: float = 24) -> DataFrame:
    return _since(log.filter(F.col("Ingestion_Status") == FAILED), "Ingestion_Start_Time", now, hours / 24)


def active_runs(log: DataFrame) -> DataFrame:
    """Runs whose log id has started but has no closing row."""
    per_run = log.groupBy("Log_ID", "Table_ID").agg(
        F.min("Ingestion_Start_Time").alias("Started_At"),
        F.bool_and(F.col("Ingestion_Status") == STARTED).alias("open"),
    )
    return per_run.filter("open").drop("open")


def stale_logs(log: DataFrame, now: Column, hours: float = 24) -> DataFrame:
    """Runs open for longer than ``hours``."""
    age = (F.unix_micros(now) - F.unix_micros("Started_At")) / F.lit(3.6e9)
    return active_runs(log).withColumn("Open_Hours", F.round(age, 3)).filter(age > hours)


def run_performance(log: DataFrame, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Duration per table and phase of finished runs; the percentiles are exact."""
    done = log.filter(F.col("Ingestion_Status") == PROCESSED)
    done = _since(done, "Ingestion_Start_Time", now, days) if now is not None else done
    s = _seconds()
    return done.groupBy("Table_ID", "Processing_Phase").agg(
        F.count(F.lit(1)).alias("Runs"), F.round(F.avg(s), 3).alias("Avg_Seconds"), F.min(s).alias("Min_Seconds"),
        F.max(s).alias("Max_Seconds"), F.round(F.percentile(s, 0.5), 3).alias("Median_Seconds"), F.round(F.percentile(s, 0.95), 3).alias("P95_Seconds"),
        F.sum("Records_Processed").alias("Records_Processed"),
    )


def volume_trend(log: DataFrame, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Rows processed and quarantined per table and day, of the last ``days`` before ``now`` if given."""
    done = log.filter(F.col("Ingestion_Status") == PROCESSED)
    done = _since(done, "Ingestion_End_Time", now, days) if now is not None else done
    return done.groupBy("Table_ID", F.to_date("Ingestion_End_Time").alias("Day")).agg(
        F.sum("Records_Processed").alias("Processed"), F.sum("Quarantined_Records").alias("Quarantined"),
        F.count(F.lit(1)).alias("Runs"),
    )


def mark_progress(log: DataFrame, table_id: int, top: int | None = None) -> DataFrame:
    """Marks of one table's batch runs, each beside the one before.

    With ``top`` the rows are cut to the newest ``top`` + 1 first, so the window is tiny.
    """
    done = log.filter(
        (F.col("Table_ID") == table_id) & (F.col("Processing_Phase") == "Batch") & (F.col("Ingestion_Status") == PROCESSED)
    )
    newest = _first(done.orderBy(F.desc("Ingestion_End_Time"), F.desc("Log_ID")), None if top is None else top + 1)
    order = Window.partitionBy("Table_ID").orderBy("Ingestion_End_Time", "Log_ID")
    rows = newest.withColumn("Previous_Watermark", F.lag("Watermark_Value").over(order))
    return rows.select("Table_ID", "Log_ID", "Ingestion_End_Time", "Watermark_Value", "Previous_Watermark")


def mark_comparison(log: DataFrame) -> DataFrame:
    """First and latest mark of every table."""
    done = log.filter((F.col("Processing_Phase") == "Batch") & (F.col("Ingestion_Status") == PROCESSED))
    at = F.struct("Ingestion_End_Time", "Log_ID")
    return done.groupBy("Table_ID").agg(
        F.min_by("Watermark_Value", at).alias("First_Watermark"), F.max_by("Watermark_Value", at).alias("Latest_Watermark"),
        F.count(F.lit(1)).alias("Runs"),
    )


def trigger_reliability(log: DataFrame, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Share of failed runs per trigger, among finished ones."""
    done = log.filter(F.col("Ingestion_Status").isin(PROCESSED, FAILED))
    done = _since(done, "Ingestion_End_Time", now, days) if now is not None else done
    failed = F.count_if(F.col("Ingestion_Status") == FAILED)
    return done.groupBy("Trigger_Name").agg(
        F.count(F.lit(1)).alias("Runs"), failed.alias("Failed_Runs"),
        F.round(failed * 100.0 / F.count(F.lit(1)), 2).alias("Failure_Percent"),
    )


def runs_of_execution(log: DataFrame, execution: str) -> DataFrame:
    return log.filter(F.col("Trigger_Execution_ID") == execution)


def runs_with_quality(log: DataFrame, notes: DataFrame) -> DataFrame:
    """Finished runs with their quality results, counted per run before the join."""
    per_run = notes.groupBy("Log_ID").agg(
        F.count_if(F.col("Data_Quality_Result") == "Warning").alias("Warnings"),
        F.count_if(F.col("Data_Quality_Result") == "Failure").alias("Failures"),
        F.coalesce(F.sum("Rows_Quarantined"), F.lit(0)).alias("Rows_Quarantined"),
    )
    runs = log.filter(F.col("Ingestion_Status") != STARTED)
    return runs.join(per_run, "Log_ID", "left").fillna(0, ["Warnings", "Failures", "Rows_Quarantined"])


def latest_run_with_quality(log: DataFrame, notes: DataFrame, by: str = "Table_ID") -> DataFrame:
    """Latest finished run per table, or all runs of the latest execution per trigger."""
    runs = log.filter(F.col("Ingestion_Status") != STARTED)
    if by == "Table_ID":
        newest = runs.groupBy("Table_ID").agg(F.max_by("Log_ID", F.struct("Ingestion_End_Time", "Log_ID")).alias("Log_ID"))
        chosen = runs.join(newest, ["Table_ID", "Log_ID"], "left_semi")
    else:
        newest = runs.groupBy("Trigger_Name").agg(
            F.max_by("Trigger_Execution_ID", F.struct("Trigger_Execution_Start_Time", "Trigger_Execution_ID")).alias("Trigger_Execution_ID")
        )
        chosen = runs.join(newest, ["Trigger_Name", "Trigger_Execution_ID"], "left_semi")
    return runs_with_quality(chosen, notes)


def dq_breakdown(notes: DataFrame, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Results per table, check and outcome."""
    notes = _since(notes, "Ingestion_End_Time", now, days) if now is not None else notes
    return notes.groupBy("Table_ID", "Data_Quality_Category", "Data_Quality_Result").agg(
        F.count(F.lit(1)).alias("Results"), F.sum("Rows_Impacted").alias("Rows_Impacted"),
        F.sum("Rows_Quarantined").alias("Rows_Quarantined"),
    )


def dq_trend(notes: DataFrame, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Warnings and failures per table and day."""
    notes = _since(notes, "Ingestion_End_Time", now, days) if now is not None else notes
    return notes.groupBy("Table_ID", F.to_date("Ingestion_End_Time").alias("Day")).agg(
        F.count_if(F.col("Data_Quality_Result") == "Warning").alias("Warnings"),
        F.count_if(F.col("Data_Quality_Result") == "Failure").alias("Failures"),
    )


def dq_overview(notes: DataFrame, top: int | None = None, now: Column | None = None, days: float | None = None) -> DataFrame:
    """Tables with most warnings and failures."""
    notes = _since(notes, "Ingestion_End_Time", now, days) if now is not None else notes
    bad = F.col("Data_Quality_Result").isin("Warning", "Failure")
    counted = notes.groupBy("Table_ID").agg(F.count_if(bad).alias("Problems"), F.count(F.lit(1)).alias("Results"))
    return _first(counted.orderBy(F.desc("Problems"), "Table_ID"), top)


def dq_by_log(notes: DataFrame, log_id: str) -> DataFrame:
    return notes.filter(F.col("Log_ID") == log_id)


def activity(entries: DataFrame, log: DataFrame | None = None, **where) -> DataFrame:
    """Activity rows in order, by log id, table or (through the run log) execution."""
    if "Trigger_Execution_ID" in where:
        runs = log.filter(F.col("Trigger_Execution_ID") == where.pop("Trigger_Execution_ID")).select("Log_ID").distinct()
        entries = entries.join(runs, "Log_ID", "left_semi")
    for column, value in where.items():
        entries = entries.filter(F.col(column) == value)
    return entries.orderBy("Log_ID", "Sequence_Number")


def schema_changes(changes: DataFrame, table_id: int) -> DataFrame:
    return changes.filter(F.col("Table_ID") == table_id).orderBy(F.desc("Schema_Arrival_Time"), "Column_Name")


def latest_profile(profiles: DataFrame) -> DataFrame:
    """The newest profile row of each table's column."""
    rest = [c for c in profiles.columns if c not in ("Table_ID", "Column_Name")]
    newest = F.max_by(F.struct(*rest), "Data_Profile_Execution_Time").alias("p")
    return profiles.groupBy("Table_ID", "Column_Name").agg(newest).select("Table_ID", "Column_Name", "p.*")


def config_and_status(orchestration: DataFrame, primary: DataFrame, log: DataFrame) -> DataFrame:
    """Orchestrated tables with their settings and last status."""
    out = orchestration.join(config_map(primary), "Table_ID", "left").join(last_status(log), "Table_ID", "left")
    return out.withColumn("Last_Ingestion_Status", F.coalesce("Last_Ingestion_Status", F.lit(FAILED)))


def full_metadata(
    table_id: int, orchestration: DataFrame, primary: DataFrame, advanced: DataFrame
) -> dict[str, DataFrame]:
    """All configuration rows of one table, by control table."""
    tables = {"orchestration": orchestration, "primary": primary, "advanced": advanced}
    return {name: df.filter(F.col("Table_ID") == table_id) for name, df in tables.items()}


def trigger_overview(orchestration: DataFrame) -> DataFrame:
    """Steps and tables per trigger."""
    return orchestration.groupBy("Trigger_Name").agg(
        F.count_distinct("Order_Of_Operations").alias("Steps"), F.count(F.lit(1)).alias("Tables"),
        F.count_if(F.col("Ingestion_Active") == 1).alias("Active_Tables"),
    )


def full_health(log: DataFrame, notes: DataFrame, orchestration: DataFrame, primary: DataFrame, now: Column) -> dict[str, DataFrame]:
    """The views an operator looks at first."""
    return {
        "status": config_and_status(orchestration, primary, log),
        "active": active_runs(log),
        "stale": stale_logs(log, now),
        "failures": recent_failures(log, now),
        "quality": dq_overview(notes),
        "reliability": trigger_reliability(log),
    }
