"""Schema contracts, differences, fingerprints and the drift policy."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableloom.spec import SpecError

CHANGE_DDL = "Change_Type string, Column_Name string, Data_Type_Details string"
# The change names that logs carry.
ADDED, DROPPED, CHANGED = "Column Added", "Column Dropped", "Column Type Changed"


class SchemaDrift(Exception):
    """The policy stops the run because of schema changes."""


def check_contract(df: DataFrame, ddl: str) -> None:
    """Expected columns must exist with the expected type; more columns are fine."""
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    for want in T.StructType.fromDDL(ddl).fields:
        got = have.get(want.name.lower())
        if got is None:
            problems.append(f"missing column {want.name}")
        elif got != want.dataType.simpleString():
            problems.append(f"column {want.name} is {got}, expected {want.dataType.simpleString()}")
    if problems:
        raise SpecError("schema contract broken: " + "; ".join(problems))


def fingerprint(schema: T.StructType) -> str:
    """Identity of a schema: names and types in order."""
    return hashlib.md5(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields).encode()).hexdigest()


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as a table ``(column_name, data_type)``."""
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between two schema tables."""
    both = old.alias("o").join(new.alias("n"), F.col("o.column_name") == F.col("n.column_name"), "full_outer")
    o, n = F.col("o.data_type"), F.col("n.data_type")
    kind = F.when(o.isNull(), F.lit(ADDED)).when(n.isNull(), F.lit(DROPPED)).when(o != n, F.lit(CHANGED))
    detail = F.when(o.isNull(), n).when(n.isNull(), o).otherwise(F.concat(o, F.lit(" --> "), n))
    return both.select(
        kind.alias("Change_Type"),
        F.coalesce("o.column_name", "n.column_name").alias("Column_Name"),
        detail.alias("Data_Type_Details"),
    ).filter("Change_Type IS NOT NULL")


def schema_changes(old: T.StructType, new: T.StructType) -> list[dict]:
    """The same between two schemas at hand; no job."""
    a = {f.name: f.dataType.simpleString() for f in old.fields}
    b = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [(ADDED, c, b[c]) for c in b if c not in a] + [(DROPPED, c, a[c]) for c in a if c not in b]
    rows += [(CHANGED, c, f"{a[c]} --> {b[c]}") for c in b if c in a and a[c] != b[c]]
    return [dict(zip(("Change_Type", "Column_Name", "Data_Type_Details"), r)) for r in rows]


def apply_drift_policy(
    changes: list[dict], fail_on_any: bool = False, fail_on_type_change: bool = False, first_run: bool = False
) -> list[dict]:
    """Return the changes as warnings, or stop when the policy says so."""
    if first_run:
        return []
    fatal = changes if fail_on_any else [c for c in changes if c["Change_Type"] == CHANGED and fail_on_type_change]
    if fatal:
        raise SchemaDrift("; ".join(f"{c['Change_Type']}: {c['Column_Name']} {c['Data_Type_Details']}" for c in fatal))
    return changes
