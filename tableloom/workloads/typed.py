"""Described source tables: text columns get the types their database gave them."""

from __future__ import annotations

from tableloom.functions import dbtypes
from tableloom.workloads.registry import query

_TEXT = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")


def _typed(t, dialect: str, described: list[dict]):
    texts = t.orders.selectExpr(*[f"cast({c} AS string) AS {c}" for c in _TEXT])
    return dbtypes.apply_source_types(texts, dbtypes.column_defs(dialect, described, {"apply_case": "lower"}))


def _register(dialect: str, described: list[dict], types: str) -> None:
    sql = f"SELECT {types}, o_orderstatus FROM orders"

    @query(f"typed_{dialect}", sql)
    def run(t, dialect=dialect, described=described):
        return _typed(t, dialect, described)


def _column(name: str, kind: str, precision: int | None = None, scale: int | None = None, **more) -> dict:
    return {"COLUMN_NAME": name.upper(), "DATA_TYPE": kind, "DATA_PRECISION": precision, "DATA_SCALE": scale, "NULLABLE": "Y", **more}


_DATED = "CAST(o_orderdate AS TIMESTAMP) AS o_orderdate"
_register(
    "oracle",
    [_column("o_orderkey", "NUMBER", 12, 0), _column("o_custkey", "INTEGER"), _column("o_totalprice", "BINARY_DOUBLE"), _column("o_orderdate", "DATE"), _column("o_orderstatus", "VARCHAR2")],
    f"CAST(o_orderkey AS DECIMAL(12,0)) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, {_DATED}",
)
_register(
    "db2",
    [_column("o_orderkey", "BIGINT"), _column("o_custkey", "INTEGER"), _column("o_totalprice", "DECIMAL", 14, 2), _column("o_orderdate", "TIMESTAMP"), _column("o_orderstatus", "CHAR(1)")],
    f"CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, {_DATED}",
)
_register(
    "sql_server",
    [_column("o_orderkey", "bigint"), _column("o_custkey", "int"), _column("o_totalprice", "money"), _column("o_orderdate", "datetime2"), _column("o_orderstatus", "nchar")],
    f"CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice, {_DATED}",
)
_register(
    "postgre_sql",
    [_column("o_orderkey", "bigserial"), _column("o_custkey", "int4"), _column("o_totalprice", "float8"), _column("o_orderdate", "timestamp without time zone"), _column("o_orderstatus", "text[]")],
    f"CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, {_DATED}",
)
_register(
    "my_sql",
    [{"Field": "o_orderkey", "Type": "bigint unsigned", "Null": "NO"}, {"Field": "o_custkey", "Type": "mediumint(9)", "Null": "YES"}, {"Field": "o_totalprice", "Type": "decimal(14, 2)", "Null": "YES"},
     {"Field": "o_orderdate", "Type": "datetime", "Null": "YES"}, {"Field": "o_orderstatus", "Type": "enum", "Null": "YES"}],
    f"CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, {_DATED}",
)


@query("typed_not_null_checks", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'o_orderstatus must not be null' END AS broken FROM orders
""")
def typed_not_null_checks(t):
    """A NOT NULL column of the source becomes a check on the rows."""
    from tableloom.operators import quality

    defs = dbtypes.column_defs("oracle", [{"COLUMN_NAME": "o_orderstatus", "DATA_TYPE": "VARCHAR2", "NULLABLE": "N"}])
    checks = [{**c, "if_not_compliant": "quarantine"} for c in dbtypes.not_null_checks(defs)]
    rows = t.orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS o_orderstatus")
    out = quality.run_quality(rows, checks)
    held = out.quarantined.selectExpr("o_orderkey", f"{quality.QUARANTINE_REASON} AS broken")
    return out.clean.selectExpr("o_orderkey", "cast(null AS string) AS broken").unionByName(held)
