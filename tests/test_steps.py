"""Step semantics on tiny frames: nulls, types, errors."""

from __future__ import annotations

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.functions import dbtypes, names, text
from tableloom.functions.patterns import PATTERNS
from tableloom.operators import joins, schema
from tableloom.plans.steps import STEPS, StepContext, apply_steps
from tableloom.sources.store import TableStore
from tableloom.spec import SpecError, flag


@pytest.fixture
def run(spark):
    def go(df, *steps, hooks=None, **frames):
        return apply_steps(df, steps, StepContext(TableStore(spark, frames=frames), hooks=hooks or {}))
    return go


def test_all_thirty_categories_are_there():
    assert len(STEPS) == 30


def test_unknown_step_raises(run, frame):
    with pytest.raises(SpecError, match="unknown step"):
        run(frame("a int", [(1,)]), {"Category": "nope"})


def test_missing_column_raises(run, frame):
    with pytest.raises(SpecError, match="not found"):
        run(frame("a int", [(1,)]), {"Category": "remove_columns", "column_name": "b"})


def test_rename_needs_equal_lists(run, frame):
    with pytest.raises(SpecError):
        run(frame("a int, b int", [(1, 2)]), {"Category": "columns_to_rename", "existing_column_name": "a, b", "new_column_name": "x"})


def test_select_keeps_bookkeeping_columns(run, frame):
    df = frame("a int, b int, delta__x int, scd_active int", [(1, 2, 3, 1)])
    assert run(df, {"Category": "select_columns", "column_name": "b"}).columns == ["b", "delta__x", "scd_active"]
    only = run(df, {"Category": "select_columns", "column_name": "b", "retain_metadata_columns": "false"})
    assert only.columns == ["b"]


@pytest.mark.parametrize("kind,value,old,new", [
    ("bigint", 5, "5", "7"), ("smallint", 5, "5", "7"), ("double", 1.5, "1.5", "2.5"), ("string", "a", "a", "b"),
])
def test_replace_values_by_type(run, frame, kind, value, old, new):
    df = frame(f"a {kind}", [(value,), (None,)])
    out = run(df, {"Category": "replace_values", "column_name": "a", "values_to_replace": old, "replacement_value": new})
    assert out.schema == df.schema
    assert as_set(out) == {(type(value)(new),), (None,)}


def test_replace_values_refuses_wrong_text(run, frame):
    with pytest.raises(SpecError):
        run(frame("a int", [(1,)]), {"Category": "replace_values", "column_name": "a", "values_to_replace": "x", "replacement_value": "1"})


def test_null_handling(run, frame):
    df = frame("a string, n bigint", [(" x ", 1), ("", None), (None, 3)])
    nulled = run(df, {"Category": "apply_null_handling", "action": "convert_values_to_null", "column_name": "a", "values_to_convert": "x", "convert_empty_space": "true"})
    assert as_set(nulled, "a") == {(None,)}
    filled = run(df, {"Category": "apply_null_handling", "action": "replace_with_default", "column_name": "n", "default_value": "9"})
    assert as_set(filled, "n") == {(1,), (9,), (3,)}


def test_split_gives_null_for_missing_parts(run, frame):
    df = frame("a string", [("1-2-3",), ("4",), (None,)])
    out = run(df, {"Category": "split_column", "column_name": "a", "delimiter": "-", "output_column_names": "x, y", "max_splits": "1", "drop_original": "true"})
    assert as_set(out) == {("1", "2-3"), ("4", None), (None, None)}


def test_concat_null_modes(run, frame):
    df = frame("a string, b string", [("x", None)])
    got = [run(df, {"Category": "concat_columns", "column_name": "a, b", "output_column_name": "o", "separator": "-", "null_handling": m}).first()["o"] for m in ("skip", "empty", "keep")]
    assert got == ["x", "x-", None]


def test_explode_keeps_or_drops_nulls(run, frame):
    df = frame("i int, a array<int>", [(1, [1, 2]), (2, []), (3, None)])
    step = {"Category": "explode_array", "column_name": "a"}
    assert as_set(run(df, step)) == {(1, 1), (1, 2)}
    assert as_set(run(df, {**step, "preserve_nulls": "true"})) == {(1, 1), (1, 2), (2, None), (3, None)}


def test_flatten_needs_a_struct(run, frame):
    with pytest.raises(SpecError):
        run(frame("a int", [(1,)]), {"Category": "flatten_struct", "column_name": "a"})


def test_join_refuses_ambiguous_columns(frame):
    a, b = frame("k int, v int", [(1, 2)]), frame("k int, w int", [(1, 3)])
    with pytest.raises(SpecError, match="both sides"):
        joins.join_data(a, b, "a.k = b.k")
    assert joins.join_data(a, b, "a.k = b.k", right_columns="w").first().asDict() == {"k": 1, "v": 2, "w": 3}
    with pytest.raises(SpecError):
        joins.join_data(a, b, "a.k = b.k", "cross")


def test_broadcast_wish_is_kept_for_small_sides_only(frame, spark):
    a, b = spark.range(100).withColumnRenamed("id", "k"), frame("k int, w int", [(1, 3)])
    hinted = joins.join_data(a, b, "a.k = b.k", right_columns="w", broadcast=True)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    huge = spark.range(10**12).selectExpr("id AS k", "id AS w")
    wished = joins.join_data(a, huge, "a.k = b.k", right_columns="w", broadcast=True)
    assert "ResolvedHint" not in wished._jdf.queryExecution().analyzed().toString()


def test_custom_function_gets_its_settings(run, frame):
    def add(new_data, metadata, spark):
        return new_data.withColumn("b", F.lit(metadata["function_config"]["n"]))
    out = run(frame("a int", [(1,)]), {"Category": "custom_transformation_function", "functions_to_execute": "add", "n": "5"}, hooks={"add": add})
    assert out.first()["b"] == "5"


def test_row_hash_tells_rows_apart(run, frame):
    df = frame("a int, b string", [(1, None), (1, "NULL"), (2, "x")])
    out = run(df, {"Category": "add_row_hash"})
    assert out.select("row_hash").distinct().count() == 3


@pytest.mark.parametrize("operations,value,want", [
    ("trim,lowercase,collapse_whitespace", "  A  B ", "a b"), ("strip_accents", "Éàñç", "Eanc"),
    ("remove_punctuation", "a,b.c!", "abc"), ("remove_digits,uppercase", "a1b2", "AB"), ("ascii_only", "aéb", "ab"),
])
def test_normalize(run, frame, operations, value, want):
    out = run(frame("a string", [(value,)]), {"Category": "normalize_text", "column_name": "*", "operations": operations})
    assert out.first()["a"] == want


@pytest.mark.parametrize("value,want", [
    ("x Bearer abc.def", "x Bearer [REDACTED]"), ("PWD=hush;x", "PWD=[REDACTED];x"), ("?sig=1&z", "?sig=[REDACTED]&z"),
    ("eyJhbGciOiJI12.eyJzdWIiOiIx12.abcdefghijkl", "[JWT REDACTED]"),
])
def test_redaction(frame, value, want):
    assert frame("a string", [(value,)]).select(text.redact_secrets(F.col("a"))).first()[0] == want


def test_redaction_shortens(frame):
    out = frame("a string", [("x" * 300,)]).select(text.redact_secrets(F.col("a"), 100)).first()[0]
    assert len(out) == 100 and out.endswith(" ... [truncated, 300 chars total]")


GOOD_BAD = {
    "us_phone": ("(123) 456-7890", "12-34"), "email": ("a.b@c.org", "a@b"), "us_zip": ("12345-6789", "1234"),
    "us_ssn": ("123-45-6789", "123456789"), "date_mmddyyyy": ("12/31/2024", "13/01/2024"), "date_yyyymmdd": ("2024-12-31", "2024-13-01"),
    "url": ("https://www.example.com/x?y=1", "ftp://example.com"), "credit_card": ("4111 1111 1111 1111", "4111"),
    "ip_address": ("2001:db8::8a2e:370:7334", "1.2.3"), "ipv4_address": ("192.168.1.255", "256.1.1.1"),
    "ipv6_address": ("::1", "12345::"), "alpha_only": ("abC", "ab1"), "alphanumeric_only": ("ab1", "a-b"), "numeric_only": ("0123", "1.5"),
    "guid": ("12345678-1234-abcd-1234-123456789012", "1234"), "uk_phone": ("+44 7895891235", "12"), "uk_postcode": ("ec1a 1bb", "12345"),
}


@pytest.mark.parametrize("kind", sorted(PATTERNS))
def test_patterns(frame, kind):
    good, bad = GOOD_BAD[kind]
    row = frame("g string, b string", [(good, bad)]).select(F.col("g").rlike(PATTERNS[kind]), F.col("b").rlike(PATTERNS[kind])).first()
    assert tuple(row) == (True, False)


def test_name_cleansing():
    assert names.cleanse_names(["a b", "delta__X y"], {"replace_non_alphanumeric_with_underscore": "true"}) == ["a_b", "delta__X y"]
    assert names.cleanse_name("abc", {"exact_find": "b", "exact_replace": ""}) == "abc"
    assert names.cleanse_name("abc", {"regex_find": "(", "regex_replace": "x"}) == "abc"
    with pytest.raises(SpecError, match="collide"):
        names.cleanse_names(["a b", "a_b"], {"replace_non_alphanumeric_with_underscore": "true"})
    with pytest.raises(SpecError):
        names.cleanse_name("abc", {"exact_find": "a,b,c", "exact_replace": "x,y"})


@pytest.mark.parametrize("dialect,row,want", [
    ("oracle", {"data_type": "NUMBER"}, "DOUBLE"), ("oracle", {"data_type": "NUMBER", "data_precision": 10, "data_scale": 2}, "DECIMAL(10,2)"),
    ("oracle", {"data_type": "DATE"}, "TIMESTAMP"), ("oracle", {"data_type": "LONG RAW"}, "BINARY"), ("oracle", {"data_type": "CLOB"}, "STRING"),
    ("db2", {"data_type": "CHAR(4) FOR BIT DATA"}, "BINARY"), ("db2", {"data_type": "TIME"}, "STRING"), ("db2", {"data_type": "DECIMAL", "data_precision": 5, "data_scale": 1}, "DECIMAL(5,1)"),
    ("sql_server", {"data_type": "money"}, "DECIMAL(19,4)"), ("sql_server", {"data_type": "rowversion"}, "BINARY"), ("azure_sql", {"data_type": "datetimeoffset"}, "STRING"),
    ("postgre_sql", {"data_type": "int[]"}, "STRING"), ("postgre_sql", {"data_type": "numeric", "data_precision": 50}, "STRING"), ("postgre_sql", {"data_type": "double precision"}, "DOUBLE"),
    ("my_sql", {"Type": "int(11) unsigned"}, "INT"), ("my_sql", {"Type": "decimal"}, "DECIMAL(10,0)"), ("my_sql", {"Type": "decimal(8,3)"}, "DECIMAL(8,3)"), ("my_sql", {"Type": "year"}, "INT"),
])
def test_database_types(dialect, row, want):
    made = dbtypes.column_defs(dialect, [{"column_name": "c", **row}])
    assert made[0].spark_type == want


def test_unknown_mysql_type_raises():
    with pytest.raises(SpecError):
        dbtypes.column_defs("my_sql", [{"Field": "c", "Type": "frob"}])


def test_source_types_are_applied(frame):
    defs = dbtypes.column_defs("sql_server", [
        {"column_name": "a", "data_type": "int", "nullable": False}, {"column_name": "d", "data_type": "date"}, {"column_name": "gone", "data_type": "int"},
    ])
    out = dbtypes.apply_source_types(frame("a string, d string, x string", [("1", "2024-01-02", "k")]), defs)
    assert dict(out.dtypes) == {"a": "int", "d": "date", "x": "string"}
    assert [s["column_name"] for s in dbtypes.not_null_checks(defs)] == ["a"]
    with pytest.raises(SpecError):
        dbtypes.apply_source_types(frame("z string", [("1",)]), defs)


def test_schema_contract_and_policy(frame):
    df = frame("a int, s struct<x:int,y:array<string>>", [])
    schema.check_contract(df, "a int, s struct<x:int,y:array<string>>")
    with pytest.raises(SpecError, match="missing column b"):
        schema.check_contract(df, "a bigint, b int")
    changes = schema.schema_changes(df.schema, frame("a bigint, t int", []).schema)
    assert {c["Change_Type"] for c in changes} == {"Column Added", "Column Dropped", "Column Type Changed"}
    assert schema.apply_drift_policy(changes) == changes
    assert schema.apply_drift_policy(changes, fail_on_any=True, first_run=True) == []
    with pytest.raises(schema.SchemaDrift):
        schema.apply_drift_policy(changes, fail_on_type_change=True)
    assert schema.fingerprint(df.schema) != schema.fingerprint(frame("a int", []).schema)


def test_flags_come_as_text():
    assert flag("true") and not flag("false") and flag(None, True) and not flag("", False)
