from __future__ import annotations

import pytest
from helpers import as_set
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tableloom.operators import dimensions, merge, recipes, scd2
from tableloom.operators.merge import DeleteFlag
from tableloom.spec import SpecError

PLANS = pytest.mark.parametrize("limit", [1 << 30, -1], ids=["broadcast", "full_outer"])


@PLANS
def test_upsert_is_null_safe_and_widens(frame, limit):
    old = frame("k int, v string, gone int", [(1, "a", 7), (None, "n", 8), (2, "b", 9)])
    new = frame("k int, v string, extra int", [(1, None, 1), (None, "m", 2), (3, "c", 3)])
    out = merge.merge(old, new, ["k"], broadcast_limit=limit)
    assert as_set(out, "k", "v", "gone", "extra") == {(1, None, 7, 1), (None, "m", 8, 2), (2, "b", 9, None), (3, "c", None, 3)}


@PLANS
def test_upsert_is_idempotent(frame, limit):
    old, new = frame("k int, v int", [(1, 1), (2, 2)]), frame("k int, v int", [(2, 3), (4, 4)])
    once = merge.merge(old, new, ["k"], broadcast_limit=limit)
    assert as_set(merge.merge(once, new, ["k"], broadcast_limit=limit)) == as_set(once) == {(1, 1), (2, 3), (4, 4)}


@PLANS
def test_repeated_source_key_fails(frame, limit):
    out = merge.merge(frame("k int, v int", [(1, 1)]), frame("k int, v int", [(1, 2), (1, 3)]), ["k"], broadcast_limit=limit)
    with pytest.raises(Exception, match="duplicate keys"):
        out.collect()


def test_no_key_is_an_error(frame):
    with pytest.raises(SpecError):
        merge.merge(frame("k int", [(1,)]), frame("k int", [(1,)]), []).collect()


@PLANS
def test_delete_removes_matched_and_inserts_unmatched_flagged(frame, limit):
    old = frame("k int, f string", [(1, None), (2, None)])
    new = frame("k int, f string", [(1, "D"), (2, None), (3, "D")])
    out = merge.merge_and_delete(old, new, ["k"], DeleteFlag("f", "D"), broadcast_limit=limit)
    assert as_set(out) == {(2, None), (3, "D")}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 6), st.integers(0, 2), max_size=6), st.dictionaries(st.integers(0, 6), st.integers(0, 2), max_size=6))
def test_feed_carries_one_state_to_the_next(frame, before, after):
    a, b = frame("k int, v int", list(before.items())), frame("k int, v int", list(after.items()))
    feed = merge.change_feed(a, b, ["k"], 1, F.current_timestamp())
    assert as_set(merge.merge_and_delete(a, feed, ["k"], merge.FEED_DELETE)) == set(after.items())


def test_replace_where_refuses_null_and_too_many(frame):
    old = frame("p string, v int", [("a", 1), ("b", 2), (None, 3)])
    with pytest.raises(Exception, match="null 'p'"):
        merge.replace_where(old, frame("p string, v int", [("a", 9), (None, 9)]), "p").collect()
    with pytest.raises(Exception, match="more than 1"):
        merge.replace_where(old, frame("p string, v int", [("a", 9), ("b", 9)]), "p", max_values=1).collect()
    assert as_set(merge.replace_where(old, frame("p string, v int", [("a", 9)]), "p")) == {("a", 9), ("b", 2), (None, 3)}
    with pytest.raises(SpecError):
        merge.replace_where(old, old, "q")


def test_append_and_overwrite_and_first_load(frame):
    a, b = frame("k int", [(1,)]), frame("k int, w int", [(2, 3)])
    assert as_set(merge.apply_merge("append", a, b, [])) == {(1, None), (2, 3)}
    assert as_set(merge.apply_merge("overwrite", a, b, [])) == {(2, 3)}
    feed = frame("k int, _change_type string", [(1, "insert")])
    assert merge.apply_merge("merge", None, feed, ["k"]).columns == ["k"]
    with pytest.raises(SpecError):
        merge.apply_merge("merge_and_delete", a, b, ["k"])


HISTORY = "k int, v string, removed int, at timestamp_ntz"


@pytest.fixture
def versions(spark):
    def make(rows, day):
        return spark.createDataFrame(rows, "k int, v string, removed int").withColumn("at", F.lit(f"2024-01-0{day}").cast("timestamp"))
    return make


def test_history_has_one_active_version_and_no_overlap(versions):
    flag = DeleteFlag("removed", "1")
    state = scd2.add_history_columns(versions([(1, "a", 0), (2, "b", 0), (3, "c", 1), (None, "n", 0)], 1), "at", flag)
    for day, rows in ((2, [(1, "a2", 0), (2, "b", 0), (4, "d", 1)]), (3, [(1, "a2", 1), (2, "b3", 0), (None, "n3", 0)]), (4, [(1, "a4", 0)])):
        state = scd2.merge_history(state, versions(rows, day), ["k"], "at", flag)
    state = state.cache()
    day = lambda c: F.dayofmonth(c)
    got = as_set(state, "k", "v", "removed", day("scd_start_date").alias("s"), day("scd_end_date").alias("e"), "scd_active")
    assert got == {
        (1, "a", 0, 1, 2, 0), (1, "a2", 1, 2, 3, 0), (1, "a4", 0, 4, None, 1), (2, "b", 0, 1, 3, 0), (2, "b3", 0, 3, None, 1),
        (3, "c", 1, 1, 1, 0), (4, "d", 1, 2, 2, 0), (None, "n", 0, 1, 3, 0), (None, "n3", 0, 3, None, 1),
    }
    assert state.filter("scd_active = 1").groupBy("k").count().filter("count > 1").isEmpty()


def test_history_refuses_two_rows_of_a_key(versions):
    state = scd2.add_history_columns(versions([(1, "a", 0)], 1), "at")
    with pytest.raises(Exception, match="duplicate keys"):
        scd2.merge_history(state, versions([(1, "x", 0), (1, "y", 0)], 2), ["k"], "at").collect()


def test_surrogate_keys_are_dense_stable_and_reuse_members(frame):
    first = dimensions.assign_surrogate_keys(frame("k int, v string", [(5, "a"), (3, "b"), (None, "c"), (None, "d")]), ["k"], "sk")
    assert first.columns == ["sk", "k", "v"]
    assert {r["k"]: r["sk"] for r in first.filter("k IS NOT NULL").collect()} == {3: 3, 5: 4}
    assert as_set(first.filter("k IS NULL"), "sk") == {(1,), (2,)}
    dim = frame("sk bigint, k int, scd_active int", [(-1, None, 1), (1, 3, 1), (2, 5, 1), (9, 5, 0)])
    again = dimensions.assign_surrogate_keys(frame("k int", [(5,), (7,), (6,)]), ["k"], "sk", dim)
    assert as_set(again) == {(2, 5), (10, 6), (11, 7)}


def test_surrogate_keys_refuse_repeats(frame):
    with pytest.raises(Exception, match="duplicate keys"):
        dimensions.assign_surrogate_keys(frame("k int", [(1,), (1,)]), ["k"], "sk").collect()
    two_active = frame("sk bigint, k int, scd_active int", [(1, 3, 1), (2, 3, 1)])
    with pytest.raises(Exception, match="duplicate keys"):
        dimensions.assign_surrogate_keys(frame("k int", [(3,)]), ["k"], "sk", two_active).collect()


def test_unknown_member_fills_required_columns(spark):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("sk", T.LongType(), False), T.StructField("name", T.StringType(), False), T.StructField("n", T.DoubleType(), False),
        T.StructField("note", T.StringType()), T.StructField("scd_active", T.IntegerType()), T.StructField("gone", T.IntegerType()),
    ])
    assert dimensions.unknown_member(schema, "sk", "gone") == {"sk": -1, "name": "-1", "n": -1.0, "note": None, "scd_active": 1, "gone": 0}


def test_attach_uses_active_members_and_minus_one(frame):
    facts = frame("f int, c int", [(1, 5), (2, 6)])
    dim = frame("sk bigint, k int, scd_active int", [(1, 5, 0), (2, 5, 1)])
    out = dimensions.attach_surrogate_key(facts, dim, "a.c = b.k", "sk", "dim_sk", ["k"])
    assert out.columns[0] == "dim_sk" and as_set(out) == {(2, 1, 5), (-1, 2, 6)}
    with pytest.raises(SpecError):
        dimensions.attach_surrogate_key(facts, dim, "a.c = b.k", "sk", "f", ["k"])
    with pytest.raises(Exception, match="duplicate keys"):
        dimensions.attach_surrogate_key(facts, dim.drop("scd_active"), "a.c = b.k", "sk", "dim_sk", ["k"]).collect()


def test_date_dimension_spans_a_century(spark):
    dim = dimensions.date_dimension(spark)
    row = dim.filter("date_sk = 20240229").first()
    assert dim.count() == 36890 + 1 and len(dim.columns) == 21
    assert (row["Day_Name"], row["Is_Weekend"], row["Sort_Year_Month"], row["Month_Year"]) == ("Thursday", False, -202402, "Feb, 2024")


def test_running_total_resets_in_each_group(frame):
    df = frame("g int, o int, v int, r int", [(1, 1, 5, 0), (1, 2, 5, 1), (1, 3, 5, 0), (2, 1, 1, 0)])
    out = recipes.running_total_with_reset(df, ["g"], ["o"], "v", "r = 1", "t")
    assert as_set(out, "g", "o", "t") == {(1, 1, 5), (1, 2, 5), (1, 3, 10), (2, 1, 1)}
