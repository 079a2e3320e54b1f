"""Runs that rewrite only the partitions they touch, whole pointers, and batched merges as aggregates."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.operators import merge
from tableloom.operators.merge import DeleteFlag
from tableloom.plans.run import SourceSpec, TableSpec, run_table
from tableloom.sources.store import TableStore
from tableloom.spec import SpecError

DAY = date(2024, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def run(spark, store, rows, ddl="id int, day date, v string", **changes):
    store.register("src", spark.createDataFrame(rows, ddl))
    spec = dict(target="silver.t", source=SourceSpec(table="src"), primary_keys=["id"], partition_by=["day"], merge_type="merge")
    return run_table(spark, store, TableSpec(**{**spec, **changes}), now=datetime(2024, 5, 1))


def files(tmp_path):
    return {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "tables/silver/t").glob("part-*/**/*.parquet")}


def day(n):
    return DAY + timedelta(days=n)


def test_replacing_a_range_leaves_other_partitions_alone(spark, store, tmp_path):
    run(spark, store, [(i, day(i // 3), "old") for i in range(30)], merge_type="replace_where", replace_column="day")
    before = files(tmp_path)
    # days 2 to 4; day 3 has no row any more
    run(spark, store, [(100, day(2), "new"), (101, day(4), "new")], merge_type="replace_where", replace_column="day")
    after = files(tmp_path)
    kept = {f: t for f, t in before.items() if not any(f"day={day(n)}" in str(f) for n in (2, 3, 4))}
    assert len(kept) == 7 and all(after[f] == t for f, t in kept.items())
    assert not any(f"day={day(3)}" in str(f) for f in after)
    want = {(i, day(i // 3), "old") for i in range(30) if i // 3 not in (2, 3, 4)} | {(100, day(2), "new"), (101, day(4), "new")}
    assert as_set(store.read("silver.t"), "id", "day", "v") == want
    assert store.read("silver.t").columns[:3] == ["id", "day", "v"]


def test_replacing_keeps_rows_of_a_partition_outside_the_range(spark, store, tmp_path):
    month = [{"Category": "derived_column", "column_name": "month", "expression": "date_format(day, 'yyyy-MM')"}]
    options = dict(merge_type="replace_where", replace_column="day", partition_by=["month"], steps=month)
    run(spark, store, [(i, day(i), "old") for i in range(90)], **options)
    before = files(tmp_path)
    run(spark, store, [(200, day(40), "new"), (201, day(45), "new")], **options)
    after = files(tmp_path)
    assert {f for f in before if "month=2024-02" not in str(f)} <= set(after)
    assert not {f for f in before if "month=2024-02" in str(f)} & set(after)
    want = {(i, "old") for i in range(90) if not 40 <= i <= 45} | {(200, "new"), (201, "new")}
    assert as_set(store.read("silver.t"), "id", "v") == want
    assert dict(store.read("silver.t").dtypes)["month"] == "string"


def test_replacing_listed_values_in_a_table_of_two_partition_columns(spark, store, tmp_path):
    ddl, options = "id int, day date, v string, kind string", dict(merge_type="replace_where", replace_column="kind", partition_by=["kind", "day"])
    run(spark, store, [(i, day(i % 2), "old", "abc"[i % 3] + " /=%") for i in range(12)], ddl, **options)
    before = files(tmp_path)
    run(spark, store, [(50, day(0), "new", "b /=%")], ddl, **options)
    assert {f for f in before if "kind=b" not in str(f)} <= set(files(tmp_path))
    want = {(i, "old") for i in range(12) if i % 3 != 1} | {(50, "new")}
    assert as_set(store.read("silver.t"), "id", "v") == want
    assert sum("kind=b" in str(f) for f in files(tmp_path)) == 1  # the other day of b had no row left


def test_merging_rewrites_the_partitions_of_matched_and_new_rows(spark, store, tmp_path):
    run(spark, store, [(i, day(i % 10), "old") for i in range(40)])
    before = files(tmp_path)
    # 5 moves from day 5 to day 7, 99 is new on day 30
    run(spark, store, [(5, day(7), "moved"), (99, day(30), "new")])
    after = files(tmp_path)
    changed = {str(f).split("day=")[1][:10] for f in set(before) ^ set(after)}
    assert changed == {str(day(5)), str(day(7)), str(day(30))}
    want = {(i, day(i % 10), "old") for i in range(40) if i != 5} | {(5, day(7), "moved"), (99, day(30), "new")}
    assert as_set(store.read("silver.t"), "id", "day", "v") == want
    assert store.read("silver.t").filter("delta__created_datetime IS NULL").count() == 0


def test_deleting_drops_emptied_partitions_and_appending_adds_files(spark, store, tmp_path):
    options = dict(merge_type="merge_and_delete", delete=DeleteFlag("v", "gone"))
    run(spark, store, [(1, day(1), "a"), (2, day(2), "b")], **options)
    run(spark, store, [(1, day(1), "gone")], **options)
    assert as_set(store.read("silver.t"), "id") == {(2,)}
    assert not any(f"day={day(1)}" in str(f) for f in files(tmp_path))
    before = files(tmp_path)
    run(spark, store, [(3, day(2), "c")], merge_type="append")
    assert set(before) < set(files(tmp_path)) and as_set(store.read("silver.t"), "id") == {(2,), (3,)}


def test_new_columns_widen_and_other_types_or_merges_rewrite(spark, store):
    run(spark, store, [(1, day(1), "a"), (2, day(2), "b")])
    run(spark, store, [(2, day(2), "bb", 7)], "id int, day date, v string, n int")
    assert as_set(store.read("silver.t"), "id", "v", "n") == {(1, "a", None), (2, "bb", 7)}
    run(spark, store, [(2, day(2), "b3", 7)], "id int, day date, v string, n int", merge_type="merge_mark_unmatched_deleted", delete=DeleteFlag("n", "1"))
    assert as_set(store.read("silver.t"), "id", "v", "n") == {(1, "a", 1), (2, "b3", None)}
    assert store.partitioned_by("silver.t") == ["day"]
    with pytest.raises(SpecError, match="not kept"):
        store.read("silver.t", 1)


def test_null_partition_values_are_refused(spark, store):
    with pytest.raises(Exception, match="null partition value"):
        run(spark, store, [(1, None, "a")])


def test_an_empty_pointer_neither_hides_nor_blocks_a_table(spark, store, tmp_path):
    store.write("silver.x", spark.range(2))
    pointers = tmp_path / "tables/silver/x/_current"
    (pointers / "p2").write_text("")
    assert store.version("silver.x") == 1 and store.read("silver.x").count() == 2
    assert store.write("silver.x", spark.range(3)) == 2 and store.read("silver.x").count() == 3
    assert not [p for p in pointers.iterdir() if "draft" in p.name]
    assert not store._point("silver.x", 2, ["other"], None) and store.read("silver.x").count() == 3


def test_logs_and_quarantine_keep_their_versions(spark, store):
    store.append_rows("log.x", spark.range(2))
    store.append_rows("log.x", spark.range(5, 6))
    assert store.read("log.x").count() == 3 and store.read("log.x", 1).count() == 2


# -- batched deletions -----------------------------------------------------------


def fold(present, rows):
    """One merge after the other: ``(row or None, creation)`` of a key; present keys were created at 0."""
    live, row, born = present is not None, present, 0
    for at, gone, value in rows:
        if live and gone:
            live = False
        else:
            born = born if live else at
            live, row = True, (at, gone, value)
    return (row, born) if live else None


@pytest.mark.parametrize("seed", range(3))
def test_batches_with_deletions_equal_one_merge_each(spark, seed):
    rng = random.Random(seed)
    plans = {k: [(at, rng.random() < 0.5, f"v{k}.{at}") for at in sorted(rng.sample(range(1, 60), rng.randint(1, 7)))] for k in range(150)}
    plans[None] = [(3, False, "n"), (9, True, "n2"), (12, True, "n3")]
    plans["hot"] = [(at, at % 3 == 0 or at > 990, f"h{at}") for at in range(1, 1000)]
    text = lambda k: None if k is None else str(k)
    had = [k for k in plans if k is None or k == "hot" or k % 2]
    ddl = "k string, at int, gone string, value string, delta__created_datetime timestamp"
    stamp = lambda n: datetime(2024, 1, 1) + timedelta(minutes=n)
    target = spark.createDataFrame([(text(k), 0, "n", "old", stamp(0)) for k in [*had, "idle"]], ddl)
    batches = spark.createDataFrame([(text(k), at, "y" if gone else "n", value, stamp(at)) for k, rows in plans.items() for at, gone, value in rows], ddl)
    out = merge.apply_merge("merge_and_delete", target, batches, ["k"], DeleteFlag("gone", "y"), batch_columns=["at"])
    want = {("idle", 0, "n", "old", stamp(0))}
    for k, rows in plans.items():
        if end := fold((0, False, "old") if k in had else None, rows):
            (at, gone, value), born = end
            want.add((text(k), at, "y" if gone else "n", value, stamp(born)))
    assert as_set(out.select("k", "at", "gone", "value", "delta__created_datetime")) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan


def test_batches_without_creation_times(spark):
    target = spark.createDataFrame([(1, 0, "a"), (2, 0, "a")], "k int, at int, v string")
    batches = spark.createDataFrame([(1, 1, "gone"), (1, 2, "b"), (2, 1, "gone"), (3, 1, "gone"), (4, 1, "gone"), (4, 2, "gone")], "k int, at int, v string")
    out = merge.apply_merge("merge_and_delete", target, batches, ["k"], DeleteFlag("v", "gone"), batch_columns=["at"])
    assert as_set(out) == {(1, 2, "b"), (3, 1, "gone")}
    with pytest.raises(Exception, match="duplicate keys"):
        merge.apply_merge("merge_and_delete", target, batches.union(batches.limit(1)), ["k"], DeleteFlag("v", "gone"), batch_columns=["at"]).collect()
