"""Equal parts of database tables, mixed parquet files, united profiles, joins on ranges."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.operators import ranges, sketches
from tableloom.operators.joins import join_data
from tableloom.sources import files, tables
from tableloom.sources.files import FileSpec
from tableloom.sources.store import TableStore
from tableloom.spec import SpecError

URL, DRIVER = "jdbc:derby:memory:parts;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.mark.parametrize("within", ["ID", None])
def test_parts_of_a_table_with_a_hot_day(spark, within):
    day = F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97).cast("int"))).when(F.col("id") % 50 == 1, None)
    rows = spark.range(6000).select(F.when(F.col("id") % 501 == 0, None).otherwise(F.pow(F.col("id") % 3000, F.lit(1.3)).cast("int")).alias("ID"), day.otherwise(F.lit("2024-02-10").cast("date")).alias("D"))
    rows.write.jdbc(URL, "HOT", mode="overwrite", properties={"driver": DRIVER})
    parts = tables.depth_predicates(spark, URL, "HOT", DRIVER, "D", 6, within, "DATE('{}')")
    read = tables.read_jdbc(spark, URL, "HOT", DRIVER, predicates=parts)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    sizes = [r[1] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    if within:
        assert len(sizes) == 6 and max(sizes) <= 2 * min(sizes)
    else:
        assert max(sizes) > 3 * min(sizes)  # the day stays in one part


def test_parts_of_numbers_and_of_an_empty_table(spark):
    rows = spark.range(1000).select(F.floor(F.pow(F.col("id"), F.lit(1.5))).cast("int").alias("N"))
    rows.write.jdbc(URL, "NUMS", mode="overwrite", properties={"driver": DRIVER})
    parts = tables.depth_predicates(spark, URL, "NUMS", DRIVER, "N", 4, literal="{}")
    sizes = [tables.read_jdbc(spark, URL, f"(SELECT * FROM NUMS WHERE {p}) x", DRIVER).count() for p in parts]
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) <= 2 * min(sizes)
    rows.limit(0).write.jdbc(URL, "VOID", mode="overwrite", properties={"driver": DRIVER})
    parts = tables.depth_predicates(spark, URL, "VOID", DRIVER, "N", 4, "N", literal="{}")
    assert tables.read_jdbc(spark, URL, "VOID", DRIVER, predicates=parts).count() == 0


def jobs(spark, fn):
    """How many jobs ``fn`` starts."""
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_mixed_parquet_files_are_grouped_in_one_job(spark, tmp_path):
    def land(folder, n):
        for i in range(n):
            df = spark.range(i, i + 1).withColumn("name", F.lit("x")) if i % 2 else spark.range(i, i + 1).select(F.col("id").cast("int"), F.lit(1.5).alias("size"))
            df.coalesce(1).write.parquet(f"{folder}/part {i}")
        return [f"{folder}/part {i}" for i in range(n)]

    few, many = land(tmp_path / "few", 4), land(tmp_path / "many", 12)
    spec = FileSpec("parquet")
    assert jobs(spark, lambda: files._paths_by_footer(spark, few)) == jobs(spark, lambda: files._paths_by_footer(spark, many)) == 1
    got = files.read_mixed_files(spark, many, spec)
    assert as_set(got, "id", "name", "size") == {(i, "x" if i % 2 else None, None if i % 2 else 1.5) for i in range(12)}
    assert dict(got.dtypes)["id"] == "bigint"
    with pytest.raises(Exception):
        files.read_mixed_files(spark, many, FileSpec("parquet", allow_missing_columns=False)).count()


def test_folders_of_mixed_parquet_files_keep_their_columns(spark, tmp_path):
    spark.range(4).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(str(tmp_path / "a"))
    spark.range(4, 6).withColumn("more", F.lit("m")).write.parquet(str(tmp_path / "b"))
    got = files.read_mixed_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")], FileSpec("parquet"))
    assert as_set(got, "id", "day", "more") == {(0, 0, None), (1, 1, None), (2, 0, None), (3, 1, None), (4, None, "m"), (5, None, "m")}


# -- profiles ---------------------------------------------------------------------


def described(df):
    return {r.Column_Name: r.asDict() for r in df.collect()}


def test_the_profile_of_two_loads_is_that_of_their_union(spark, tmp_path):
    df = spark.range(5000).select(
        F.col("id").cast("int").alias("i"), F.when(F.col("id") % 7 > 0, 1e6 + F.sqrt("id")).alias("x"), F.concat(F.lit("s"), F.col("id") % 100).alias("s"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"), (F.col("id") % 2 == 0).alias("b"),
        F.create_map(F.lit("k"), "id").alias("m"), F.array("id").alias("l"), F.lit(None).cast("double").alias("n"), (F.col("id") / 3).cast("decimal(20,4)").alias("e"),
    )
    store = TableStore(spark, str(tmp_path))
    first, second = df.filter("i % 3 = 0 OR i < 1000"), df.filter("NOT (i % 3 = 0 OR i < 1000)")
    sketches.add_load(store, "log.profile", first, "one")
    sketches.add_load(store, "log.profile", second.limit(10), "two")
    sketches.add_load(store, "log.profile", second, "two")  # measured again
    sketches.add_load(store, "log.profile", df.limit(0), "none")
    got = described(sketches.profile_of_loads(store, "log.profile"))
    want = described(sketches.described(sketches.unite(sketches.measure(df)), df.schema))
    for name, row in want.items():
        mine, quantiles = got[name].pop("Quantiles"), row.pop("Quantiles")
        assert got[name] == row
        for q, near in zip((0.25, 0.5, 0.75), mine):
            if quantiles[0] is not None:
                rank = df.filter(F.col(name) <= near).count() / row["Total_Rows"] / (1 - row["Null_Count"] / 5000)
                assert abs(rank - q) < 2 * sketches.RANK_ERROR
    assert got["i"]["Total_Rows"] == 5000 and abs(got["i"]["Approx_Distinct_Values"] - 5000) < 5000 * 3 * sketches.DISTINCT_ERROR
    exact = df.agg(F.stddev_samp("x"), F.avg("x"), F.min("d"), F.count("x")).first()
    assert got["x"]["Std_Dev"] == round(exact[0], 4) and got["x"]["Mean"] == round(exact[1], 4) and got["d"]["Min"] == str(exact[2])
    assert got["s"]["Approx_Distinct_Values"] == 100 and got["m"]["Approx_Distinct_Values"] is None and got["n"]["Null_Count"] == 5000
    assert described(sketches.profile_of_loads(store, "log.profile", ["none"]))["i"]["Total_Rows"] == 0
    with pytest.raises(SpecError):
        sketches.profile_of_loads(store, "log.profile", ["nobody"])


# -- joins on ranges -----------------------------------------------------------------


@pytest.fixture
def sides(spark):
    rnd = random.Random(5)
    a = [(i, rnd.choice([rnd.uniform(-50, 50), float(rnd.randrange(-50, 50)), None]) if i % 9 else float("nan")) for i in range(90)]
    b = [(i, low := float(rnd.randrange(-60, 60)), low + rnd.choice([0.0, 0.5, 3.0, 40.0, -2.0, 1e9]) if i % 8 else None) for i in range(70)]
    b += [(70, float("-inf"), 0.0), (71, None, 5.0)]
    return a, b, spark.createDataFrame(a, "i int, x double"), spark.createDataFrame(b, "j int, lo double, hi double")


CASES = {
    "a.x >= b.lo AND a.x < b.hi": lambda x, lo, hi: None not in (x, lo, hi) and lo <= x < hi,
    "b.hi > a.x AND NOT (a.x < b.lo) AND b.lo <= a.x": lambda x, lo, hi: None not in (x, lo, hi) and lo <= x < hi,
    "a.x BETWEEN b.lo - 1 AND b.hi AND a.i <> b.j": None,
    "a.x >= b.lo AND (a.x < b.hi OR b.hi IS NULL)": lambda x, lo, hi: None not in (x, lo) and lo <= x and (hi is None or x < hi),
    "a.x - 2 <= b.hi AND a.x + 2 >= b.lo": lambda x, lo, hi: None not in (x, lo, hi) and x - 2 <= hi and x + 2 >= lo,
}


@pytest.mark.parametrize("how", ["inner", "left", "outer", "semi", "anti"])
@pytest.mark.parametrize("condition", list(CASES))
def test_range_joins_equal_spark_own(sides, condition, how):
    a, b, left, right = sides
    # NaN is above everything in Spark, so rows with it are kept out of the comparison
    left, right = left.filter("x IS NULL OR NOT isnan(x)"), right
    got = join_data(left, right, condition, how, "i, x", "j, lo, hi")
    want = left.alias("a").join(right.alias("b"), F.expr(condition), {"outer": "full_outer", "semi": "left_semi", "anti": "left_anti"}.get(how, how))
    assert as_set(got) == as_set(want.select(*got.columns)) and got.count() == want.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    if how == "inner" and CASES[condition]:
        assert as_set(got, "i", "j") == {(i, j) for i, x in a for j, lo, hi in b if x == x and CASES[condition](x, lo, hi)}


def test_range_joins_of_times(spark, frame):
    ddl = "j int, d0 date, d1 date, t0 timestamp, t1 timestamp"
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    b = frame(ddl, [(j, at(j * 30).date(), at(j * 30 + 100).date(), at(j * 30), at(j * 30 + j)) for j in range(20)])
    a = frame("i int, d date, t timestamp", [(i, at(i * 17).date(), at(i * 17)) for i in range(40)])
    for condition in ("a.d BETWEEN b.d0 AND b.d1", "a.t >= b.t0 AND a.t < b.t1"):
        want = a.alias("a").join(b.alias("b"), F.expr(condition)).select("i", "j")
        assert as_set(join_data(a, b, condition, "inner", "i", "j")) == as_set(want) != set()


def test_conditions_that_say_no_range(spark, frame, monkeypatch):
    from tableloom.operators import joins

    a, b = frame("i int, x int", [(1, 5)]), spark.range(1).selectExpr("2 AS j", "9 AS y", "'a' AS s")
    assert as_set(join_data(a, b, "a.x <> b.y", "inner", "i", "j")) == {(1, 2)}  # the right side is small
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", -1)
    for condition in ("a.x <> b.y", "a.x < b.y", "a.x < b.y AND a.i < b.j"):
        with pytest.raises(SpecError, match="neither an equality nor a range"):
            join_data(a, b, condition, "inner", "i", "j")
    with pytest.raises(SpecError, match="no range of numbers"):
        join_data(frame("s string", [("a",)]), b, "a.s >= b.s AND a.s <= b.s", "inner", "s", "j")
    assert ranges.read_condition(a.sparkSession, "a.x = b.y AND a.i < b.j").equality
    assert not ranges.read_condition(a.sparkSession, "a.x = a.i AND a.i < b.j").equality
