"""Whole runs of a table, and scans that need a store or a database of their own."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.operators import graph, sketches
from tableloom.operators.candidates import similar_texts
from tableloom.operators.joins import join_data
from tableloom.operators.merge import DeleteFlag
from tableloom.plans.run import SourceSpec, TableSpec, run_table
from tableloom.session import shared_folder
from tableloom.sources import files, tables
from tableloom.sources.files import FileSpec
from tableloom.sources.store import TableStore
from tableloom.workloads.registry import query

NOW = datetime(2024, 5, 1)
_STAMPS = ("delta__created_datetime", "delta__modified_datetime")


def _store(t) -> TableStore:
    return TableStore(t.spark, f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}")


def _run(t, store: TableStore, rows: DataFrame, mark: str | None = None, **spec):
    store.register("src", rows)
    settings = dict(target="silver.t", source=SourceSpec(table="src"), primary_keys=["o_orderkey"])
    return run_table(t.spark, store, TableSpec(**{**settings, **spec}), mark, now=NOW)


def _orders(t) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice", "date_format(o_orderdate, 'yyyy-MM') AS month", "cast(o_orderdate AS date) AS day")


def _result(store: TableStore, name: str = "silver.t") -> DataFrame:
    return store.read(name).drop(*_STAMPS)


def _folder(c: str = "_metadata.file_path") -> Column:
    return F.regexp_extract(c, "([^/]*)$", 1)


_BATCH = "SELECT min(day) + 100 AS lo, min(day) + 160 AS hi FROM o"
_ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderdate AS DATE) AS day FROM orders)"


def _replaced(t) -> tuple[TableStore, DataFrame]:
    """All orders by month, then two months' worth of days replaced by their dearer orders; also which files there were before."""
    store, rows = _store(t), _orders(t)
    spec = dict(merge_type="replace_where", replace_column="day", partition_by=["month"])
    _run(t, store, rows, **spec)
    before = store.read("silver.t").select("month", _folder().alias("file")).distinct()
    before = t.spark.createDataFrame(before.collect(), "month string, file string")
    first = rows.agg(F.min("day")).scalar()
    inside = rows.filter(F.col("day").between(F.date_add(first, 100), F.date_add(first, 160)))
    ends = inside.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.array("a", "b")).alias("day"))
    kept = inside.filter("o_totalprice > 200000").unionByName(inside.join(ends, "day", "left_semi").select(*inside.columns)).distinct()
    _run(t, store, kept.withColumn("o_totalprice", -F.col("o_totalprice")), **spec)
    return store, before


@query("replace_where_partitions", f"""
WITH {_ORDERS}, b AS ({_BATCH}), i AS (SELECT o.* FROM o, b WHERE day BETWEEN lo AND hi),
e AS (SELECT min(day) AS a, max(day) AS z FROM i)
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.month, o.day FROM o, b WHERE day NOT BETWEEN lo AND hi
UNION ALL SELECT o_orderkey, o_custkey, -o_totalprice, month, day FROM i, e WHERE o_totalprice > 200000 OR day IN (a, z)
""")
def replace_where_partitions(t):
    """A run that replaces a range of days rewrites the months it touches."""
    return _result(_replaced(t)[0])


@query("replace_where_untouched_files", f"""
WITH {_ORDERS}, b AS ({_BATCH}), h AS (SELECT DISTINCT month FROM o, b WHERE day BETWEEN lo AND hi)
SELECT month, month NOT IN (SELECT month FROM h) AS same_files FROM (SELECT DISTINCT month FROM o)
""")
def replace_where_untouched_files(t):
    """By file names: the months outside the range have the files they had."""
    store, before = _replaced(t)
    after = store.read("silver.t").select("month", _folder().alias("file")).distinct().withColumn("kept", F.lit(True))
    return before.join(after, ["month", "file"], "left").groupBy("month").agg(F.bool_and(F.coalesce("kept", F.lit(False))).alias("same_files"))


@query("merge_touched_partitions", f"""
WITH {_ORDERS} SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 3 THEN 0.5 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 10 = 3 THEN '1999-01' ELSE month END AS month, day
FROM o WHERE NOT (o_orderkey % 10 = 7)
UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_totalprice, month, day FROM o WHERE o_orderkey % 10 = 5
""")
def merge_touched_partitions(t):
    """Updated rows move to another partition, flagged ones go, new ones come."""
    store, rows = _store(t), _orders(t)
    spec = dict(merge_type="merge_and_delete", delete=DeleteFlag("gone", "1"), partition_by=["month"])
    _run(t, store, rows.withColumn("gone", F.lit(0)), **spec)
    moved = rows.filter("o_orderkey % 10 = 3").withColumns({"month": F.lit("1999-01"), "o_totalprice": F.lit(0.5), "gone": F.lit(0)})
    dropped = rows.filter("o_orderkey % 10 = 7").withColumn("gone", F.lit(1))
    new = rows.filter("o_orderkey % 10 = 5").withColumns({"o_orderkey": F.col("o_orderkey") + 1000000000, "gone": F.lit(0)})
    _run(t, store, moved.unionByName(dropped).unionByName(new), **spec)
    return _result(store).drop("gone")


@query("run_appends_and_quarantines", f"""
WITH {_ORDERS} SELECT 'clean' AS kept_in, o_orderkey, month FROM o WHERE o_totalprice >= 50000 UNION ALL SELECT 'quarantine', o_orderkey, month FROM o WHERE o_totalprice < 50000
UNION ALL SELECT 'clean', o_orderkey, month FROM o WHERE o_totalprice >= 50000 AND o_orderkey % 2 = 0 UNION ALL SELECT 'quarantine', o_orderkey, month FROM o WHERE o_totalprice < 50000 AND o_orderkey % 2 = 0
""")
def run_appends_and_quarantines(t):
    """A first run and one that appends; both hold rows back and log what they did."""
    store, rows = _store(t), _orders(t).select("o_orderkey", "o_totalprice", "month")
    check = {"Category": "validate_range", "column_name": "o_totalprice", "min_value": "50000", "if_not_compliant": "quarantine", "message": "cheap"}
    spec = dict(merge_type="append", checks=[check])
    _run(t, store, rows, **spec)
    _run(t, store, rows.filter("o_orderkey % 2 = 0"), **spec)
    side = lambda name, kind: store.read(name).select(F.lit(kind).alias("kept_in"), "o_orderkey", "month")
    return side("silver.t", "clean").unionByName(side("silver.t_quarantined", "quarantine"))


@query("run_log", """
SELECT * FROM (VALUES (1, 'Processed', (SELECT count(*) FROM orders)), (2, 'Processed', 0), (3, 'Processed', (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)), (4, 'Processed', 1))
  AS v(run, status, records)
""")
def run_log(t):
    """An incremental run, one without news, an overwrite, and a full reload, as the log has them."""
    store, rows = _store(t), t.orders.select("o_orderkey", "o_orderdate")
    source = SourceSpec(table="src", mark_columns=["o_orderdate"])
    first = _run(t, store, rows, source=source)
    _run(t, store, rows, first.mark, source=source)
    _run(t, store, rows.filter("o_orderkey % 2 = 0"), merge_type="overwrite")
    _run(t, store, rows.orderBy("o_orderkey").limit(1), full_reload=True)
    log = store.read("log.runs")
    order = F.row_number().over(Window.orderBy("Ingestion_End_Time"))
    return log.select(order.alias("run"), F.col("Ingestion_Status").alias("status"), F.col("Records_Processed").cast("bigint").alias("records"))


@query("run_overwrites", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def run_overwrites(t):
    store, rows = _store(t), t.orders.select("o_orderkey")
    _run(t, store, rows)
    _run(t, store, rows.filter("o_orderkey % 2 = 0"), merge_type="overwrite")
    return _result(store)


@query("run_staged_folders", """
SELECT o_orderkey, folder FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '20240102000000' ELSE '20240103000000' END AS folder, o_orderkey % 3 AS r FROM orders) WHERE r < 2
""")
def run_staged_folders(t):
    """Folders named by time: a run takes those after its mark and leaves archived ones alone."""
    root = f"{shared_folder(t.spark)}/staging-{uuid.uuid4().hex}"
    for at, folder in enumerate(("20240102000000", "20240103000000", "Archived_20240104000000")):
        t.orders.filter(f"o_orderkey % 3 = {at}").select("o_orderkey").write.option("header", True).csv(f"{root}/{folder}")
    store = _store(t)
    source = SourceSpec(staging_folder=root, files=FileSpec("csv"))
    result = run_table(t.spark, store, TableSpec("bronze.t", source, layer="bronze", merge_type="append"), "20240101000000", now=NOW)
    assert result.mark == "20240103000000"
    return store.read("bronze.t").select("o_orderkey", F.regexp_extract("delta__raw_folderpath", "/([0-9]{14})/", 1).alias("folder"))


@query("run_custom_source", "SELECT o_orderkey, 'after 5' AS said FROM orders WHERE o_orderkey > 5")
def run_custom_source(t):
    """A source function receives the mark and gives rows and the next mark."""
    def rows(metadata: dict, spark) -> tuple[DataFrame, str]:
        return t.orders.select("o_orderkey").filter(F.col("o_orderkey") > int(metadata["watermark_value"])).withColumn("said", F.lit(f"after {metadata['watermark_value']}")), "9"

    store = _store(t)
    made = run_table(t.spark, store, TableSpec("silver.t", SourceSpec(function=rows), primary_keys=["o_orderkey"]), "5", now=NOW)
    assert made.mark == "9"
    return _result(store)


@query("run_output_file", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, 'report.txt' AS file FROM supplier")
def run_output_file(t):
    """A run whose target is a path writes one file of exactly this name; a second run replaces it."""
    store, root = _store(t), f"{shared_folder(t.spark)}/out-{uuid.uuid4().hex}"
    for rows in (t.supplier.limit(3), t.supplier):
        _run(t, store, rows.select("s_suppkey", "s_name"), target=f"{root}/%Y/report.txt", primary_keys=["s_suppkey"])
    made = t.spark.read.option("sep", "\t").option("header", True).csv(f"{root}/2024/report.txt")
    return made.select("s_suppkey", "s_name", _folder().alias("file"))


@query("run_schema_log", """
SELECT * FROM (VALUES ('schemas', 'silver.t', CAST(NULL AS VARCHAR), 2), ('changes', 'silver.t', 'Column Added: size int', 1)) AS v(log, entity, change, n)
""")
def run_schema_log(t):
    """Two layouts of a target are two rows of the schema log, and what changed between them is one row."""
    store, rows = _store(t), t.part.select(F.col("p_partkey").alias("o_orderkey"), "p_name")
    for df in (rows, rows, rows.withColumn("size", F.lit(1))):
        _run(t, store, df, schema_id=True)
    schemas = store.read("log.schemas").groupBy(F.col("Target_Entity").alias("entity")).agg(F.count_distinct("Schema_ID").cast("int").alias("n"))
    changes = store.read("log.schema_changes").groupBy(
        F.col("Target_Entity").alias("entity"), F.format_string("%s: %s %s", "Change_Type", "Column_Name", "Data_Type_Details").alias("change")
    ).agg(F.count(F.lit(1)).cast("int").alias("n"))
    return schemas.select(F.lit("schemas").alias("log"), "entity", F.lit(None).cast("string").alias("change"), "n").unionByName(
        changes.withColumn("log", F.lit("changes")))


@query("run_schema_ids", """
SELECT o_orderkey, md5('o_orderkey:bigint,p_name:string' || CASE WHEN o_orderkey % 2 = 0 THEN ',size:int' ELSE '' END) AS id FROM (SELECT p_partkey AS o_orderkey FROM part)
""")
def run_schema_ids(t):
    """Each row carries the identity of the layout it came in."""
    store, rows = _store(t), t.part.select(F.col("p_partkey").alias("o_orderkey"), "p_name")
    _run(t, store, rows, schema_id=True)
    _run(t, store, rows.filter("o_orderkey % 2 = 0").withColumn("size", F.lit(1)), schema_id=True)
    return store.read("silver.t").select("o_orderkey", F.col("delta__schema_id").alias("id"))


@query("run_custom_files", "SELECT CAST(s_suppkey AS VARCHAR) AS o_orderkey, upper(s_name) AS name, 1 AS paths FROM supplier")
def run_custom_files(t):
    """A function reads the files of a run instead of Spark's reader: it gets their paths and the specification."""
    def lines(file_paths: list[str], metadata: dict, spark) -> DataFrame:
        cells = F.split("value", metadata["delimiter"])
        return spark.read.options(**metadata["options"]).text(file_paths).select(cells[0].alias("o_orderkey"), F.upper(cells[1]).alias("name"), F.lit(len(file_paths)).alias("paths"))

    folder = f"{shared_folder(t.spark)}/landing-{uuid.uuid4().hex}"
    t.supplier.select(F.concat_ws(";", "s_suppkey", "s_name").alias("value")).write.text(folder)
    store = _store(t)
    source = SourceSpec(wildcard_folder=folder, wildcard_pattern="*.txt", files=FileSpec("txt", delimiter=";", function=lines))
    run_table(t.spark, store, TableSpec("silver.t", source, primary_keys=["o_orderkey"]), now=NOW)
    return _result(store)


@query("type_ddl", """
SELECT * FROM (VALUES ('orders', '`o_orderkey` BIGINT, `nested one` STRUCT<`a``b`: ARRAY<STRING>, `m`: MAP<STRING, DECIMAL(10,2)>>', true, (SELECT count(*) FROM orders))) AS v(name, ddl, same, n)
""")
def type_ddl(t):
    """DDL text of nested types, quoted at every depth, and back."""
    from tableloom.functions.dbtypes import ddl_of

    nested = F.struct(F.array("o_orderpriority").alias("a`b"), F.create_map(F.lit("x"), F.col("o_totalprice").cast("decimal(10,2)")).alias("m"))
    df = t.orders.select("o_orderkey", nested.alias("nested one"))
    ddl = ddl_of(df.schema)
    same = df.schema.simpleString() == type(df.schema).fromDDL(ddl).simpleString()
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("orders").alias("name"), F.lit(ddl.replace(" NOT NULL", "")).alias("ddl"), F.lit(same).alias("same"), "n")


# -- scans, joins, hierarchies, profiles --------------------------------------------


@query("join_on_range_alone", """
SELECT e.event_id, o.o_orderkey FROM events e JOIN orders o
  ON e.value >= o.o_totalprice / 3000 AND e.value < o.o_totalprice / 3000 + CASE WHEN o.o_orderkey % 5 = 0 THEN 0.5 ELSE 0.02 END
""")
def join_on_range_alone(t):
    """A point in an interval, with intervals of very different lengths and no equality at all."""
    bands = t.orders.selectExpr("o_orderkey", "o_totalprice / 3000 AS low", "o_totalprice / 3000 + CASE WHEN o_orderkey % 5 = 0 THEN 0.5D ELSE 0.02D END AS high")
    return join_data(t.events.select("event_id", "value"), bands, "a.value >= b.low AND a.value < b.high", "inner", "event_id", "o_orderkey")


@query("join_outer_on_range_alone", """
SELECT c.c_custkey, s.s_suppkey FROM (SELECT * FROM customer WHERE c_acctbal < 500) c LEFT JOIN supplier s ON c.c_acctbal BETWEEN s.s_acctbal - 20 AND s.s_acctbal + 20
""")
def join_outer_on_range_alone(t):
    """Balances below 500 and the suppliers near them, or none."""
    return join_data(t.customer.filter("c_acctbal < 500"), t.supplier, "a.c_acctbal BETWEEN b.s_acctbal - 20 AND b.s_acctbal + 20", "left", "c_custkey", "s_suppkey")


@query("hierarchy_deep", """
WITH RECURSIVE n AS (SELECT o_orderkey AS id, lag(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS up FROM orders),
r AS (SELECT id AS node, id AS root, 0 AS depth FROM n WHERE up IS NULL UNION ALL SELECT n.id, r.root, r.depth + 1 FROM r JOIN n ON n.up = r.node)
SELECT node, root, depth FROM r
""")
def hierarchy_deep(t):
    """Each order hangs on the one before it of the same status: chains of thousands."""
    before = F.lag("o_orderkey").over(Window.partitionBy("o_orderstatus").orderBy("o_orderkey"))
    return graph.flatten_hierarchy(t.orders.select(F.col("o_orderkey").alias("id"), before.alias("up")), "id", "up", paths=False)


@query("source_mixed_parquet", """
SELECT c_custkey AS id, c_name AS name, CAST(NULL AS INTEGER) AS size FROM customer UNION ALL SELECT p_partkey, NULL, p_size FROM part
""")
def source_mixed_parquet(t):
    """Parquet files of two layouts in many files: footers are read in one job, each layout in one scan."""
    root = f"{shared_folder(t.spark)}/landing-{uuid.uuid4().hex}"
    t.customer.selectExpr("c_custkey AS id", "c_name AS name").repartition(5).write.parquet(f"{root}/a")
    t.part.selectExpr("p_partkey AS id", "p_size AS size").repartition(4).write.parquet(f"{root}/b")
    return files.read_mixed_files(t.spark, [f"{root}/a", f"{root}/b"], FileSpec("parquet")).drop("delta__raw_folderpath")


@query("jdbc_equal_parts", """
SELECT 8 AS parts, true AS balanced, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, count(DISTINCT o_orderkey) AS different FROM orders
""")
def jdbc_equal_parts(t):
    """A database table in which one day has a third of all rows, read in parts within two times of each other."""
    url, driver = f"jdbc:derby:memory:parts{uuid.uuid4().hex};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1996-01-02").cast("date")).otherwise(F.col("o_orderdate").cast("date"))
    t.orders.select(F.col("o_orderkey").cast("int").alias("ID"), hot.alias("DAY")).coalesce(2).write.jdbc(url, "ORDERS", properties={"driver": driver})
    parts = tables.depth_predicates(t.spark, url, "ORDERS", driver, "DAY", 8, "ID", "DATE('{}')")
    sized = tables.read_jdbc(t.spark, url, "ORDERS", driver, predicates=parts).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("ID").cast("bigint")).alias("keys"), F.count_distinct("ID").alias("different"))
    return sized.agg(
        F.count(F.lit(1)).cast("int").alias("parts"), (F.max("n") <= 2 * F.min("n")).alias("balanced"), F.sum("n").alias("n"), F.sum("keys").alias("keys"),
        F.sum("different").alias("different"),
    )


_PROFILED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"}


@query("profile_of_loads", " UNION ALL ".join(f"""
SELECT '{c}' AS "Column_Name", '{k}' AS "Data_Type", count(*) AS "Total_Rows", 6 AS "Total_Columns", count(*) - count({c}) AS "Null_Count", true AS distinct_near,
  {f"round(avg({c}), 4)" if k in ("bigint", "double") else "CAST(NULL AS DOUBLE)"} AS "Mean", {f"round(stddev_samp({c}), 4)" if k in ("bigint", "double") else "CAST(NULL AS DOUBLE)"} AS "Std_Dev",
  true AS median_near FROM orders""" for c, k in _PROFILED.items()))
def profile_of_loads(t):
    """Two loads measured apart and united: exact figures equal, sketches lie within their bounds of the exact ones."""
    store, rows = _store(t), t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).select(*_PROFILED)
    for load, part in (("first", "o_orderkey % 3 = 0"), ("second", "o_orderkey % 3 <> 0")):
        sketches.add_load(store, "log.profile", rows.filter(part), load)
    got = sketches.profile_of_loads(store, "log.profile")
    numbers = [c for c, k in _PROFILED.items() if k in ("bigint", "double")]
    medians = got.filter(F.col("Column_Name").isin(numbers)).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("Column_Name", F.element_at("Quantiles", 2)))).alias("m"))
    exact = rows.withColumn("m", medians.scalar()).agg(*[
        F.struct(F.count_distinct(c).alias("different"), (F.avg((F.col(c) <= F.col("m")[c]).cast("double")) if c in numbers else F.lit(0.5)).alias("rank")).alias(c) for c in _PROFILED
    ]).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, _PROFILED)), F.array(*_PROFILED))).alias("Column_Name", "e"))
    near = F.abs(F.col("Approx_Distinct_Values") - F.col("e.different")) <= 4 * sketches.DISTINCT_ERROR * F.col("e.different") + 1
    return got.join(exact, "Column_Name").select(
        "Column_Name", "Data_Type", "Total_Rows", "Total_Columns", "Null_Count", near.alias("distinct_near"), "Mean", "Std_Dev",
        (F.abs(F.col("e.rank") - 0.5) <= 3 * sketches.RANK_ERROR).alias("median_near"),
    )


_NAMES = "SELECT p_partkey AS id, p_brand AS block, p_name AS t FROM part"


@query("er_low_floor", f"""
WITH n AS ({_NAMES}) SELECT a.id AS id_a, b.id AS id_b FROM n a JOIN n b ON a.block = b.block AND a.id < b.id
WHERE levenshtein(a.t, b.t) <= floor(greatest(length(a.t), length(b.t)) * 0.45 + 1e-9)
""")
def er_low_floor(t):
    """Names of parts of one brand that agree in little more than half of their letters."""
    return similar_texts(t.part.selectExpr("p_partkey AS id", "p_brand AS block", "p_name AS t"), None, 0.55)
