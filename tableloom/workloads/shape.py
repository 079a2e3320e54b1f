"""Queries of the column, null, join, aggregate, window, text and time steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions import names as name_ops, text as text_ops
from tableloom.operators import nested, windows
from tableloom.workloads.registry import query


def step(category: str, **attributes: str) -> dict:
    return {"Category": category, **attributes}


@query("sales_analytics", """
WITH combined AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment,
         l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, p.p_name, p.p_brand, p.p_retailprice
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN part p ON l.l_partkey = p.p_partkey),
valid AS (SELECT * FROM combined WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL
          AND l_extendedprice > 0 AND l_quantity > 0),
dedup AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey
          ORDER BY o_orderdate DESC, o_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1)
SELECT o_orderkey, o_custkey, l_partkey,
  regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'X', 'g'), '[0-9]', 'X', 'g') AS c_name,
  p_name, p_brand, l_quantity, l_extendedprice,
  round((l_extendedprice - p_retailprice * l_quantity) / l_extendedprice * 100, 2) AS profit_margin,
  CASE WHEN l_extendedprice >= 50000 THEN 'Premium' WHEN l_extendedprice >= 10000 THEN 'Standard' ELSE 'Basic' END AS segment,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_since_order,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE)
        / count(*) OVER (PARTITION BY o_custkey), 4) AS customer_avg,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, l_partkey DESC) AS INTEGER) AS customer_rank
FROM dedup
""")
def sales_analytics(t):
    """Join, validate, keep the latest row per key, derive, mask and rank: the end-to-end example."""
    kept = t.steps(
        t.lineitem,
        step("join_data", right_table_name="orders", join_type="left", join_condition="a.l_orderkey = b.o_orderkey",
             left_columns="l_partkey, l_linenumber, l_quantity, l_extendedprice",
             right_columns="o_orderkey, o_custkey, o_orderdate"),
        step("join_data", right_table_name="customer", join_type="left", join_condition="a.o_custkey = b.c_custkey",
             right_columns="c_name"),
        step("join_data", right_table_name="part", join_type="left", join_condition="a.l_partkey = b.p_partkey",
             right_columns="p_name, p_brand, p_retailprice"),
        step("filter_data", filter_logic="o_custkey IS NOT NULL AND l_partkey IS NOT NULL "
             "AND l_extendedprice > 0 AND l_quantity > 0"),
        step("drop_duplicates", column_name="o_custkey, l_partkey",
             order_by="o_orderdate, o_orderkey, l_linenumber, l_extendedprice, l_quantity"),
        step("derived_column", column_name="profit_margin",
             expression="round((l_extendedprice - p_retailprice * l_quantity) / l_extendedprice * 100, 2)"),
        step("conditional_column", column_name="segment", conditions="l_extendedprice >= 50000; l_extendedprice >= 10000",
             values="Premium; Standard", default_value="Basic", values_delimiter=";"),
        step("derived_column", column_name="as_of", expression="DATE '2002-01-01'"),
        step("transform_datetime", operation="date_diff", column_name="o_orderdate", end_date_column="as_of",
             output_column_name="days_since_order"),
        step("mask_sensitive_data", column_name="c_name"),
        step("derived_column", column_name="exact_price", expression="cast(l_extendedprice AS decimal(18,2))"),
        orders=t.orders, customer=t.customer, part=t.part,
    )
    return t.steps(
        kept,
        step("add_window_function", window_function="sum", column_name="exact_price", partition_by="o_custkey",
             output_column_name="customer_total"),
        step("add_window_function", window_function="count", column_name="l_partkey", partition_by="o_custkey",
             output_column_name="n"),
        step("add_window_function", window_function="row_number", partition_by="o_custkey",
             order_by="o_orderdate, o_orderkey, l_partkey", order_direction="desc", output_column_name="customer_rank"),
        step("derived_column", column_name="customer_total", expression="cast(customer_total AS double)"),
        step("derived_column", column_name="customer_avg", expression="round(customer_total / n, 4)"),
        step("select_columns", column_name="o_orderkey, o_custkey, l_partkey, c_name, p_name, p_brand, l_quantity, "
             "l_extendedprice, profit_margin, segment, days_since_order, customer_total, customer_avg, customer_rank"),
    )


@query("union_city_metrics", """
SELECT city, l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS total_quantity, min(l_discount) AS min_discount,
  max(l_tax) AS max_tax, count(*) AS trips, count(DISTINCT l_suppkey) AS suppliers
FROM (SELECT *, 'north' AS city FROM lineitem WHERE l_suppkey % 2 = 0
      UNION ALL SELECT *, 'south' AS city FROM lineitem WHERE l_suppkey % 2 = 1)
GROUP BY city, l_returnflag
""")
def union_city_metrics(t):
    north = t.lineitem.filter("l_suppkey % 2 = 0").withColumn("city", F.lit("north"))
    south = t.lineitem.filter("l_suppkey % 2 = 1").withColumn("city", F.lit("south"))
    return t.steps(
        north,
        step("union_data", union_tables="south"),
        step("aggregate_data", group_by_columns="city, l_returnflag",
             column_name="l_quantity, l_discount, l_tax, l_orderkey, l_suppkey",
             aggregation="sum, min, max, count, count_distinct",
             output_column_name="total_quantity, min_discount, max_tax, trips, suppliers"),
        south=south,
    )


@query("union_by_position_distinct", """
SELECT c_nationkey AS k, c_mktsegment AS v FROM customer UNION SELECT p_size, p_type FROM part
""")
def union_by_position_distinct(t):
    return t.steps(
        t.customer.selectExpr("c_nationkey AS k", "c_mktsegment AS v"),
        step("union_data", union_tables="parts", union_type="by_position", deduplicate="true"),
        parts=t.part.select("p_size", "p_type"),
    )


@query("union_missing_columns", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS size FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part
""")
def union_missing_columns(t):
    return t.steps(
        t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"),
        step("union_data", union_tables="parts", allow_missing_columns="true"),
        parts=t.part.selectExpr("p_partkey AS id", "p_name AS name", "p_size AS size"),
    )


@query("bucket_summary", """
SELECT size_bucket, count(*) AS parts, round(avg(CAST(p_retailprice AS DECIMAL(18,2))), 2) AS avg_price, min(p_size) AS min_size
FROM (SELECT *, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_bucket FROM part)
GROUP BY size_bucket
""")
def bucket_summary(t):
    return t.steps(
        t.part,
        step("conditional_column", column_name="size_bucket", conditions="p_size < 10, p_size < 30", values="small, medium",
             default_value="large"),
        step("derived_column", column_name="price", expression="cast(p_retailprice AS decimal(18,2))"),
        step("aggregate_data", group_by_columns="size_bucket", column_name="p_partkey, price, p_size",
             aggregation="count, avg, min", output_column_name="parts, avg_price, min_size"),
        step("derived_column", column_name="avg_price", expression="cast(round(avg_price, 2) AS double)"),
    )


@query("aggregate_global", """
SELECT count(o_orderkey) AS orders, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS dearest,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
""")
def aggregate_global(t):
    return t.steps(
        t.orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)")),
        step("aggregate_data", column_name="o_orderkey, o_custkey, o_totalprice, price",
             aggregation="count, count_distinct, max, sum", output_column_name="orders, customers, dearest, total"),
        step("change_data_types", column_name="total", new_type="double"),
    )


@query("pivot_returnflag", """
SELECT l_suppkey, CAST(sum(l_quantity) FILTER (l_returnflag = 'A') AS DOUBLE) AS A,
  CAST(sum(l_quantity) FILTER (l_returnflag = 'N') AS DOUBLE) AS N,
  CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS DOUBLE) AS R FROM lineitem GROUP BY l_suppkey
""")
def pivot_returnflag(t):
    return t.steps(
        t.lineitem,
        step("pivot_data", group_columns="l_suppkey", pivot_column="l_returnflag", value_column="l_quantity", aggregation="sum"),
    )


@query("pivot_several", """
SELECT l_linestatus, min(l_quantity) FILTER (l_returnflag = 'A') AS a_min, count(l_tax) FILTER (l_returnflag = 'A') AS a_n,
  min(l_quantity) FILTER (l_returnflag = 'R') AS r_min, count(l_tax) FILTER (l_returnflag = 'R') AS r_n
FROM lineitem GROUP BY l_linestatus
""")
def pivot_several(t):
    out = t.steps(
        t.lineitem,
        step("pivot_data", group_columns="l_linestatus", pivot_column="l_returnflag", value_column="l_quantity, l_tax",
             aggregation="min, count", pivot_values="A, R"),
    )
    return out.toDF("l_linestatus", "a_min", "a_n", "r_min", "r_n")


@query("unpivot_prices", """
SELECT p_partkey, 'p_retailprice' AS measure, p_retailprice AS amount FROM part
UNION ALL SELECT p_partkey, 'half', CASE WHEN p_size > 25 THEN p_retailprice / 2 END FROM part
""")
def unpivot_prices(t):
    return t.steps(
        t.part.withColumn("half", F.expr("CASE WHEN p_size > 25 THEN p_retailprice / 2 END")),
        step("unpivot_data", id_columns="p_partkey", value_columns="p_retailprice, half", variable_name="measure",
             value_name="amount"),
    )


@query("dedup_latest_event", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest_event(t):
    return t.steps(
        t.events,
        step("drop_duplicates", column_name="user_id, event_type", order_by="ts, event_id", order_direction="desc"),
        step("select_columns", column_name="event_id, user_id, event_type, value"),
    )


@query("dedup_exact", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def dedup_exact(t):
    return t.steps(
        t.customer, step("select_columns", column_name="c_nationkey, c_mktsegment"), step("drop_duplicates", column_name="*")
    )


def _join(name: str, kind: str, sql: str) -> None:
    @query(f"join_{name}", sql)
    def run(t, kind=kind):
        return t.steps(
            t.orders,
            step("join_data", right_table_name="rich", join_type=kind, join_condition="a.o_custkey = b.c_custkey",
                 left_columns="o_orderkey, o_custkey, o_totalprice", right_columns="c_custkey, c_name, c_acctbal"),
            rich=t.customer,
        )


_A = "orders a"
_B = "customer b"
_AB = "SELECT a.o_orderkey, a.o_custkey, a.o_totalprice, b.c_custkey, b.c_name, b.c_acctbal"
for _name, _kind, _join_sql in (("inner", "inner", "JOIN"), ("left", "left", "LEFT JOIN"), ("full", "full_outer", "FULL JOIN")):
    _join(_name, _kind, f"{_AB} FROM {_A} {_join_sql} {_B} ON a.o_custkey = b.c_custkey")


def _exists(name: str, sql: str) -> None:
    @query(f"join_{name}", sql)
    def run(t, name=name):
        return t.steps(
            t.customer,
            step("join_data", right_table_name="orders", join_type=name, join_condition="a.c_custkey = b.o_custkey",
                 left_columns="c_custkey, c_name, c_acctbal", right_columns="o_orderkey"),
            orders=t.orders,
        )


for _name, _not in (("semi", ""), ("anti", "NOT ")):
    _exists(_name, f"SELECT c_custkey, c_name, c_acctbal FROM customer c WHERE {_not}EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey)")


@query("join_range", """
SELECT a.o_orderkey, a.o_totalprice, b.band FROM orders a
LEFT JOIN (SELECT s_nationkey AS band, min(s_acctbal) * 50 AS low, max(s_acctbal) * 50 AS high FROM supplier GROUP BY s_nationkey) b
ON a.o_orderpriority <> '5-LOW' AND a.o_totalprice >= b.low AND a.o_totalprice < b.high AND a.o_custkey % 25 = b.band
""")
def join_range(t):
    bands = t.supplier.groupBy(F.col("s_nationkey").alias("band")).agg(
        (F.min("s_acctbal") * 50).alias("low"), (F.max("s_acctbal") * 50).alias("high")
    )
    return t.steps(
        t.orders,
        step("join_data", right_table_name="bands", join_type="left", broadcast_hint="true",
             join_condition="a.o_orderpriority <> '5-LOW' AND a.o_totalprice >= b.low AND a.o_totalprice < b.high "
             "AND a.o_custkey % 25 = b.band", left_columns="o_orderkey, o_totalprice", right_columns="band"),
        bands=bands,
    )


def _window(fn: str, expr: str, order: str = "o_orderdate, o_orderkey", cast: str = "", by: str = "o_custkey") -> None:
    over = f"OVER (PARTITION BY {by} ORDER BY {order})"
    value = f"{expr} {over}" if not cast else f"CAST({expr} {over} AS {cast})"
    @query(f"window_{fn}", f"SELECT o_orderkey, {by}, {value} AS w FROM orders")
    def run(t, fn=fn, order=order, by=by):
        df = t.orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
        out = t.steps(
            df,
            step("add_window_function", window_function=fn, partition_by=by, order_by=order, output_column_name="w",
                 column_name="price" if fn in ("sum", "avg") else "o_totalprice"),
            step("select_columns", column_name=f"o_orderkey, {by}, w"),
        )
        w = {"sum": "cast(w AS double)", "avg": "cast(round(w, 2) AS double)"}.get(fn, "w")
        return out.withColumn("w", F.expr(w))


_window("row_number", "row_number()", cast="INTEGER")
_window("rank", "rank()", "o_orderdate", "INTEGER", "o_orderpriority")
_window("dense_rank", "dense_rank()", "o_orderdate", "INTEGER", "o_orderpriority")
_window("first_value", "first_value(o_totalprice)")
_window("last_value", "last_value(o_totalprice)")
_window("sum", "sum(CAST(o_totalprice AS DECIMAL(18,2)))", cast="DOUBLE")
_window("count", "count(o_totalprice)")
_window("min", "min(o_totalprice)")
_window("max", "max(o_totalprice)", "o_orderdate")
SQL_AVG = """
SELECT o_orderkey, o_custkey, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w, 4) AS w
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
"""


@query("window_avg", SQL_AVG)
def window_avg(t):
    out = windows.add_window(t.orders, "avg", "w", ["o_custkey"], ["o_orderdate", "o_orderkey"], "asc", "o_totalprice")
    return out.select("o_orderkey", "o_custkey", F.round("w", 4).alias("w"))


@query("window_totals", """
SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top_price,
  count(o_orderkey) OVER (PARTITION BY o_custkey) AS orders, max(o_orderdate) OVER () = o_orderdate AS on_last_day FROM orders
""")
def window_totals(t):
    return t.steps(
        t.orders,
        step("add_window_function", window_function="max", column_name="o_totalprice", partition_by="o_custkey", output_column_name="top_price"),
        step("add_window_function", window_function="count", column_name="o_orderkey", partition_by="o_custkey", output_column_name="orders"),
        step("add_window_function", window_function="max", column_name="o_orderdate", output_column_name="last_day"),
        step("derived_column", column_name="on_last_day", expression="o_orderdate = last_day"),
        step("select_columns", column_name="o_orderkey, top_price, orders, on_last_day"),
    )


@query("window_whole_table", """
SELECT event_id, rank() OVER (ORDER BY value DESC) AS value_rank FROM events
""")
def window_whole_table(t):
    """A rank over all rows, split over value ranges."""
    return t.steps(
        t.events,
        step("add_window_function", window_function="rank", order_by="value", order_direction="desc", output_column_name="value_rank"),
        step("select_columns", column_name="event_id, value_rank"),
    )


@query("window_hot_groups", """
SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS INTEGER) AS rn FROM events
""")
def window_hot_groups(t):
    """Every event type counts as a hot group here, so all rows take the splitting plan."""
    out = windows.add_window(t.events.drop("props"), "row_number", "rn", ["event_type"], ["value", "event_id"], "asc", hot_rows=100)
    return out.select("event_id", "event_type", "rn")


@query("sort_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_orders(t):
    return t.steps(
        t.orders, step("select_columns", column_name="o_orderkey, o_totalprice"),
        step("sort_data", column_name="o_totalprice, o_orderkey", sort_direction="desc, asc"),
    )


@query("project_columns", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment, c_acctbal * 2 AS doubled,
  CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' END AS band, CAST(c_nationkey AS VARCHAR) AS nation
FROM customer WHERE c_nationkey <> 3
""")
def project_columns(t):
    return t.steps(
        t.customer,
        step("columns_to_rename", existing_column_name="c_custkey, c_name", new_column_name="customer_id, customer_name"),
        step("filter_data", filter_logic="c_nationkey <> 3"),
        step("derived_column", column_name="doubled", expression="c_acctbal * 2"),
        step("conditional_column", column_name="band", conditions="c_acctbal < 0, c_acctbal < 1000", values="debt, low"),
        step("derived_column", column_name="nation", expression="c_nationkey"),
        step("change_data_types", column_name="nation", new_type="string"),
        step("remove_columns", column_name="c_acctbal, c_nationkey"),
    )


@query("change_types", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,1)) AS o_totalprice_dec, CAST(o_custkey AS INTEGER) AS o_custkey,
  CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
""")
def change_types(t):
    out = t.steps(
        t.orders.withColumn("o_totalprice_dec", F.col("o_totalprice")),
        step("change_data_types", column_name="o_totalprice_dec", new_type="decimal(12,1)"),
        step("change_data_types", column_name="o_custkey", new_type="int"),
        step("change_data_types", column_name="o_orderdate", new_type="date"),
    )
    return out.select("o_orderkey", "o_totalprice_dec", "o_custkey", "o_orderdate")


@query("row_hash_sha256", """
SELECT c_custkey, sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(c_name, 'NULL'), coalesce(CAST(c_nationkey AS VARCHAR), 'NULL'))) AS row_hash
FROM customer
""")
def row_hash_sha256(t):
    return t.steps(
        t.customer, step("add_row_hash", column_name="c_custkey, c_name, c_nationkey", hash_algorithm="sha256"),
        step("select_columns", column_name="c_custkey, row_hash"),
    )


@query("row_hash_xxhash64")
def row_hash_xxhash64(t):
    return t.steps(t.customer, step("add_row_hash", column_name="*"))


@query("mask_names", r"""
SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[a-z]', 'l', 'g'), '[A-Z]', 'U', 'g'), '[0-9]', '9', 'g') AS c_name
FROM customer
""")
def mask_names(t):
    return t.steps(
        t.customer, step("mask_sensitive_data", column_name="c_name", upper_char="U", lower_char="l", digit_char="9"),
        step("select_columns", column_name="c_custkey, c_name"),
    )


_SPARSE = """(SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS event_type FROM events)"""


def sparse_events(t):
    """Events with missing values and blank types."""
    return t.events.select(
        "event_id", "user_id", F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END").alias("value"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END").alias("event_type"),
    )


@query("nulls_drop_any", f"SELECT * FROM {_SPARSE} WHERE value IS NOT NULL AND event_type IS NOT NULL")
def nulls_drop_any(t):
    return t.steps(sparse_events(t), step("apply_null_handling", action="drop_rows", column_name="value, event_type"))


@query("nulls_drop_all", f"SELECT * FROM {_SPARSE} WHERE NOT (value IS NULL AND event_type IS NULL)")
def nulls_drop_all(t):
    return t.steps(sparse_events(t), step("apply_null_handling", action="drop_rows", column_name="value, event_type", logic="all"))


@query("nulls_default", f"SELECT event_id, user_id, coalesce(value, -1) AS value, event_type FROM {_SPARSE}")
def nulls_default(t):
    return t.steps(sparse_events(t), step("apply_null_handling", action="replace_with_default", column_name="value", default_value="-1"))


@query("nulls_from_values", f"""
SELECT event_id, CASE WHEN user_id IN (3, 5) THEN NULL ELSE user_id END AS user_id, value,
  CASE WHEN trim(event_type) IN ('view', 'click', '') THEN NULL ELSE event_type END AS event_type FROM {_SPARSE}
""")
def nulls_from_values(t):
    return t.steps(
        sparse_events(t),
        step("apply_null_handling", action="convert_values_to_null", column_name="event_type", values_to_convert="view, click", convert_empty_space="true"),
        step("apply_null_handling", action="convert_values_to_null", column_name="user_id", values_to_convert="3, 5"),
    )


@query("replace_values", f"""
SELECT event_id, CASE WHEN user_id IN (1, 2) THEN 99 ELSE user_id END AS user_id, value,
  CASE WHEN event_type IN ('view', 'click') THEN 'seen' ELSE event_type END AS event_type FROM {_SPARSE}
""")
def replace_values(t):
    return t.steps(
        sparse_events(t),
        step("replace_values", column_name="event_type", values_to_replace="view; click", replacement_value="seen", values_delimiter=";"),
        step("replace_values", column_name="user_id", values_to_replace="1, 2", replacement_value="99"),
    )


@query("clean_strings", f"""
SELECT event_id, user_id, value, CASE WHEN trim(event_type) = '' THEN NULL ELSE trim(event_type) END AS event_type FROM {_SPARSE}
""")
def clean_strings(t):
    return name_ops.clean_strings(sparse_events(t), "*", "*")


@query("cleanse_column_names", """
SELECT c_custkey AS "Custkey", c_name AS "Name", c_nationkey AS "Nation_Id", c_acctbal AS "Acct_Bal", c_mktsegment AS "Segment"
FROM customer
""")
def cleanse_column_names(t):
    messy = t.customer.toDF(" c_custkey", "c_name ", "c_nation--key", "c_acct bal", "c_mktsegment")
    return name_ops.cleanse_columns(messy, {
        "trim": "true", "exact_find": "key, mktsegment", "exact_replace": "key, segment", "regex_find": "^c_|--key$",
        "regex_replace": "", "replace_non_alphanumeric_with_underscore": "true", "apply_case": "title",
    }).withColumnRenamed("Nation", "Nation_Id")


@query("string_functions", """
SELECT p_partkey, upper(p_name) AS up, reverse(p_brand) AS backwards, length(p_type)::INTEGER AS n_type,
  trim(p_name) AS t_p_name, trim(p_brand) AS t_p_brand FROM part
""")
def string_functions(t):
    out = t.steps(
        t.part,
        step("string_functions", column_name="p_name", function="upper", output_column_name="up"),
        step("string_functions", column_name="p_brand", function="reverse", output_column_name="backwards"),
        step("string_functions", column_name="p_type", function="length", output_column_name="n_type"),
        step("string_functions", column_name="p_name, p_brand", function="trim", output_column_name="t"),
    )
    return out.select("p_partkey", "up", "backwards", "n_type", "t_p_name", "t_p_brand")


@query("string_soundex_initcap")
def string_soundex_initcap(t):
    return t.steps(
        t.part.select("p_partkey", "p_name"),
        step("string_functions", column_name="p_name", function="soundex", output_column_name="code"),
        step("string_functions", column_name="p_name", function="initcap", output_column_name="titled"),
    )


@query("normalize_text", r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(translate(lower(trim(text)),
  'àáâãäåèéêëìíîïòóôõöùúûüýÿñç', 'aaaaaaeeeeiiiiooooouuuuyync'), '[^a-zA-Z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS digest
FROM documents
""")
def normalize_text(t):
    return t.steps(
        t.documents.select("doc_id", "text"),
        step("normalize_text", column_name="text", operations="trim, lowercase, strip_accents, remove_special_chars, collapse_whitespace"),
        step("derived_column", column_name="digest", expression="md5(text)"),
        step("remove_columns", column_name="text"),
    )


@query("normalize_strip", r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[0-9]', '', 'g'), '[^\x00-\x7F]', '', 'g')) AS ascii_digest,
  md5(upper(regexp_replace(regexp_replace(text, '[0-9]', '', 'g'), '[^a-zA-Z0-9_\s]', '', 'g'))) AS bare_digest FROM documents
""")
def normalize_strip(t):
    return t.steps(
        t.documents.select("doc_id", "text"),
        step("normalize_text", column_name="text", operations="remove_digits, ascii_only", output_column_name="ascii"),
        step("normalize_text", column_name="text", operations="remove_digits, remove_punctuation, uppercase", output_column_name="bare"),
        step("derived_column", column_name="ascii_digest", expression="md5(ascii)"),
        step("derived_column", column_name="bare_digest", expression="md5(bare)"),
        step("select_columns", column_name="doc_id, ascii_digest, bare_digest"),
    )


@query("split_and_concat", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS level, nullif(split_part(o_orderpriority, '-', 2), '') AS label,
  CAST(NULL AS VARCHAR) AS missing, o_orderstatus || '/' || split_part(o_orderpriority, '-', 1) AS joined,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus || '+' || o_orderpriority END AS kept,
  CASE WHEN o_orderkey % 4 = 0 THEN '+' || o_orderpriority ELSE o_orderstatus || '+' || o_orderpriority END AS emptied
FROM orders
""")
def split_and_concat(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END").alias("gap"))
    return t.steps(
        df,
        step("split_column", column_name="o_orderpriority", delimiter="-", output_column_names="level, label, missing"),
        step("concat_columns", column_name="o_orderstatus, level", output_column_name="joined", separator="/"),
        step("concat_columns", column_name="gap, o_orderpriority", output_column_name="kept", separator="+", null_handling="keep"),
        step("concat_columns", column_name="gap, o_orderpriority", output_column_name="emptied", separator="+", null_handling="empty"),
        step("select_columns", column_name="o_orderkey, level, label, missing, joined, kept, emptied"),
    )


@query("redact_secrets", r"""
WITH s AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '(?i)(Bearer|Basic)\s+[A-Za-z0-9\-._~+/]+=*', '\1 [REDACTED]', 'g'),
  '(?i)(UID|PWD|Password|Access_Token)\s*=\s*[^;\s]+', '\1=[REDACTED]', 'g'),
  '(?i)(password|pwd|secret|token|key|sig|api_key|apikey|client_secret)\s*=\s*[^;&\s]+', '\1=[REDACTED]', 'g'),
  '(?i)([?&])(sig|sv|se|sp|spr|srt|ss)=([^&\s]+)', '\1\2=[REDACTED]', 'g'),
  'eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}', '[JWT REDACTED]', 'g') AS clean FROM documents),
n AS (SELECT *, ' ... [truncated, ' || length(text) || ' chars total]' AS note FROM s)
SELECT doc_id, md5(CASE WHEN length(clean) <= 4000 THEN clean ELSE substring(clean, 1, 4000 - length(note)) || note END) AS digest FROM n
""")
def redact_secrets(t):
    return t.documents.select("doc_id", F.md5(text_ops.redact_secrets(F.col("text"))).alias("digest"))


@query("datetime_parts", """
SELECT event_id, year(ts)::INTEGER AS y, month(ts)::INTEGER AS m, day(ts)::INTEGER AS d, (dayofweek(ts) + 1)::INTEGER AS dow,
  dayofyear(ts)::INTEGER AS doy, hour(ts)::INTEGER AS h, minute(ts)::INTEGER AS mi, second(ts)::INTEGER AS s,
  quarter(ts)::INTEGER AS q, weekofyear(ts)::INTEGER AS w FROM events
""")
def datetime_parts(t):
    parts = {"y": "year", "m": "month", "d": "day", "dow": "dayofweek", "doy": "dayofyear", "h": "hour", "mi": "minute",
             "s": "second", "q": "quarter", "w": "weekofyear"}
    return t.steps(
        t.events,
        *[step("transform_datetime", operation=op, column_name="ts", output_column_name=o) for o, op in parts.items()],
        step("select_columns", column_name="event_id, " + ", ".join(parts)),
    )


@query("datetime_shift", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due, CAST(o_orderdate AS DATE) - 7 AS week_before,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS follow_up, 23::INTEGER + 14::INTEGER AS span,
  strftime(o_orderdate, '%d/%m/%Y') AS shown FROM orders
""")
def datetime_shift(t):
    return t.steps(
        t.orders,
        step("transform_datetime", operation="add_days", column_name="o_orderdate", days="30", output_column_name="due"),
        step("transform_datetime", operation="subtract_days", column_name="o_orderdate", days="7", output_column_name="week_before"),
        step("transform_datetime", operation="add_months", column_name="o_orderdate", months="2", output_column_name="follow_up"),
        step("transform_datetime", operation="date_diff", column_name="week_before", end_date_column="due", output_column_name="span"),
        step("transform_datetime", operation="format_date", column_name="o_orderdate", date_format="dd/MM/yyyy", output_column_name="shown"),
        step("select_columns", column_name="o_orderkey, due, week_before, follow_up, span, shown"),
    )


@query("datetime_parse", """
SELECT event_id, strftime(ts, '%Y%m%d %H:%M') AS stamp, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS parsed FROM events
""")
def datetime_parse(t):
    return t.steps(
        t.events,
        step("transform_datetime", operation="format_date", column_name="ts", date_format="yyyyMMdd HH:mm", output_column_name="stamp"),
        step("transform_datetime", operation="to_timestamp", column_name="stamp", timestamp_format="yyyyMMdd HH:mm", output_column_name="at"),
        step("derived_column", column_name="parsed", expression="unix_seconds(cast(at AS timestamp))"),
        step("select_columns", column_name="event_id, stamp, parsed"),
    )


@query("explode_tokens", r"""
SELECT doc_id, lang, unnest(string_split_regex(text, '\s+')) AS word FROM documents
""")
def explode_tokens(t):
    return t.steps(
        t.documents.select("doc_id", "lang", F.split("text", r"\s+").alias("words")),
        step("explode_array", column_name="words", output_column_name="word"),
    )


@query("explode_outer", """
SELECT vec_id, label, unnest(CASE WHEN vec_id % 10 = 0 THEN [NULL] ELSE embedding END) AS x FROM embeddings
""")
def explode_outer(t):
    gaps = t.embeddings.withColumn("embedding", F.expr("CASE WHEN vec_id % 10 = 0 THEN NULL ELSE embedding END"))
    return t.steps(gaps, step("explode_array", column_name="embedding", output_column_name="x", preserve_nulls="true"))


@query("json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS p_k, length(props)::INTEGER AS p_n FROM events
""")
def json_props(t):
    parsed = t.events.select("event_id", F.struct(F.from_json("props", "k int").getField("k").alias("k"), F.length("props").alias("n"), F.lit(1).alias("z")).alias("p"))
    return t.steps(parsed, step("flatten_struct", column_name="p", fields_to_include="k, n"))


@query("json_rows", """
SELECT o_custkey, o_orderkey AS order_id, o_orderstatus AS status FROM orders
""")
def json_rows(t):
    """Orders packed into JSON arrays and unpacked into typed rows."""
    entry = F.struct(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    packed = t.orders.select("o_custkey", F.to_json(F.array(entry)).alias("entries"))
    return nested.rows_from_json(packed, "entries", "order_id bigint, status string")


@query("custom_function", """
SELECT c_custkey, c_acctbal, c_acctbal * 1.5 AS boosted FROM customer
""")
def custom_function(t):
    from tableloom.plans.steps import StepContext, apply_steps

    def boost(new_data, metadata, spark):
        return new_data.withColumn("boosted", F.col("c_acctbal") * float(metadata["function_config"]["factor"]))

    ctx = StepContext(t.store(), hooks={"boost": boost})
    return apply_steps(
        t.customer.select("c_custkey", "c_acctbal"),
        [step("custom_transformation_function", functions_to_execute="boost", factor="1.5")], ctx,
    )
