"""Queries of merges, change feeds, history, dimensions and incremental reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.operators import dimensions, merge, scd2
from tableloom.operators.merge import DeleteFlag
from tableloom.sources import tables as table_reads
from tableloom.workloads.registry import query

def at():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")

# Two states of the customer table: the second changes, drops and adds rows.
_V1 = "(SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0)"
_V2 = """(SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 11 <> 0)"""


def v1(t):
    return t.customer.filter("c_custkey % 10 <> 0").drop("c_nationkey")


def v2(t):
    raised = F.expr("CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END")
    return t.customer.filter("c_custkey % 11 <> 0").drop("c_nationkey").withColumn("c_acctbal", raised)


@query("merge_upsert", f"""
SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
  coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment FROM {_V1} t FULL JOIN {_V2} s USING (c_custkey)
""")
def merge_upsert(t):
    return merge.merge(v1(t), v2(t), ["c_custkey"])


@query("merge_upsert_full_outer", f"""
SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
  coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment FROM {_V1} t FULL JOIN {_V2} s USING (c_custkey)
""")
def merge_upsert_full_outer(t):
    """The same through the plan for large batches."""
    return merge.merge(v1(t), v2(t), ["c_custkey"], broadcast_limit=-1)


@query("merge_keeps_creation_time", f"""
SELECT c_custkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_custkey IS NOT NULL AS was_there,
  CASE WHEN t.c_custkey IS NOT NULL THEN 'old' ELSE 'new' END AS delta__created_datetime
FROM (SELECT c_custkey, c_acctbal FROM {_V1}) t FULL JOIN (SELECT c_custkey, c_acctbal FROM {_V2}) s USING (c_custkey)
""")
def merge_keeps_creation_time(t):
    old = v1(t).select("c_custkey", "c_acctbal", F.lit(True).alias("was_there"), F.lit("old").alias("delta__created_datetime"))
    new = v2(t).select("c_custkey", "c_acctbal", F.lit("new").alias("delta__created_datetime"))
    return merge.merge(old, new, ["c_custkey"]).withColumn("was_there", F.coalesce("was_there", F.lit(False)))


_FLAG = "CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END"


@query("merge_and_delete", f"""
SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
  coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, s.removed
FROM {_V1} t FULL JOIN (SELECT *, {_FLAG} AS removed FROM {_V2}) s USING (c_custkey)
WHERE NOT (t.c_name IS NOT NULL AND coalesce(s.removed = 1, false))
""")
def merge_and_delete(t):
    return merge.merge_and_delete(v1(t), v2(t).withColumn("removed", F.expr(_FLAG)), ["c_custkey"], DeleteFlag("removed", "1"))


_SOFT = "CASE WHEN c_custkey % 5 = 0 THEN 1 END"


@query("merge_mark_unmatched", f"""
SELECT c_custkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, CASE WHEN s.c_custkey IS NULL THEN 1 END AS removed
FROM (SELECT * FROM {_V1}) t FULL JOIN {_V2} s USING (c_custkey)
""")
def merge_mark_unmatched(t):
    old = v1(t).select("c_custkey", "c_acctbal", F.expr(_SOFT).alias("removed"))
    return merge.merge_mark_unmatched(old, v2(t).select("c_custkey", "c_acctbal"), ["c_custkey"], DeleteFlag("removed", "1"))


@query("merge_mark_all", f"""
SELECT c_custkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, CASE WHEN s.c_custkey IS NOT NULL THEN 'D' ELSE t.removed END AS removed
FROM (SELECT *, 'x' AS removed FROM {_V1}) t FULL JOIN {_V2} s USING (c_custkey)
""")
def merge_mark_all(t):
    old = v1(t).select("c_custkey", "c_acctbal", F.lit("x").alias("removed"))
    return merge.merge_mark_all(old, v2(t).select("c_custkey", "c_acctbal"), ["c_custkey"], DeleteFlag("removed", "D"))


@query("merge_in_batches", """
SELECT user_id, event_type, value, CAST(first_id AS BIGINT) AS first_id FROM (
  SELECT user_id, event_type, value, min(event_id) OVER (PARTITION BY user_id) AS first_id,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def merge_in_batches(t):
    """Every event is a batch of its own; the last one decides, the first one dates."""
    source = t.events.select("user_id", "event_type", "value", "event_id", F.col("event_id").alias("delta__created_datetime"))
    empty = source.filter("false")
    merged = merge.apply_merge("merge", empty, source, ["user_id"], batch_columns=["event_id"])
    return merged.select("user_id", "event_type", "value", F.col("delta__created_datetime").alias("first_id"))


@query("replace_where_range", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' OR o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
UNION ALL SELECT o_orderkey, -o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def replace_where_range(t):
    year = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    batch = year.withColumn("o_totalprice", -F.col("o_totalprice"))
    return merge.replace_where(t.orders, batch, "o_orderdate").select("o_orderkey", "o_totalprice")


@query("replace_where_values", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT o_orderkey, o_orderpriority, 0.0 FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 2 = 0
""")
def replace_where_values(t):
    batch = t.orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0))
    return merge.replace_where(t.orders, batch, "o_orderpriority", max_values=5000).select("o_orderkey", "o_orderpriority", "o_totalprice")


_FEED = f"""
SELECT c_custkey, CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
  CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.c_custkey IS NULL THEN 'delete' ELSE 'update_postimage' END AS _change_type
FROM {_V1} t FULL JOIN {_V2} s USING (c_custkey)
WHERE t.c_custkey IS NULL OR s.c_custkey IS NULL OR t.c_acctbal <> s.c_acctbal
"""


@query("change_feed", _FEED)
def change_feed(t):
    feed, _ = table_reads.read_changes(v2(t), v1(t), ["c_custkey"], 2, at())
    return feed.select("c_custkey", "c_acctbal", "_change_type")


@query("change_feed_initial", f"SELECT c_custkey, c_acctbal, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM {_V1}")
def change_feed_initial(t):
    feed, _ = table_reads.read_changes(v1(t), None, ["c_custkey"], 1, at())
    return feed.select("c_custkey", "c_acctbal", "_change_type", "_commit_version")


@query("change_feed_merge", f"SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM {_V2}")
def change_feed_merge(t):
    """Applying the changes between two states to the first gives the second."""
    feed = merge.change_feed(v1(t), v2(t), ["c_custkey"], 2, at())
    return merge.merge_and_delete(v1(t), feed, ["c_custkey"], merge.FEED_DELETE)


_H1 = f"(SELECT c_custkey, c_acctbal, 0 AS removed, TIMESTAMP '2024-01-01' AS at FROM {_V1})"
_H2 = f"(SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS removed, TIMESTAMP '2024-02-01' AS at FROM {_V2})"
_HISTORY = f"""
WITH j AS (SELECT coalesce(t.c_custkey, s.c_custkey) AS k, t.c_acctbal AS tb, s.c_acctbal AS sb, t.c_custkey IS NOT NULL AS in_t,
  s.c_custkey IS NOT NULL AS in_s, s.removed = 1 AS gone, t.c_acctbal IS DISTINCT FROM s.c_acctbal OR s.removed = 1 AS differs
  FROM {_H1} t FULL JOIN {_H2} s ON t.c_custkey = s.c_custkey),
h AS (
  SELECT k, tb AS b, 0 AS removed, '2024-01-01' AS s, NULL AS e, 1 AS a FROM j WHERE in_t AND (NOT in_s OR NOT differs)
  UNION ALL SELECT k, sb, 1, '2024-01-01', '2024-02-01', 0 FROM j WHERE in_t AND in_s AND differs AND gone
  UNION ALL SELECT k, tb, 0, '2024-01-01', '2024-02-01', 0 FROM j WHERE in_t AND in_s AND differs AND NOT gone
  UNION ALL SELECT k, sb, 0, '2024-02-01', NULL, 1 FROM j WHERE in_t AND in_s AND differs AND NOT gone
  UNION ALL SELECT k, sb, 1, '2024-02-01', '2024-02-01', 0 FROM j WHERE NOT in_t AND gone
  UNION ALL SELECT k, sb, 0, '2024-02-01', NULL, 1 FROM j WHERE NOT in_t AND NOT gone)
"""


def history(t):
    flag = DeleteFlag("removed", "1")
    first = v1(t).select("c_custkey", "c_acctbal", F.lit(0).alias("removed"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    second = v2(t).select(
        "c_custkey", "c_acctbal", F.expr("CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END").alias("removed"),
        F.lit("2024-02-01").cast("timestamp").alias("at"),
    )
    return scd2.merge_history(scd2.add_history_columns(first, "at", flag), second, ["c_custkey"], "at", flag)


def _shown(df):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return df.select(
        "c_custkey", "c_acctbal", "removed", day("scd_start_date").alias("starts"), day("scd_end_date").alias("ends"), "scd_active"
    )


@query("scd2_history", _HISTORY + "SELECT k AS c_custkey, b AS c_acctbal, removed, s AS starts, e AS ends, a AS scd_active FROM h")
def scd2_history(t):
    return _shown(history(t))


@query("scd2_backdated", _HISTORY + """
SELECT k AS c_custkey, b AS c_acctbal, removed, CASE WHEN count(*) OVER (PARTITION BY k) = 1 THEN '1900-01-01' ELSE s END AS starts,
  e AS ends, a AS scd_active FROM h
""")
def scd2_backdated(t):
    return _shown(scd2.backdate_single_versions(history(t), ["c_custkey"]))


@query("scd2_as_of", _HISTORY + """
SELECT o.o_orderkey, o.o_custkey, h.b AS c_acctbal FROM (SELECT *, o_orderdate + INTERVAL 9000 DAY AS at FROM orders) o
LEFT JOIN h ON h.k = o.o_custkey AND o.at >= CAST(h.s AS TIMESTAMP) AND (h.e IS NULL OR o.at < CAST(h.e AS TIMESTAMP))
""")
def scd2_as_of(t):
    facts = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 9000 DAY")).alias("at"))
    joined = scd2.as_of(facts, history(t).drop("at"), [("o_custkey", "c_custkey")], "at", ["c_acctbal"])
    return joined.select("o_orderkey", "o_custkey", "c_acctbal")


@query("surrogate_keys", """
SELECT CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) AS BIGINT) AS order_sk, o_custkey, o_orderkey FROM orders
""")
def surrogate_keys(t):
    return dimensions.assign_surrogate_keys(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "order_sk")


@query("surrogate_keys_increment", f"""
WITH old AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS sk FROM {_V1}),
fresh AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) + (SELECT max(sk) FROM old) AS sk FROM {_V2} WHERE c_custkey NOT IN (SELECT c_custkey FROM old))
SELECT CAST(coalesce(o.sk, f.sk) AS BIGINT) AS customer_sk, s.c_custkey, s.c_acctbal FROM {_V2} s LEFT JOIN old o USING (c_custkey) LEFT JOIN fresh f USING (c_custkey)
""")
def surrogate_keys_increment(t):
    old = dimensions.assign_surrogate_keys(v1(t).select("c_custkey", "c_acctbal"), ["c_custkey"], "customer_sk")
    return dimensions.assign_surrogate_keys(v2(t).select("c_custkey", "c_acctbal"), ["c_custkey"], "customer_sk", old)


@query("unknown_member", """
SELECT s_suppkey AS supplier_sk, s_name, s_acctbal FROM supplier UNION ALL SELECT -1, NULL, NULL
""")
def unknown_member(t):
    return dimensions.append_unknown_member(t.supplier.selectExpr("s_suppkey AS supplier_sk", "s_name", "s_acctbal"), "supplier_sk")


@query("fact_attach_keys", f"""
SELECT CAST(coalesce(d.sk, -1) AS BIGINT) AS customer_sk, o.o_orderkey, d.c_mktsegment FROM orders o
LEFT JOIN (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS sk FROM {_V1}) d ON o.o_custkey = d.c_custkey
""")
def fact_attach_keys(t):
    dim = dimensions.assign_surrogate_keys(v1(t).select("c_custkey", "c_mktsegment"), ["c_custkey"], "customer_sk")
    step = {
        "Category": "attach_dimension_surrogate_key", "dimension_table_name": "dim", "dimension_table_join_logic": "a.o_custkey = b.c_custkey",
        "dimension_table_key_column_name": "customer_sk", "dimension_key_output_column_name": "customer_sk",
        "dimension_columns_to_add_to_fact": "c_mktsegment",
    }
    return t.steps(t.orders.select("o_orderkey", "o_custkey"), step, dim=dim).drop("o_custkey")


_CALENDAR = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS "Date", strftime(d, '%Y-%m-%d') AS "Date_Text", CAST(year(d) AS INTEGER) AS "Year",
  CAST(quarter(d) AS INTEGER) AS "Quarter", CAST(month(d) AS INTEGER) AS "Month", monthname(d) AS "Month_Name", left(monthname(d), 3) AS "Month_Name_Abbrev",
  CAST(day(d) AS INTEGER) AS "Day", dayname(d) AS "Day_Name", CAST(dayofweek(d) + 1 AS INTEGER) AS "Day_Of_Week", CAST(weekofyear(d) AS INTEGER) AS "Week_Of_Year",
  dayofweek(d) IN (0, 6) AS "Is_Weekend", left(monthname(d), 3) || ', ' || year(d) AS "Month_Year", CAST(-year(d) AS INTEGER) AS "Sort_Year",
  CAST(-quarter(d) AS INTEGER) AS "Sort_Quarter", CAST(-month(d) AS INTEGER) AS "Sort_Month", -CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "Sort_Day",
  CAST(-(dayofweek(d) + 1) AS INTEGER) AS "Sort_Day_Of_Week", CAST(-weekofyear(d) AS INTEGER) AS "Sort_Week_Of_Year",
"""
_DAYS = "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


def _order_days(t):
    return t.orders.select(F.to_date("o_orderdate").alias("Date")).distinct()


@query("date_dim", _CALENDAR + f'CAST(-(year(d) * 100 + month(d)) AS INTEGER) AS "Sort_Year_Month" {_DAYS}' + """
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
""")
def date_dim(t):
    """Calendar attributes of all order days, with the unknown member."""
    return dimensions.calendar(_order_days(t))


@query("date_dim_control", _CALENDAR + f"-CAST(concat(year(d), month(d)) AS INTEGER) AS \"Sort_Year_Month\" {_DAYS}")
def date_dim_control(t):
    return dimensions.calendar(_order_days(t), padded_month=False, unknown_row=False)


@query("incremental_mark", """
SELECT event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""")
def incremental_mark(t):
    return table_reads.after_mark(t.events, "ts", "datetime", "2024-01-15 00:00:00").select("event_id", "value")


@query("incremental_numeric_mark", "SELECT o_orderkey FROM orders WHERE o_orderkey > 9000 OR o_custkey > 9000")
def incremental_numeric_mark(t):
    return table_reads.after_mark(t.orders, "o_orderkey, o_custkey", "numeric", "9000").select("o_orderkey")


@query("incremental_next_mark", """
SELECT CAST(greatest((SELECT max(o_orderkey) FROM orders), (SELECT max(o_custkey) FROM orders)) AS VARCHAR) AS watermark_value
""")
def incremental_next_mark(t):
    return table_reads.next_mark(t.orders, "o_orderkey, o_custkey")
