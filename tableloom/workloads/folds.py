"""Batched merges against a step-by-step fold, checks and hierarchies whose faults must not vanish."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.operators import graph, merge, scd2, windows
from tableloom.operators.merge import DeleteFlag
from tableloom.operators.quality import run_quality
from tableloom.spec import QUARANTINE_REASON
from tableloom.workloads.registry import query

# Events are batches in order of their id; an error removes its user. Users with an even id exist before.
_BATCHES = """
WITH RECURSIVE b AS (SELECT user_id, event_id, event_type, event_type = 'error' AS gone, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
t AS (SELECT DISTINCT c_custkey AS user_id FROM customer WHERE c_custkey % 2 = 0),
k AS (SELECT DISTINCT user_id FROM b),
f(user_id, n, live, event_id, event_type, born) AS (
  SELECT k.user_id, 0, t.user_id IS NOT NULL, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT) FROM k LEFT JOIN t ON t.user_id = k.user_id
  UNION ALL SELECT f.user_id, f.n + 1, NOT (f.live AND b.gone), b.event_id, b.event_type, CASE WHEN f.live THEN f.born ELSE b.event_id END
  FROM f JOIN b ON b.user_id = f.user_id AND b.n = f.n + 1
), l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1)
"""


def _before(t):
    return t.customer.filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").cast(dict(t.events.dtypes)["user_id"]).alias("user_id"), F.lit(None).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("event_type"), F.lit(0).cast("bigint").alias("delta__created_datetime"),
    )


def _batches(t):
    return t.events.select("user_id", F.col("event_id").cast("bigint").alias("event_id"), "event_type", F.col("event_id").cast("bigint").alias("delta__created_datetime"))


@query("merge_in_batches_delete", _BATCHES + """
SELECT user_id, event_id, event_type, born FROM l WHERE live
UNION ALL SELECT user_id, NULL, NULL, 0 FROM t WHERE user_id NOT IN (SELECT user_id FROM k)
""")
def merge_in_batches_delete(t):
    """A user removed and begun again has a new creation time; one removed in a later batch is gone."""
    out = merge.apply_merge("merge_and_delete", _before(t), _batches(t), ["user_id"], DeleteFlag("event_type", "error"), batch_columns=["event_id"])
    return out.select("user_id", "event_id", "event_type", F.col("delta__created_datetime").alias("born"))


_LAST = "SELECT user_id, max(event_id) AS event_id, max(event_id) = (SELECT max(event_id) FROM events) AS live FROM events GROUP BY user_id"


@query("merge_in_batches_mark_unmatched", f"""
WITH s AS ({_LAST})
SELECT coalesce(s.user_id, c_custkey) AS user_id, s.event_id, CASE WHEN s.live THEN NULL ELSE 1 END AS removed
FROM s FULL JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) c ON c_custkey = s.user_id
""")
def merge_in_batches_mark_unmatched(t):
    """After the last batch only its own keys are live."""
    before = _before(t).select("user_id", "event_id", F.lit(None).cast("int").alias("removed"))
    batches = _batches(t).select("user_id", "event_id")
    return merge.apply_merge("merge_mark_unmatched_deleted", before, batches, ["user_id"], DeleteFlag("removed", "1"), batch_columns=["event_id"])


@query("merge_in_batches_mark_all", f"""
WITH s AS ({_LAST})
SELECT coalesce(s.user_id, c_custkey) AS user_id, s.event_id, CASE WHEN s.user_id IS NOT NULL THEN 1 END AS removed
FROM s FULL JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) c ON c_custkey = s.user_id
""")
def merge_in_batches_mark_all(t):
    before = _before(t).select("user_id", "event_id", F.lit(None).cast("int").alias("removed"))
    batches = _batches(t).select("user_id", "event_id")
    return merge.apply_merge("merge_mark_all_deleted", before, batches, ["user_id"], DeleteFlag("removed", "1"), batch_columns=["event_id"])


@query("dq_two_references", """
SELECT o_orderkey, nullif(concat_ws('; ', CASE WHEN o_custkey % 3 = 0 THEN 'not in the first list' END, CASE WHEN o_custkey % 5 = 0 THEN 'not in the second list' END), '') AS reason
FROM orders
""")
def dq_two_references(t):
    """Two references on one column are two checks."""
    known = {"first": t.customer.filter("c_custkey % 3 <> 0"), "second": t.customer.filter("c_custkey % 5 <> 0")}
    steps = [
        {"Category": "validate_referential_integrity", "current_table_column_name": "o_custkey", "reference_table_name": name,
         "reference_table_column_name": "c_custkey", "if_not_compliant": "quarantine", "message": f"not in the {name} list"}
        for name in known
    ]
    out = run_quality(t.orders.select("o_orderkey", "o_custkey"), steps, lookup=known.__getitem__)
    clean = out.clean.select("o_orderkey", F.lit(None).cast("string").alias("reason"))
    return clean.unionByName(out.quarantined.select("o_orderkey", F.col(QUARANTINE_REASON).alias("reason")))


@query("hierarchy_unrooted", """
SELECT 's' || s_suppkey AS node, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'n' || s_nationkey END AS root, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 1 END AS depth FROM supplier
UNION ALL SELECT 'n' || n_nationkey, 'n' || n_nationkey, 0 FROM nation
""")
def hierarchy_unrooted(t):
    """Every fourth supplier hangs on a parent that does not exist, or, each eighth, on itself."""
    parent = F.when(F.col("s_suppkey") % 8 == 0, F.concat(F.lit("s"), "s_suppkey")).when(F.col("s_suppkey") % 4 == 0, F.lit("nobody"))
    nodes = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.lit(None).cast("string").alias("parent")).union(
        t.supplier.select(F.concat(F.lit("s"), "s_suppkey"), parent.otherwise(F.concat(F.lit("n"), "s_nationkey")))
    )
    return graph.flatten_hierarchy(nodes, "id", "parent", keep_unrooted=True).select("node", "root", "depth")


def _decimal_window(t, hot: int):
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    made = windows.add_window(rows, "sum", "total", ["o_custkey"], ["o_orderkey"], "asc", "price", hot_rows=hot)
    made = windows.add_window(made, "avg", "mean", ["o_custkey"], ["o_orderkey"], "asc", "price", hot_rows=hot)
    kinds = dict(made.dtypes)
    return made.select(
        "o_orderkey", F.col("total").cast("double").alias("total"), F.col("mean").cast("double").alias("mean"),
        F.lit(kinds["total"]).alias("total_type"), F.lit(kinds["mean"]).alias("mean_type"),
    )


_DECIMALS = """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total,
  CAST((2 * CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w * 1000000 AS HUGEINT) + count(*) OVER w) // (2 * count(*) OVER w) AS DOUBLE) / 1000000 AS mean,
  'decimal(28,2)' AS total_type, 'decimal(22,6)' AS mean_type
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
"""


@query("window_decimals", _DECIMALS)
def window_decimals(t):
    return _decimal_window(t, 10_000_000)


@query("window_decimals_hot", _DECIMALS)
def window_decimals_hot(t):
    """The same types and values when every customer of more than five orders is split."""
    return _decimal_window(t, 5)


@query("scd2_deleted_without_flag", """
SELECT c_custkey, c_custkey % 3 <> 0 AS active FROM customer
""")
def scd2_deleted_without_flag(t):
    """A deletion closes a version though the target has no flag and no compared value differs; a moved mark opens none."""
    at = lambda s: F.lit(s).cast("timestamp")
    rows = t.customer.select("c_custkey", "c_name", F.lit(1).alias("mark"))
    target = scd2.add_history_columns(rows.withColumn("at", at("2024-01-01")), "at")
    batch = rows.withColumn("mark", F.lit(2)).withColumn("at", at("2024-02-01")).withColumn("gone", F.when(F.col("c_custkey") % 3 == 0, 1))
    out = scd2.merge_history(target, batch, ["c_custkey"], "at", DeleteFlag("gone", "1"), mark_columns=["mark"])
    return out.select("c_custkey", (F.col(scd2.ACTIVE) == 1).alias("active"))
