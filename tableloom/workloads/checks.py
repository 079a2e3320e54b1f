"""Queries of the quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions.patterns import PATTERNS, pattern
from tableloom.operators import quality
from tableloom.operators.quality import run_quality
from tableloom.spec import CORRUPT, DQ_DETAILS, QUARANTINE_REASON
from tableloom.workloads.registry import query

def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def check(category: str, message: str, action: str = "warn", **attributes: str) -> dict:
    return {"Category": category, "message": message, "if_not_compliant": action, **attributes}


def event_checks() -> list[dict]:
    return [
        check("validate_condition", "errors must be cheap", "quarantine", condition="event_type <> 'error' OR value < 60"),
        check("validate_not_null", "value missing", "mark", column_name="value"),
        check("validate_unique", "same user and value", "mark", column_name="user_id, value"),
        check("validate_range", "value out of range", "mark", column_name="value", min_value="1", max_value="150"),
        check("validate_pattern", "type must be letters", "fail", column_name="event_type", pattern_type="alpha_only"),
        check("validate_batch_size", "too few rows", min_rows="100000000"),
        check("validate_referential_integrity", "unknown user", "quarantine", current_table_column_name="user_id",
              reference_table_name="customer", reference_table_column_name="c_custkey"),
        check("validate_freshness", "stale", column_name="ts", max_age="10", unit_of_measure="day"),
        check("validate_completeness", "value mostly present", column_name="value, event_type", min_completeness_percent="90"),
    ]


def sparse(t):
    return t.events.drop("props").withColumn("value", F.expr("CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END"))


def outcome(t):
    known = t.customer.filter("c_custkey % 10 <> 3")
    return run_quality(sparse(t), event_checks(), ["event_id"], "fail", {"customer": known}.__getitem__, now=now())


_FLAGS = """
WITH e AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END AS value FROM events),
f AS (SELECT *, coalesce(NOT (event_type <> 'error' OR value < 60), false) AS f_cond, value IS NULL AS f_null,
  count(*) OVER (PARTITION BY user_id, value) > 1 AS f_uniq, coalesce(value < 1 OR value > 150, false) AS f_range,
  user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3) AS f_ref FROM e)
"""


@query("dq_report", _FLAGS + """
, n AS (SELECT count(*) FILTER (f_cond) AS cond, count(*) FILTER (f_null) AS nul, count(*) FILTER (f_uniq) AS uniq,
  count(*) FILTER (f_range) AS rng, 100000000 - count(*) AS size,
  (SELECT count(*) FROM (SELECT DISTINCT user_id FROM f WHERE f_ref)) AS ref,
  CASE WHEN epoch(TIMESTAMP '2024-03-01') - epoch(max(ts)) > 864000 THEN 1 ELSE 0 END AS stale,
  count(value) * 100.0 / count(*) AS share FROM f),
r AS (
  SELECT 1 AS step, 'Duplicate Primary Keys' AS category, 'Duplicate primary keys (event_id)' AS message, NULL AS column_name, 'fail' AS act, 0 AS k FROM n
  UNION ALL SELECT 2, 'Validate Condition', 'errors must be cheap', NULL, 'quarantine', cond FROM n
  UNION ALL SELECT 3, 'Not Null Validation', 'value missing', 'value', 'mark', nul FROM n
  UNION ALL SELECT 4, 'Uniqueness Validation', 'same user and value', NULL, 'mark', uniq FROM n
  UNION ALL SELECT 5, 'Range Validation', 'value out of range', 'value', 'mark', rng FROM n
  UNION ALL SELECT 6, 'Pattern Validation', 'type must be letters', 'event_type', 'fail', 0 FROM n
  UNION ALL SELECT 7, 'Batch Size Validation', 'too few rows', NULL, 'warn', size FROM n
  UNION ALL SELECT 8, 'Referential Integrity', 'unknown user', NULL, 'quarantine', ref FROM n
  UNION ALL SELECT 9, 'Freshness Validation', 'stale', NULL, 'warn', stale FROM n
  UNION ALL SELECT 10, 'Completeness Validation', CASE WHEN share < 90 THEN 'value mostly present (value) - completeness '
    || CAST(round(share) AS INTEGER) || '% below threshold 90%' ELSE 'value mostly present (value)' END, 'value', 'warn',
    CASE WHEN share < 90 THEN 1 ELSE 0 END FROM n
  UNION ALL SELECT 11, 'Completeness Validation', 'value mostly present (event_type)', 'event_type', 'warn', 0 FROM n)
SELECT step, CASE WHEN k = 0 THEN 'Pass' WHEN act = 'fail' THEN 'Failure' ELSE 'Warning' END AS outcome, category, message, column_name,
  CASE WHEN k > 0 AND act = 'quarantine' THEN 'Yes' WHEN k > 0 AND act <> 'fail' THEN 'No' END AS quarantined,
  CASE WHEN k > 0 AND act <> 'quarantine' THEN k END AS rows_impacted, CASE WHEN k > 0 AND act = 'quarantine' THEN k END AS rows_quarantined
FROM r
""")
def dq_report(t):
    return outcome(t).report


@query("dq_quarantine", _FLAGS + """
SELECT event_id, user_id, event_type, value, concat_ws('; ', CASE WHEN f_cond THEN 'errors must be cheap' END,
  CASE WHEN f_ref THEN 'unknown user' END) AS delta__quarantine_reason FROM f WHERE f_cond OR f_ref
""")
def dq_quarantine(t):
    return outcome(t).quarantined.select("event_id", "user_id", "event_type", "value", QUARANTINE_REASON)


@query("dq_marked", _FLAGS + """
SELECT event_id, value, nullif(concat_ws('; ', CASE WHEN f_uniq THEN 'same user and value' END,
  CASE WHEN f_null THEN 'value missing' END, CASE WHEN f_range THEN 'value out of range' END), '') AS delta__dq_failure_details
FROM f WHERE NOT f_cond AND NOT f_ref
""")
def dq_marked(t):
    return outcome(t).clean.select("event_id", "value", DQ_DETAILS)


@query("dq_duplicate_keys", """
WITH d AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 500 END AS k FROM customer)
SELECT c_custkey, c_name, k, 'Duplicate primary keys (k)' AS delta__quarantine_reason FROM d
WHERE k IS NOT NULL AND k IN (SELECT k FROM d WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1)
""")
def dq_duplicate_keys(t):
    keyed = t.customer.select("c_custkey", "c_name", F.expr("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 500 END").alias("k"))
    return run_quality(keyed, [], ["k"], "quarantine").quarantined


@query("dq_duplicate_keys_report", """
WITH d AS (SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 500 END AS k, c_acctbal FROM customer),
g AS (SELECT k, count(*) AS n FROM d GROUP BY k HAVING count(*) > 1)
SELECT 1 AS step, 'Warning' AS outcome, 'Duplicate Primary Keys' AS category, 'Duplicate primary keys (k)' AS message,
  CAST(NULL AS VARCHAR) AS column_name, 'Yes' AS quarantined, CAST(NULL AS BIGINT) AS rows_impacted, (SELECT count(*) FROM g) AS rows_quarantined
UNION ALL SELECT 2, 'Warning', 'Range Validation', 'in debt', 'c_acctbal', 'No',
  (SELECT count(*) FROM d WHERE c_acctbal < 0 AND (k IS NULL OR k NOT IN (SELECT k FROM g WHERE k IS NOT NULL))), NULL
""")
def dq_duplicate_keys_report(t):
    keyed = t.customer.select(F.expr("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 500 END").alias("k"), "c_acctbal")
    return run_quality(keyed, [check("validate_range", "in debt", column_name="c_acctbal", min_value="0")], ["k"], "quarantine").report


@query("dq_corrupt_records", """
SELECT event_id, user_id, CASE WHEN event_id % 100 = 7 THEN props END AS delta__corrupt_record,
  CASE WHEN event_id % 100 = 7 THEN 'File Corruption check failed: row data does not conform to input schema in metadata.'
  ELSE 'negative' END AS delta__quarantine_reason
FROM events WHERE event_id % 100 = 7 OR user_id < 3
""")
def dq_corrupt_records(t):
    df = t.events.select("event_id", "user_id", F.expr("CASE WHEN event_id % 100 = 7 THEN props END").alias(CORRUPT))
    return run_quality(df, [check("validate_condition", "negative", "quarantine", condition="user_id >= 3")]).quarantined


_BASE = "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')"
_BATCH = "(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"


def anomaly(t, **attributes):
    parts = t.lineitem.filter("l_shipdate >= TIMESTAMP '1998-01-01'"), t.lineitem.filter("l_shipdate < TIMESTAMP '1998-01-01'")
    step = check("validate_anomaly", "odd price", "quarantine", column_name="l_extendedprice", **attributes)
    bad = run_quality(parts[0], [step], baseline=parts[1]).quarantined
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("dq_anomaly_zscore", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM {_BATCH}, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM {_BASE})
WHERE abs(l_extendedprice - m) / s > 1.6
""")
def dq_anomaly_zscore(t):
    return anomaly(t, threshold="1.6")


@query("dq_anomaly_iqr", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM {_BATCH},
  (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM {_BASE})
WHERE l_extendedprice < a - 0.3 * (b - a) OR l_extendedprice > b + 0.3 * (b - a)
""")
def dq_anomaly_iqr(t):
    return anomaly(t, method="iqr", threshold="0.3", exact_quantiles="true")


@query("dq_anomaly_iqr_approximate")
def dq_anomaly_iqr_approximate(t):
    return anomaly(t, method="iqr", threshold="0.3")


@query("dq_row_score", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 5.0 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 1.5 ELSE 0 END
  + CASE WHEN c_nationkey > 20 THEN 2.0 ELSE 0 END AS dq_score FROM customer
""")
def dq_row_score(t):
    rules = {"c_acctbal >= 0": 5.0, "c_mktsegment <> 'BUILDING'": 1.5, "c_nationkey <= 20": 2.0}
    return quality.row_score(t.customer, rules).select("c_custkey", "dq_score")


@query("pattern_urls", r"""
SELECT page_id, url, coalesce(regexp_matches(url, '^https?:\/\/(www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b([-a-zA-Z0-9()@:%_\+.~#?&/=]*)$'), false) AS ok
FROM pages
""")
def pattern_urls(t):
    step = check("validate_pattern", "bad url", "mark", column_name="url", pattern_type="url")
    marked = run_quality(t.pages.select("page_id", "url"), [step]).clean
    return marked.select("page_id", "url", F.col(DQ_DETAILS).isNull().alias("ok"))


# Texts derived from customer rows, of which some fit a pattern and some do not.
_SHAPED = {
    "us_phone": "concat('(', lpad(cast(c_custkey % 1000 AS string), 3, '5'), ') 555-', lpad(cast(c_custkey AS string), 4, '0'))",
    "email": "concat(lower(c_mktsegment), c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '@example' ELSE '@example.com' END)",
    "us_zip": "concat(lpad(cast(c_custkey AS string), 5, '0'), CASE c_custkey % 3 WHEN 0 THEN '-1234' WHEN 1 THEN '' ELSE '-12' END)",
    "us_ssn": "concat('123-45-', c_custkey)",
    "date_mmddyyyy": "concat(lpad(cast(c_custkey % 15 AS string), 2, '0'), '/', lpad(cast(c_nationkey AS string), 2, '0'), '/2024')",
    "date_yyyymmdd": "concat('2024-', lpad(cast(c_custkey % 15 AS string), 2, '0'), '-', lpad(cast(c_nationkey AS string), 2, '0'))",
    "url": "concat(CASE WHEN c_custkey % 2 = 0 THEN 'https://' ELSE 'ftp://' END, lower(c_mktsegment), '.example.com/', c_custkey)",
    "credit_card": "concat('4111 1111-1111', lpad(cast(c_custkey AS string), CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 5 END, '0'))",
    "ip_address": "CASE WHEN c_custkey % 2 = 0 THEN concat('10.', c_custkey % 300, '.0.1') ELSE concat('2001:db8::', c_custkey % 20000) END",
    "ipv4_address": "concat('10.', c_custkey % 300, '.', c_nationkey, '.1')",
    "ipv6_address": "concat('2001:db8::', CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END, c_custkey % 20000)",
    "alpha_only": "substring(c_name, 1, cast(c_custkey % 12 + 1 AS int))",
    "alphanumeric_only": "substring(c_mktsegment, 1, cast(c_custkey % 12 + 1 AS int))",
    "numeric_only": "cast(c_custkey - 40 AS string)",
    "guid": "concat('12345678-1234-1234-1234-', lpad(cast(c_custkey AS string), CASE WHEN c_custkey % 2 = 0 THEN 12 ELSE 11 END, '0'))",
    "uk_phone": "concat(CASE WHEN c_custkey % 2 = 0 THEN '+44 ' ELSE '0' END, lpad(cast(c_custkey AS string), 10, '7'))",
    "uk_postcode": "concat('m', c_custkey % 30, ' ', c_custkey % 10, 'hs')",
}


def _pattern_sql() -> str:
    def duck(expression: str) -> str:
        return expression.replace("AS string", "AS VARCHAR")
    parts = [
        f"SELECT '{k}' AS pattern, count(*) FILTER (NOT regexp_matches({duck(e)}, '{pattern(k)}')) AS misses FROM customer"
        for k, e in _SHAPED.items()
    ]
    return " UNION ALL ".join(parts)


@query("pattern_all_kinds", _pattern_sql())
def pattern_all_kinds(t):
    """Every pattern over text shaped for it, in one pass."""
    shaped = t.customer.selectExpr(*[f"{e} AS {k}" for k, e in _SHAPED.items()])
    steps = [check("validate_pattern", k, column_name=k, pattern_type=k) for k in PATTERNS]
    report = run_quality(shaped, steps).report
    return report.select(F.col("column_name").alias("pattern"), F.coalesce("rows_impacted", F.lit(0)).alias("misses"))
