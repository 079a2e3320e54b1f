"""Entity resolution whose rules need more than one block: every pair that a rule names is found."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.operators import resolve
from tableloom.workloads.recipes import people
from tableloom.workloads.registry import query

_PEOPLE = r"""people AS (SELECT c_custkey AS id, c_mktsegment AS segment, 'm' || CAST(c_custkey // 40 AS VARCHAR) AS mail,
  CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END || ' ' || substring(md5(CAST(c_custkey // 4 AS VARCHAR)), 1, 12)
    || CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '' END AS name FROM customer)"""
_SCORE = "1 - levenshtein(lower(trim(a.name)), lower(trim(b.name))) * 1.0 / greatest(length(a.name), length(b.name))"
_GROUPS = """u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(id, c) AS (SELECT a, a FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.id)"""


def mailed(t):
    """Customers under two spellings with mailboxes that forty neighbouring numbers share."""
    return people(t).withColumn("mail", F.concat(F.lit("m"), F.floor(F.col("id") / 40).cast("string")))


@query("er_exact_and_soundex", """
SELECT c_custkey AS id, CASE WHEN count(*) OVER w > 1 THEN 'Auto_Match' ELSE 'No_Match' END AS match_outcome,
  CASE WHEN count(*) OVER w > 1 THEN min(c_custkey) OVER w END AS match_group_id
FROM customer WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment)
""")
def er_exact_and_soundex(t):
    """Segments begin with different letters, so their soundex codes differ; no blocks are given."""
    spec = resolve.MatchSpec(
        [resolve.Comparison("c_nationkey", "c_nationkey", "exact"), resolve.Comparison("c_mktsegment", "c_mktsegment", "soundex")],
        "a_c_nationkey_b_c_nationkey_exact = 1.0 AND a_c_mktsegment_b_c_mktsegment_soundex = 1.0", None, "c_custkey",
    )
    return resolve.resolve(t.customer, spec).records.select("id", "match_outcome", "match_group_id")


def _either(secondary: str | None = None) -> resolve.MatchSpec:
    return resolve.MatchSpec(
        [resolve.Comparison("mail", "mail", "exact"), resolve.Comparison("name", "name", "fuzzy")],
        "a_mail_b_mail_exact = 1.0 OR a_name_b_name_fuzzy > 0.9", None, "id", secondary, fuzzy_floor=0.9, fuzzy_needs_exact=False,
    )


@query("er_mail_or_name", f"""
WITH RECURSIVE {_PEOPLE}, e AS (SELECT a.id AS a, b.id AS b FROM people a JOIN people b ON a.id < b.id WHERE a.mail = b.mail OR {_SCORE} > 0.9), {_GROUPS}
SELECT p.id, min(r.c) AS match_group_id FROM people p LEFT JOIN r ON r.id = p.id GROUP BY p.id
""")
def er_mail_or_name(t):
    """Records with one mailbox match whatever their names are, and so do records of one name."""
    return resolve.resolve(mailed(t), _either()).records.select("id", "match_group_id")


@query("er_mail_or_name_two_tables", f"""
WITH RECURSIVE {_PEOPLE}, ours AS (SELECT * FROM people WHERE id % 2 = 0), theirs AS (SELECT * FROM people WHERE id % 2 = 1),
e AS (SELECT a.id AS a, b.id AS b FROM ours a JOIN theirs b ON a.mail = b.mail OR {_SCORE} > 0.9), {_GROUPS}
SELECT p.id, count(r.c) > 0 AS matched FROM people p LEFT JOIN r ON r.id = p.id GROUP BY p.id
""")
def er_mail_or_name_two_tables(t):
    rows = mailed(t)
    found = resolve.resolve(rows.filter("id % 2 = 0"), _either("id"), rows.filter("id % 2 = 1")).records
    return found.select("id", (F.col("match_outcome") != resolve.NONE).alias("matched"))


@query("er_step_rows", """
WITH k AS (SELECT c_custkey, c_name, min(c_custkey) OVER w AS first, count(*) OVER w AS n FROM customer
  WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 500) AS BIGINT)))
SELECT first AS a_match_id, c_custkey AS b_match_id, 'Auto_Match' AS match_outcome, c_name AS b_c_name FROM k WHERE n > 1 AND c_custkey <> first
UNION ALL SELECT c_custkey, NULL, 'No_Match', NULL FROM k WHERE n = 1
""")
def er_step_rows(t):
    """The step's own table: matched pairs beside their columns, then the records without a match."""
    spec = resolve.MatchSpec.parse({
        "primary_dataset_comparison_fields": "c_nationkey, c_mktsegment, band", "comparison_types": "exact, exact, exact",
        "auto_match_logic": "a_c_nationkey_b_c_nationkey_exact = 1.0 AND a_c_mktsegment_b_c_mktsegment_exact = 1.0 AND a_band_b_band_exact = 1.0",
        "id_column": "c_custkey",
    })
    rows = t.customer.withColumn("band", F.expr("cast(floor(c_acctbal / 500) AS bigint)"))
    return resolve.resolve_step(rows, spec).select("a_match_id", "b_match_id", "match_outcome", "b_c_name")
