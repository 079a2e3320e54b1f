"""The registered queries of this subpackage over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableloom.llm import cover_tree, curriculum, divergence, fragment_join, hash_tree, media, secret_links, sentencepiece_table, skip_chain, suffix_dedup, token_counts, topk, toxicity
from tableloom.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = lambda spark, folder: fn(apply_settings(spark), folder.rstrip("/"))
        if sql:
            SQL[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """The place of a public vocabulary file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_table.digest(table(spark, folder, "documents"), tokenizer())


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM d GROUP BY source
), w AS (
  SELECT *, CASE turn WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS most FROM s
), p AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS part
  FROM w
), t AS (
  SELECT source, source_size, turn, least(most, max(part) OVER () * weight) AS target FROM p
), o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.turn, floor(t.target + 0.5)::BIGINT AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, goal // greatest(source_size, 1) AS full_copies, start / greatest(target, 1.0::DOUBLE) AS u FROM o
), r AS (
  SELECT *, (full_copies * size + least(greatest(goal - full_copies * source_size - start, 0), size))::BIGINT AS taken FROM k
)
SELECT doc_id, size, source_size, target, taken,
  round(CASE WHEN taken > 0 THEN CASE
    WHEN turn = 0 THEN u * 2.0::DOUBLE / (sqrt(2.25::DOUBLE + u * -2.0::DOUBLE) + 1.5::DOUBLE)
    WHEN turn = 1 THEN u * 2.0::DOUBLE / (sqrt(0.25::DOUBLE + u * 2.0::DOUBLE) + 0.5::DOUBLE)
    WHEN u < 0.5 THEN u * 2.0::DOUBLE / (sqrt(0.25::DOUBLE + u * 4.0::DOUBLE) + 0.5::DOUBLE)
    ELSE 0.5::DOUBLE + (u - 0.5::DOUBLE) * 2.0::DOUBLE / (sqrt(2.25::DOUBLE + (u - 0.5::DOUBLE) * -4.0::DOUBLE) + 1.5::DOUBLE)
  END END, 6) AS position
FROM r
"""


@query("op2_curriculum_mix", MIX_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = curriculum.in_training_order(curriculum.mix(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = table(spark, folder, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_counts.token_counts(docs, tokenizer(), keep=["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def _secrets_sql() -> str:
    """The same question in SQL: positions from lengths, windows and neighbouring buckets."""
    quoted = lambda p: p.replace("'", "''")
    kinds = {**secret_links.KINDS, **secret_links.WEAK}
    found = "\n  UNION ALL ".join(
        f"SELECT rid, '{kind}' AS kind, {i} AS ord, '{role}' AS role, {least} AS least, "
        f"unnest(range(len(m))) AS nth, unnest(list_transform(string_split_regex(body, '{quoted(p)}')[1:len(m)], lambda x: length(x))) AS gap, "
        f"unnest(list_transform(m, lambda x: length(x))) AS len, unnest(list_transform(v, lambda x: length(x))) AS counted FROM "
        f"(SELECT rid, body, regexp_extract_all(body, '{quoted(p)}') AS m, regexp_extract_all(body, '{quoted(p)}', {group}) AS v FROM d)"
        for i, (kind, (p, group, least, role)) in enumerate(kinds.items())
    )
    listed = ", ".join(f"'{k}'" for k in secret_links.KINDS)
    met = " OR ".join(
        f"(w.kind = '{kind}'" + "".join(
            f" AND EXISTS (SELECT 1 FROM parts p WHERE p.rid = w.rid AND p.role IN ({', '.join(map(repr, roles))}) AND abs(p.start - w.start) <= {secret_links.SCOPE})"
            for roles in needs
        ) + ")" for kind, needs in secret_links.NEEDS.items()
    )
    text = "kind || ':' || start || ':' || stop"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
m AS ({found}),
e AS (SELECT *, sum(gap + len) OVER (PARTITION BY rid, kind ORDER BY nth)::BIGINT AS stop FROM m),
parts AS (SELECT rid, kind, ord, role, stop - len AS start, stop FROM e WHERE counted >= least),
base AS (SELECT * FROM parts WHERE kind IN ({listed})),
weak AS (SELECT * FROM parts w WHERE kind NOT IN ({listed}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.start = w.start) AND ({met})),
every AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
g AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg({text}, ',' ORDER BY start, ord) FILTER (kind IN ({listed})) AS b, string_agg({text}, ',' ORDER BY start, ord) AS a
  FROM every GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


@query("op8_secret_links", _secrets_sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return secret_links.secret_digest(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op9_top_k", TOPK_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    return topk.top_k(table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)


LINKS_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM d
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND a.n * 10 >= b.n * 9 AND b.n * 10 >= a.n * 9 GROUP BY 1, 2
), l AS (SELECT a, b FROM o WHERE 100 * k >= 90 * (na + nb - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, m.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = s.doc_id
"""


@query("op4_fragment_join", LINKS_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return fragment_join.components(table(spark, folder, "documents"))


@query("op7_progressive_jpeg")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return media.media_digest(table(spark, folder, "documents"))


@query("op3_skip_chain")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return skip_chain.private_digest(table(spark, folder, "documents"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, folder, "documents"))


def _tree_sql() -> str:
    """The same descent in SQL: one row for each child of a level, the earliest clock kept; sums of bytes by a table of remainders."""
    tree, new = hash_tree.FORTY, hash_tree.NEXT
    regions = [(r, sum(map(sum, racks))) for r, racks in enumerate(tree.base)]
    racks = [(r, k, sum(rack)) for r, region in enumerate(tree.base) for k, rack in enumerate(region)]
    leaves = [(r, k, s, w) for r, region in enumerate(tree.base) for k, rack in enumerate(region) for s, w in enumerate(rack)]
    leaves = [(*leaf, n) for n, leaf in enumerate(leaves)]
    rows = lambda values: ", ".join("(" + ", ".join(map(repr, v)) + ")" for v in values)
    draw = lambda name: f"('0x' || substr(md5(k || '|' || {name}), 1, {hash_tree.DIGITS}))::BIGINT::DOUBLE"
    clock = lambda name, weight: f"-ln(({draw(name)} + 1) / {hash_tree.SPAN!r}::DOUBLE) / ({weight})::DOUBLE"
    return f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS turn FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, turn + 1 FROM bits WHERE turn < 8
), remainders AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE turn = 8),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(strlen(text), 0)::BIGINT + {hash_tree.ROW_BYTES} AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)::BIGINT AS text_crc32
  FROM documents, remainders
),
regions(region, w) AS (VALUES {rows(regions)}), racks(region, rack, w) AS (VALUES {rows(racks)}),
leaves(region, rack, leaf, w, shard) AS (VALUES {rows(leaves)}),
a AS (SELECT rid, arg_min(region, c) AS region, min(c) AS clock FROM (SELECT rid, region, {clock("'region ' || region", "w")} AS c FROM d, regions) GROUP BY rid),
b AS (
  SELECT rid, any_value(region) AS region, arg_min(rack, c) AS rack
  FROM (SELECT rid, region, rack, {clock("'rack ' || region || '.' || rack", "w")} AS c FROM d JOIN a USING (rid) JOIN racks USING (region)) GROUP BY rid
), e AS (
  SELECT rid, arg_min(shard, c) AS shard
  FROM (SELECT rid, shard, {clock("'shard ' || region || '.' || rack || '.' || leaf", "w")} AS c FROM d JOIN b USING (rid) JOIN leaves USING (region, rack)) GROUP BY rid
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY {draw("'slot'")}, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  (CASE WHEN {clock(f"'added {tree.built} in region {new.region}, rack {new.rack}'", new.weight)} < clock THEN {tree.built} ELSE shard END)::INT AS grown_shard
FROM d JOIN a USING (rid) JOIN e USING (rid)
"""


@query("op12_hash_tree", _tree_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return hash_tree.assign(table(spark, folder, "documents").select("doc_id", "text"))


DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), e AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM e GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total) AS words FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM e SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(v, 0)::HUGEINT AS v, coalesce(langs.words, 0)::HUGEINT AS lang_words, coalesce(s.words, 0)::HUGEINT AS words
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS words FROM n GROUP BY ALL) s USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(n.n, 0) AS n, 1 + 1000000000 * (coalesce(n.n, 0) + 1) // (g.words + g.v) AS p,
    1 + 1000000000 * (k.total + 1) // (g.lang_words + g.v) AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q
), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""


@query("op11_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("lang", "source", "text"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS alike, list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op13_cover_tree", NEGATIVES_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.mine(table(spark, folder, "embeddings"), "vec_id", "embedding", label, F.col("id") % 50 == 0)
