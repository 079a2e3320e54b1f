"""Secret scans with multipart credential linking, in DataFrame operations only.

The base finds three kinds of secrets by pattern. Linking looks for credentials
in parts: access identifiers, secrets and endpoints. A part that is too weak to be
reported by itself (a short secret, a user or client id, an address) is reported
only when complementary parts begin within ``SCOPE`` code points of it:
a weak secret beside an identifier or endpoint, an identifier beside a secret,
an endpoint beside both. It is an interval join over buckets of the scope's width:
for each role a bucket keeps its first and last start, and a candidate is compared with the
three buckets around it, so the work is linear in the parts.

Positions come from the lengths of what a pattern splits off and what it finds,
added up by a window inside a document. The text itself is read once and never shuffled.

Defined cases: a null text is an empty one and has no spans; repeated rows each
get their own, equal result; ties in position are ordered by kind; an empty table gives
an empty result; columns other than those named stay out of the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.session import settle

SCOPE = 200


def _any_case(words: str) -> str:
    """A pattern for ASCII letters in either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
#: Kinds in order: pattern, group whose length counts, least length, role in a credential.
KINDS = {
    "assign": ("(" + _any_case("password|passwd|secret|token|api_?key") + ")" + _GIVEN + "([A-Za-z0-9+/_.=-]+)", 2, 12, "secret"),
    "access": ("AKIA[A-Z0-9]+", 0, 18, "id"),
    "hex": ("[0-9a-f]{16,}", 0, 16, "secret"),
}
#: Weak parts, reported as these kinds only when linked.
WEAK = {
    "weak_secret": ("(" + _any_case("password|passwd|passphrase|pwd|secret|token|api_?key") + ")" + _GIVEN + "([A-Za-z0-9+/_.=-]+)", 2, 6, "secret"),
    "weak_id": ("(" + _any_case("access_?key_?id|client_?id|user_?name|user_?id|login|account") + ")" + _GIVEN + "([A-Za-z0-9_.@-]+)", 2, 4, "id"),
    "weak_endpoint": (_any_case("https?://") + "[A-Za-z0-9.:-]+|(" + _any_case("endpoint|hostname|host|server") + ")" + _GIVEN + "[A-Za-z0-9.:/-]+", 0, 10, "endpoint"),
}
#: What each weak kind needs in its scope.
NEEDS = {"weak_secret": (("id", "endpoint"),), "weak_id": (("secret",),), "weak_endpoint": (("id",), ("secret",))}
ORDER = [*KINDS, *WEAK]


def _found(text: Column, pattern: str, group: int) -> Column:
    """Of each match in order: the length of the gap before it, its own length, and that of the group that counts."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else whole
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("len"), counted.alias("counted"))
    return F.when(text.rlike(pattern), zipped)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One narrow row per document with a row number, the kept columns as one struct, and what each pattern finds; written to the shared folder."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("_kept")
    found = [_found(body, pattern, group).alias(f"_{kind}") for kind, (pattern, group, *_) in {**KINDS, **WEAK}.items()]
    return settle(docs.select(F.monotonically_increasing_id().alias("_row"), kept, *found), "secrets")


def spans(scanned: DataFrame) -> DataFrame:
    """``_row, kind, ord, start, end`` of all base spans and of the weak ones that are linked."""
    parts = None
    for i, (kind, (_, _, least, role)) in enumerate({**KINDS, **WEAK}.items()):
        rows = scanned.filter(F.col(f"_{kind}").isNotNull()).select("_row", F.posexplode(f"_{kind}").alias("at", "m"))
        rows = rows.select("_row", F.lit(kind).alias("kind"), F.lit(i).alias("ord"), F.lit(role).alias("role"), F.lit(least).alias("least"), "at", "m.*")
        parts = rows if parts is None else parts.unionByName(rows)
    upto = Window.partitionBy("_row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = parts.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).filter("counted >= least")
    placed = settle(ends.select("_row", "kind", "ord", "role", (F.col("end") - F.col("len")).alias("start"), "end"), "parts")
    base = placed.filter(F.col("kind").isin(*KINDS))
    weak = placed.filter(F.col("kind").isin(*WEAK))
    # a weak secret that the base has already is none
    weak = weak.join(base.select("_row", "start").distinct(), ["_row", "start"], "left_anti")
    columns = ["_row", "kind", "ord", "start", "end"]
    return base.select(*columns).unionByName(_linked(weak, placed).select(*columns))


def _linked(weak: DataFrame, parts: DataFrame) -> DataFrame:
    """The weak parts whose needs begin within the scope."""
    bucket = F.floor(F.col("start") / SCOPE)
    near = parts.groupBy("_row", bucket.alias("_bucket"), "role").agg(F.min("start").alias("_first"), F.max("start").alias("_last"))
    near = near.withColumnRenamed("role", "_role")
    around = weak.withColumn("_bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    touch = (F.col("_last") >= F.col("start") - SCOPE) & (F.col("_first") <= F.col("start") + SCOPE)
    met = around.join(near, ["_row", "_bucket"]).filter(touch)
    roles = met.groupBy(*weak.columns).agg(F.collect_set("_role").alias("_roles"))
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        all_met = F.lit(True)
        for any_of in needs:
            all_met = all_met & F.arrays_overlap("_roles", F.array(*map(F.lit, any_of)))
        enough = enough | ((F.col("kind") == kind) & all_met)
    return roles.filter(enough)


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with ``spans``: ``array<struct<start, ord, end, kind>>`` in order; null where a document has none."""
    scanned = scan(docs, text, keep)
    one = F.struct("start", "ord", "end", "kind")
    listed = spans(scanned).groupBy("_row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    kept = [F.col(f"_kept.`{c}`") for c in (docs.columns if keep is None else keep) if c.lower() != "spans"]
    return scanned.select("_row", "_kept").join(listed, "_row", "left").select(*kept, "spans")


def secret_digest(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_assign, n_access, n_hex, base_sha256, spans`` of each document."""
    found = find_secrets(docs, text, [key])
    every = F.coalesce("spans", F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>"))
    base = F.filter(every, lambda s: s["ord"] < len(KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter(every, lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mask``; overlapping spans share one."""
    # the caller's columns are one struct meanwhile, whatever they are called
    found = find_secrets(docs.select(F.struct("*").alias("all"), F.col(f"`{text}`").alias("text")), "text")
    body = F.coalesce(F.col("text"), F.lit(""))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    cut = F.aggregate(
        "spans", start,
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
            F.concat(
                a["done"], F.when(s["start"] < a["at"], F.lit("")).otherwise(
                    F.concat(F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask))),
            ).alias("done"),
            s["end"].alias("at"),
        )),
        lambda a: F.concat(a["done"], F.substring(body, (a["at"] + 1).cast("int"), F.length(body))),
    )
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut)
    return found.select(*[clean.alias(c) if c == text else F.col(f"all.`{c}`") for c in docs.columns])
