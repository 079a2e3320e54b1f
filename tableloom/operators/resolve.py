"""Entity resolution: which records denote the same thing.

Records with equal compared values are one *profile*, so a group of copies of
any size is compared once and linked to its representative. Which profiles meet
follows from the rules: each smallest set of agreeing comparisons that makes a rule
true (``ways``) is a way to match, and profiles meet

* as a star around the smallest profile, where agreeing on exact or soundex
  comparisons alone makes the rule true;
* through pieces of texts that edits leave alone, shared rare words, or numbers in neighbouring bands
  (``candidates``), within the exact and soundex agreements of that way, where it
  needs fuzzy scores or percent differences.

Rules label the scored pairs; groups are the connected components.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tableloom.functions.text import normalized, similarity
from tableloom.operators.candidates import LOWEST_FUZZY_FLOOR, near_values, similar_texts, similar_word_sets
from tableloom.operators.graph import connected_components
from tableloom.operators.keys import mark_by_keys
from tableloom.session import settle
from tableloom.spec import SpecError, check_columns, choice, flag, names, text

KINDS = ("exact", "soundex", "fuzzy", "percent_difference")
AUTO, REVIEW, NONE = "Auto_Match", "Match_For_Manual_Review", "No_Match"
MOST_COMPARISONS = 12


@dataclass(frozen=True)
class Comparison:
    left: str
    right: str
    kind: str


@dataclass(frozen=True)
class MatchSpec:
    """What to compare and how to decide.

    Exact and soundex scores are 1.0 or 0.0. ``blocks`` lists sets of exact/soundex
    comparisons (by position) on one of which candidates must agree besides what a rule asks for.
    ``fuzzy_floor`` is the fuzzy score below which no rule counts it as agreement; it is needed to find
    fuzzy candidates, and with ``word_filter`` so is ``word_floor``, the least share of common words.
    ``percent_ceiling`` likewise is the percent difference above which no rule
    can hold; it is needed where numbers are compared and no text is.
    """

    comparisons: list[Comparison]
    auto_rule: str
    review_rule: str | None
    id_column: str
    secondary_id_column: str | None = None
    primary_alias: str = "a"
    secondary_alias: str = "b"
    blocks: list[list[int]] = field(default_factory=list)
    fuzzy_floor: float | None = None
    percent_ceiling: float | None = None
    fuzzy_needs_exact: bool = True
    word_filter: bool = False
    word_floor: float | None = None

    @staticmethod
    def parse(step: dict) -> MatchSpec:
        left = names(text(step, "primary_dataset_comparison_fields"))
        right = names(step.get("secondary_dataset_comparison_fields")) or left
        kinds = [choice(k, KINDS, "comparison type") for k in names(text(step, "comparison_types"))]
        if not len(left) == len(right) == len(kinds):
            raise SpecError("entity_resolution: comparison fields and types differ in length")
        floor = step.get("fuzzy_floor")
        return MatchSpec(
            [Comparison(*c) for c in zip(left, right, kinds)],
            text(step, "auto_match_logic"),
            step.get("match_with_manual_review_logic") or None,
            text(step, "id_column"),
            step.get("secondary_id_column"),
            text(step, "primary_dataset_alias", "a").strip(),
            text(step, "secondary_dataset_alias", "b").strip(),
            [[int(i) for i in names(b, "+")] for b in names(step.get("blocks"))],
            float(floor) if floor else None,
            float(step["percent_ceiling"]) if step.get("percent_ceiling") else None,
            flag(step.get("only_fuzzy_match_if_one_exact_match"), True),
            flag(step.get("use_ngram_filtering_for_fuzzy_comparisons")),
            float(step["word_floor"]) if step.get("word_floor") else None,
        )

    def score_name(self, c: Comparison) -> str:
        return f"{self.primary_alias}_{c.left}_{self.secondary_alias}_{c.right}_{c.kind}"


@dataclass
class Resolution:
    """``pairs``: scored and labelled links between representatives and from
    representatives to their copies. ``records``: every record once, with its
    best outcome and the smallest member of its group. ``links``: those of ``pairs`` between
    representatives, of different compared values where one table is matched with itself.

    Each is worked out when it is asked for: links alone need no groups. ``own`` has the scores of representatives beside their copies;
    ``streamed`` links come straight out of a join and are written only where they are read again."""

    spec: MatchSpec
    links: DataFrame
    own: DataFrame | None
    lrecords: DataFrame
    rrecords: DataFrame | None
    streamed: bool

    @cached_property
    def _kept(self) -> DataFrame:
        return settle(self.links, "links") if self.streamed else self.links

    @cached_property
    def pairs(self) -> DataFrame:
        if self.own is None:
            return _with_copies(self._kept, self.lrecords, self.rrecords)
        copies = self.lrecords.filter("id <> rep").select(F.col("rep").alias("id_a"), F.col("id").alias("id_b"))
        return self.links.unionByName(self.own.drop("id_b").join(copies, "id_a").select(*self.links.columns))

    @cached_property
    def records(self) -> DataFrame:
        spec, one_table = self.spec, self.own is not None
        node = lambda tag, c: F.struct(F.lit("a" if one_table else tag).alias("side"), F.col(c).alias("id"))
        groups = connected_components(self._kept.select(node("a", "id_a").alias("a"), node("b", "id_b").alias("b")))
        links = self._kept.unionByName(self.own) if one_table else self._kept
        rank = lambda o: F.when(o == AUTO, 2).when(o == REVIEW, 1).otherwise(0)
        ends = links.select(node("a", "id_a").alias("n"), rank(F.col("match_outcome")).alias("r")).union(
            links.select(node("b", "id_b"), rank(F.col("match_outcome")))
        )
        best = ends.groupBy("n").agg(F.max("r").alias("r"))

        def described(records: DataFrame, tag: str) -> DataFrame:
            rows = records.withColumn("n", node(tag, "rep")).join(best, "n", "left").join(
                groups.withColumnRenamed("id", "n"), "n", "left"
            )
            home = F.when(F.col("r").isNotNull(), F.coalesce(F.col("component.id"), F.col("rep")))
            outcome = F.when(F.col("r") == 2, F.lit(AUTO)).when(F.col("r") == 1, F.lit(REVIEW)).otherwise(F.lit(NONE))
            return rows.select(
                F.lit(spec.primary_alias if tag == "a" else spec.secondary_alias).alias("side"),
                "id", outcome.alias("match_outcome"), home.alias("match_group_id"),
            )

        records = described(self.lrecords, "a")
        return records if one_table else records.unionByName(described(self.rrecords, "b"))


def cleaned(value: Column) -> Column:
    """Text as fuzzy comparisons see it."""
    spaced = F.regexp_replace(normalized(value, ["lowercase", "trim"]), r"[^\w\s]", " ")
    return F.regexp_replace(spaced, r"\s+", " ")


def _profiles(df: DataFrame, id_column: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row per distinct combination of compared values, and each record's representative."""
    values = [F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]
    base = df.select(F.col(f"`{id_column}`").alias("id"), *values)
    keys = [f"v{i}" for i in range(len(columns))]
    profiles = settle(base.groupBy(*keys).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "profiles")
    return profiles, mark_by_keys(base, keys, profiles.select(*keys, "rep", "copies")).select("id", "rep", "copies")


def _block_value(spec: MatchSpec, block: list[int]) -> Column:
    """The agreed values of a block; null where one of them is missing."""
    parts = []
    for i in block:
        c = spec.comparisons[i]
        if c.kind not in ("exact", "soundex"):
            raise SpecError("blocks may only name exact or soundex comparisons")
        value = F.col(f"v{i}").cast("string")
        parts.append(F.soundex(value) if c.kind == "soundex" else value)
    missing = parts[0].isNull()
    for p in parts[1:]:
        missing = missing | p.isNull()
    return F.when(~missing, F.struct(*[p.alias(f"b{n}") for n, p in enumerate(parts)]))


def _star(left: DataFrame, right: DataFrame | None, block: Column) -> DataFrame:
    """Link the members of each block to its smallest member of the other side."""
    a = left.select(F.col("rep").alias("id"), block.alias("block")).filter("block IS NOT NULL")
    if right is None:
        low = a.groupBy("block").agg(F.min("id").alias("hub"))
        return a.join(low, "block").filter("id > hub").select(F.col("hub").alias("id_a"), F.col("id").alias("id_b"))
    b = right.select(F.col("rep").alias("id"), block.alias("block")).filter("block IS NOT NULL")
    low_a, low_b = (x.groupBy("block").agg(F.min("id").alias("hub")) for x in (a, b))
    from_a = a.join(low_b, "block").select(F.col("id").alias("id_a"), F.col("hub").alias("id_b"))
    from_b = b.join(low_a, "block").select(F.col("hub").alias("id_a"), F.col("id").alias("id_b"))
    return from_a.union(from_b).distinct()


def _fuzzy_items(df: DataFrame, i: int, block: Column) -> DataFrame:
    return df.select(F.col("rep").alias("id"), block.alias("block"), cleaned(F.col(f"v{i}").cast("string")).alias("t"))


def ways(spark: SparkSession, spec: MatchSpec) -> list[frozenset[int]]:
    """The smallest sets of agreeing comparisons that make one of the rules true.

    The rules are asked, not read: a table with one row for each set of agreements has the best score for
    what agrees and the worst for what does not, and Spark evaluates the rules over it.
    """
    n = len(spec.comparisons)
    if n > MOST_COMPARISONS:
        raise SpecError(f"entity_resolution: more than {MOST_COMPARISONS} comparisons")
    agree = lambda i: F.col("id").bitwiseAND(F.lit(1 << i)) != 0
    worst = {"percent_difference": 1e300}
    best = {"percent_difference": 0.0}
    scores = [
        F.when(agree(i), F.lit(best.get(c.kind, 1.0))).otherwise(F.lit(worst.get(c.kind, 0.0))).alias(spec.score_name(c))
        for i, c in enumerate(spec.comparisons)
    ]
    grid = spark.range(1 << n).select("id", *scores)
    found: set[frozenset[int]] = set()
    for rule in filter(None, (spec.auto_rule, spec.review_rule)):
        true = {r.id for r in grid.filter(F.expr(rule)).select("id").collect()}
        if any(m | 1 << i not in true for m in true for i in range(n)):
            raise SpecError(f"entity_resolution: in '{rule}' agreement speaks against a match")
        if 0 in true:
            raise SpecError(f"entity_resolution: '{rule}' holds for records that agree on nothing")
        found |= {frozenset(i for i in range(n) if m >> i & 1) for m in true if not any(m & ~(1 << i) in true for i in range(n) if m >> i & 1)}
    return sorted(found, key=sorted)


def _searches(spark: SparkSession, spec: MatchSpec) -> list[tuple[list[int], int | None, int | None]]:
    """What finds every pair that a rule names: comparisons that agree, and a fuzzy one or a percent difference."""
    kinds = [c.kind for c in spec.comparisons]
    equal = [i for i, k in enumerate(kinds) if k in ("exact", "soundex")]
    found = []
    for way in ways(spark, spec):
        agreed = [i for i in sorted(way) if i in equal]
        fuzzy = next((i for i in sorted(way) if kinds[i] == "fuzzy"), None)
        number = next((i for i in sorted(way) if kinds[i] == "percent_difference"), None) if fuzzy is None else None
        narrowed = [sorted({*agreed, *b}) for b in spec.blocks] or [agreed]
        if fuzzy is not None and spec.fuzzy_needs_exact and equal and not agreed and not spec.blocks:
            narrowed = [[i] for i in equal]
        for block in narrowed:
            if (block, fuzzy, number) not in found:
                found.append((block, fuzzy, number))
    if any(number is not None for _, _, number in found) and not 0 < (spec.percent_ceiling or 0) < 100:
        raise SpecError("percent_difference without a fuzzy comparison needs a percent_ceiling below 100")
    return found


def _block_of(spec: MatchSpec, block: list[int]) -> Column:
    return _block_value(spec, block) if block else F.struct(F.lit(0).alias("b0"))


def _near(spec: MatchSpec, left: DataFrame, right: DataFrame | None, block: list[int], number: int, *row: Column) -> DataFrame:
    """Profiles of one block with near numbers; ``row`` travels along."""
    side = lambda df: df.select(F.col("rep").alias("id"), _block_of(spec, block).alias("block"), F.col(f"v{number}").alias("v"), *row)
    return near_values(side(left), None if right is None else side(right), spec.percent_ceiling)


def _candidates(spec: MatchSpec, left: DataFrame, right: DataFrame | None, searches: list) -> DataFrame:
    found = []
    for block, fuzzy, number in searches:
        if fuzzy is not None:
            found.append(_fuzzy_candidates(spec, left, right, _block_of(spec, block), fuzzy, bool(block)))
        elif number is not None:
            found.append(_near(spec, left, right, block, number))
        else:
            found.append(_star(left, right, _block_of(spec, block)))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def _fuzzy_candidates(spec: MatchSpec, left: DataFrame, right: DataFrame | None, block: Column, i: int, narrowed: bool) -> DataFrame:
    """Profiles of one block whose texts may be similar enough; words stand for letters where asked for and nothing narrows."""
    if spec.word_filter and not narrowed:
        if spec.word_floor is None:
            raise SpecError("filtering fuzzy comparisons by words needs a word_floor")
        side = lambda df: df.select(F.col("rep").alias("id"), cleaned(F.col(f"v{i}").cast("string")).alias("t"))
        return similar_word_sets(side(left), None if right is None else side(right), "t", spec.word_floor).select("id_a", "id_b")
    if (spec.fuzzy_floor or 0) < LOWEST_FUZZY_FLOOR:
        raise SpecError(f"fuzzy comparisons need a fuzzy_floor of at least {LOWEST_FUZZY_FLOOR:.2f}")
    return similar_texts(_fuzzy_items(left, i, block), None if right is None else _fuzzy_items(right, i, block), spec.fuzzy_floor)


def _scores(spec: MatchSpec) -> dict[str, Column]:
    out = {}
    for i, c in enumerate(spec.comparisons):
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        if c.kind == "exact":
            value = F.coalesce(a == b, F.lit(False)).cast("double")
        elif c.kind == "soundex":
            value = F.coalesce(F.soundex(a) == F.soundex(b), F.lit(False)).cast("double")
        elif c.kind == "fuzzy":
            value = similarity(a, b)
        else:
            value = F.abs(F.try_divide(b.cast("double") - a.cast("double"), a.cast("double")) * 100)
        out[spec.score_name(c)] = value
    return out


def resolve(primary: DataFrame, spec: MatchSpec, secondary: DataFrame | None = None) -> Resolution:
    """Match a table with itself or with a second one."""
    lcols, rcols = [c.left for c in spec.comparisons], [c.right for c in spec.comparisons]
    check_columns(primary, [spec.id_column, *lcols], "entity_resolution")
    left, lrecords = _profiles(primary, spec.id_column, lcols)
    right = rrecords = None
    if secondary is not None:
        sid = spec.secondary_id_column or spec.id_column
        check_columns(secondary, [sid, *rcols], "entity_resolution")
        right, rrecords = _profiles(secondary, sid, rcols)
    # Fuzzy texts are cleaned once per profile, before pairs multiply them.
    compared = [
        cleaned(F.col(f"v{i}").cast("string")) if c.kind == "fuzzy" else F.col(f"v{i}") for i, c in enumerate(spec.comparisons)
    ]
    side = lambda df, tag: df.select(
        F.col("rep").alias(f"id_{tag}"), *[v.alias(f"{tag}{i}") for i, v in enumerate(compared)]
    )
    scores = lambda df: df.select("id_a", "id_b", *[v.alias(k) for k, v in _scores(spec).items()])
    other, searches = left if right is None else right, _searches(left.sparkSession, spec)
    block, _, number = searches[0]
    streamed = len(searches) == 1 and number is not None
    if streamed:  # near numbers make many pairs; with the values at hand these are neither written nor shuffled
        row = F.struct(*[v.alias(f"c{i}") for i, v in enumerate(compared)]).alias("row")
        met = _near(spec, left, right, block, number, row)
        met = met.select("id_a", "id_b", *[F.col(f"row_{t}.c{i}").alias(f"{t}{i}") for t in "ab" for i in range(len(compared))])
    else:
        met = _candidates(spec, left, right, searches).join(side(left, "a"), "id_a").join(side(other, "b"), "id_b")
    scored = scores(met)
    own = None
    if right is None:  # a profile with copies is compared with itself
        alone = left.filter("copies > 1")
        own = scores(alone.select(F.col("rep").alias("id_a"), F.col("rep").alias("id_b"), *[v.alias(f"{t}{i}") for t in "ab" for i, v in enumerate(compared)]))
    if not streamed:  # written before the rules look at them: a filter on computed scores would compute them again
        scored = settle(scored, "scores")
    label = F.when(F.expr(spec.auto_rule), F.lit(AUTO))
    if spec.review_rule:
        label = label.when(F.expr(spec.review_rule), F.lit(REVIEW))
    labelled = lambda df: df.withColumn("match_outcome", label).filter("match_outcome IS NOT NULL")
    return Resolution(spec, labelled(scored), None if own is None else labelled(own), lrecords, rrecords, streamed)


def _with_copies(links: DataFrame, lrecords: DataFrame, rrecords: DataFrame) -> DataFrame:
    """Links between representatives of two tables, and one link for each of their copies."""
    rest = [c for c in links.columns if c not in ("id_a", "id_b")]
    via = lambda mine, other: links.groupBy(mine).agg(F.min(F.struct(other, *rest)).alias("m"))
    more_a = lrecords.filter("id <> rep").join(via("id_a", "id_b"), F.col("rep") == F.col("id_a"))
    more_b = rrecords.filter("id <> rep").join(via("id_b", "id_a"), F.col("rep") == F.col("id_b"))
    pick = [F.col(f"m.`{c}`").alias(c) for c in rest]
    more_a = more_a.select(F.col("id").alias("id_a"), F.col("m.id_b").alias("id_b"), *pick)
    more_b = more_b.select(F.col("m.id_a").alias("id_a"), F.col("id").alias("id_b"), *pick)
    return links.unionByName(more_a.select(*links.columns)).unionByName(more_b.select(*links.columns))


def resolve_step(primary: DataFrame, spec: MatchSpec, secondary: DataFrame | None = None) -> DataFrame:
    """The step's table: matched pairs with both sides' columns, then unmatched records."""
    result = resolve(primary, spec, secondary)
    other = primary if secondary is None else secondary
    sid = spec.id_column if secondary is None else spec.secondary_id_column or spec.id_column
    a_id, b_id = f"{spec.primary_alias}_match_id", f"{spec.secondary_alias}_match_id"
    def named(df: DataFrame, alias: str, key: str, match_id: str) -> DataFrame:
        return df.select(F.col(f"`{key}`").alias(match_id), *[F.col(f"`{c}`").alias(f"{alias}_{c}") for c in df.columns])
    left = named(primary, spec.primary_alias, spec.id_column, a_id)
    right = named(other, spec.secondary_alias, sid, b_id)
    pairs = result.pairs.withColumnsRenamed({"id_a": a_id, "id_b": b_id})
    mine = result.records.filter(F.col("side") == spec.primary_alias)
    group = mine.select(F.col("id").alias(a_id), "match_group_id")
    full = pairs.join(group, a_id).join(left, a_id).join(right, b_id)
    none = result.records.filter(F.col("match_outcome") == NONE)
    lonely = none.filter(F.col("side") == spec.primary_alias).select(F.col("id").alias(a_id), "match_outcome")
    full = full.unionByName(lonely.join(left, a_id), allowMissingColumns=True)
    if secondary is not None:
        lonely = none.filter(F.col("side") == spec.secondary_alias).select(F.col("id").alias(b_id), "match_outcome")
        full = full.unionByName(lonely.join(right, b_id), allowMissingColumns=True)
    return full
