"""Shards by a tree of weighted hash draws.

Shards stand in racks and racks in regions. A document goes down this tree: at each level
every child draws a clock ``-ln(u) / weight`` from a hash of the document's key and the
child's name, and the earliest clock wins, so a child wins in proportion to its weight. A
child's weight is the sum of the weights below it.

A tree has a base, the shards it was built with, and the shards added since. An added shard
is more weight for its rack and region, and this weight has a clock of its own: the region's
clock is the earlier of its base clock and those of what was added in it. Where an added
clock wins, the document goes down the added branch, which ends in the new shard. No other
clock is touched, so a further shard takes documents only into itself, whatever its region.
``reweighted`` changes a shard of the base: only clocks on the way to it change, so documents
move only out of, into or within its region, and inside that region only to or from its rack.

Documents get slots, gapless from 0 in each shard, in the order of a hash of their key.
Rows are numbered range by range, so a shard is never sorted in one task.

Defined cases: a null key is the empty text, so such rows share a shard, and their slots are
still spread over ranges; a null text has no bytes and the sum of no bytes (0); repeated ids
share a shard and have slots of their own; equal rows are numbered in any order; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.operators.numbering import with_ranges
from tableloom.session import settle

#: A draw is the first 13 hexadecimal digits of a digest: 52 bits, exact as a double.
DIGITS, SPAN = 13, float(2**52)
#: What a document takes besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Added:
    """A shard added to a region and a rack (which may be new), with its weight."""

    region: int
    rack: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Weights by region, rack and shard as first built, and the shards added since; shards are numbered in this order."""

    base: tuple[tuple[tuple[float, ...], ...], ...]
    added: tuple[Added, ...] = ()

    @property
    def built(self) -> int:
        return sum(len(rack) for region in self.base for rack in region)

    @property
    def shards(self) -> int:
        return self.built + len(self.added)

    def grown(self, region: int, rack: int, weight: float = 1.0) -> Tree:
        """The tree with one more shard."""
        if weight <= 0:
            raise ValueError("a shard needs a weight above 0")
        return replace(self, added=(*self.added, Added(region, rack, weight)))

    def reweighted(self, region: int, rack: int, shard: int, weight: float) -> Tree:
        """The tree with another weight, 0 for none, at a place of the base."""
        racks = list(self.base[region])
        racks[rack] = tuple(weight if i == shard else w for i, w in enumerate(racks[rack]))
        return replace(self, base=tuple(tuple(racks) if i == region else r for i, r in enumerate(self.base)))


def even_tree(racks: tuple[tuple[int, int], ...]) -> Tree:
    """Regions given as (racks, shards in each rack), all shards of weight 1."""
    return Tree(tuple(tuple((1.0,) * shards for _ in range(n)) for n, shards in racks))


#: Forty shards in three regions of different shapes.
FORTY = even_tree(((4, 4), (3, 4), (2, 6)))
#: Where the query's further shard is put: a new rack of the second region.
NEXT = Added(1, 3)


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def _draw(key: Column, name: Column) -> Column:
    """A whole number of 52 bits, as a double, from a key and a name."""
    digest = F.md5(F.concat(key, F.lit("|"), name).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")


def _clock(key: Column, name: Column, weight: Column) -> Column:
    """When a child arrives; one without weight never does."""
    return F.when(weight > 0, -F.log((_draw(key, name) + 1) / F.lit(SPAN)) / weight).otherwise(F.lit(float("inf")))


def _children(entries: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("at")) for i, (n, w) in enumerate(entries)])


def _race(key: Column, children: Column) -> Column:
    """``clock, at`` of the child that arrives first; ties go to the lower number."""
    return F.array_min(F.transform(children, lambda c: F.struct(_clock(key, c["name"], c["weight"]).alias("clock"), c["at"].alias("at"))))


def _down(df: DataFrame, tree: Tree, key: Column) -> DataFrame:
    """``df`` with ``_first``: the winning clock of the base's regions and the shard reached below it."""
    weights = [[[sum(rack), rack] for rack in region] for region in tree.base]
    regions = _children([(f"region {r}", sum(w for w, _ in racks)) for r, racks in enumerate(weights)])
    racks = F.array(*[_children([(f"rack {r}.{k}", w) for k, (w, _) in enumerate(racks)]) for r, racks in enumerate(weights)])
    shards = F.array(*[
        F.array(*[_children([(f"shard {r}.{k}.{s}", w) for s, w in enumerate(rack)]) for k, (_, rack) in enumerate(racks)])
        for r, racks in enumerate(weights)
    ])
    starts, n = [], 0
    for racks_here in weights:
        starts.append([])
        for _, rack in racks_here:
            starts[-1].append(n)
            n += len(rack)
    first = F.array(*[F.array(*map(F.lit, row)) for row in starts])
    within = lambda nested, *path: within(F.get(nested, path[0]), *path[1:]) if path else nested
    df = df.withColumn("_region", _race(key, regions))
    df = df.withColumn("_rack", _race(key, within(racks, F.col("_region.at")))["at"])
    df = df.withColumn("_leaf", _race(key, within(shards, F.col("_region.at"), F.col("_rack")))["at"])
    shard = within(first, F.col("_region.at"), F.col("_rack")) + F.col("_leaf")
    return df.withColumn("_first", F.struct(F.col("_region.clock").alias("clock"), shard.alias("shard"))).drop("_region", "_rack", "_leaf")


def _reached(tree: Tree, key: Column) -> Column:
    """The shard of a document: the base's, unless the clock of something added is earlier."""
    late = [
        F.struct(_clock(key, F.lit(f"added {tree.built + i} in region {a.region}, rack {a.rack}"), F.lit(float(a.weight))).alias("clock"), F.lit(tree.built + i).alias("shard"))
        for i, a in enumerate(tree.added)
    ]
    return (F.array_min(F.array(F.col("_first"), *late)) if late else F.col("_first"))["shard"].cast("int")


def shards(docs: DataFrame, trees: dict[str, Tree], key: str = "doc_id") -> DataFrame:
    """``docs`` with the shard of each row under each of several states of one tree, which share their base."""
    if len({t.base for t in trees.values()}) != 1:
        raise ValueError("the trees must share their base")
    packed = docs.select(F.struct("*").alias("row"), key_text(F.col(f"`{key}`")).alias("_key"))
    placed = _down(packed, next(iter(trees.values())), F.col("_key"))
    found = placed.select("row", *[_reached(t, F.col("_key")).alias(f"_shard{i}") for i, t in enumerate(trees.values())])
    return found.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in trees}],
        *[F.col(f"_shard{i}").alias(n) for i, n in enumerate(trees)],
    )


def assign(docs: DataFrame, tree: Tree = FORTY, more: Added = NEXT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: where each document goes, now and with one more shard."""
    taken = docs.select(
        F.col(f"`{key}`").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = shards(taken, {"shard": tree, "grown_shard": tree.grown(more.region, more.rack, more.weight)}, "doc_id")
    # cutting ranges looks at its input twice, so texts are read into the small columns first
    return slots(settle(placed.withColumn("law", F.lit("key")), "placed")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    )


def slots(placed: DataFrame) -> DataFrame:
    """``placed`` (doc_id, size, text_crc32, shard and more) with ``slot``: a gapless number from 0 in each shard.

    The order is a hash of the id, then id, size and sum. Equal rows are kept apart by a random number, so that many of
    them spread over ranges; it does not show in the result. The ranges are written before their sizes are counted.
    """
    order = [("_draw", "asc"), ("doc_id", "asc"), ("size", "asc"), ("text_crc32", "asc"), ("_tie", "asc")]
    drawn = placed.withColumns({"_draw": _draw(key_text(F.col("doc_id")), F.lit("slot")), "_tie": F.rand(7)})
    ranged = with_ranges(drawn, ["shard"], order)
    sizes = ranged.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row for each range of a shard, so few whatever the table holds
    starts = sizes.select("shard", "__range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = Window.partitionBy("shard", "__range").orderBy(*[c for c, _ in order])
    numbered = ranged.withColumn("_at", F.row_number().over(local)).join(starts, ["shard", "__range"])
    return numbered.withColumn("slot", (F.col("_start") + F.col("_at") - 1).cast("long")).select(*placed.columns, "slot")


def write_shards(docs: DataFrame, path: str, tree: Tree = FORTY, key: str = "doc_id", text: str = "text", files: int = 16) -> None:
    """Write whole documents into one folder for each shard, ``files`` tasks writing each of them.

    The column ``shard`` names the folders; one that ``docs`` has already is replaced.
    """
    rows = shards(docs, {"shard": tree}, key)
    spread = rows.repartition("shard", F.pmod(F.xxhash64(f"`{key}`", f"`{text}`"), F.lit(files)))
    spread.write.partitionBy("shard").parquet(path)
