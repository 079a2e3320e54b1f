"""Exact Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes. It is cut into
fragments, and every set with it, once to find candidates and once to count:

* *Candidates.* Two sets of similarity ``t`` whose smaller one has at most ``hi``
  members differ in at most ``D = hi * (1 - t) / t`` members, and each of these spoils one
  fragment. Cut into ``D + 1 + spare`` fragments they agree in at least ``1 + spare``
  whole ones, so sets that share a fragment's fingerprint are the candidates. Sets
  are cut by size scheme; a set near a scheme's edge is cut for both. Fingerprints
  that very many sets have (a common line alone in its fragment) are left out for
  a set with no more of them than ``spare`` allows for, which loses no pair.
* *Parities.* A set's members are dealt to places, and the parity of each place is kept. Two sets differ in at least as
  many members as their parities differ in places, so most candidates are dropped by a few words of bits, without their texts.
* *Counts.* The overlap of a candidate pair is counted fragment by fragment and summed per pair. A set travels once
  for each pair, to the other one's place, straight from its text.

Documents with equal sets are one node. Groups of near copies are not expanded: each
node is first verified against the smallest one of most of its groups; then, between
nodes that are still in different components, parities are compared block
by block inside the tasks, and only pairs that can reach the threshold are counted.
A group of any size is dealt over its pairs of blocks.

Defined cases: a null text, or one without words, has an empty set and is linked
with nothing; fewer words than n are one n-gram; repeated rows are linked with
each other; a null id never becomes a component's id unless all of its rows
have none, and its rows link others like any row; rows with one id are rows of their own; an empty table gives an empty result; other columns are not read.
Sets, and rows by id and text, are told apart by 64-bit fingerprints.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.llm.batches import pieces
from tableloom.llm.shingles import Shingler, mix
from tableloom.operators.graph import connected_components
from tableloom.session import giving_back, settle, shared_folder

#: A fingerprint of more rows than this is common; blocks of this many nodes are compared in a task.
COMMON, BLOCK = 64, 512
#: Open groups of a node that are listed with it, and pairs compared at once.
LISTED, TOGETHER = 128, 1 << 17
#: Members of a fragment when overlaps are counted.
COUNTED = 512


class Scheme:
    """The cuts for pairs whose smaller set has ``lo`` to ``hi`` members."""

    def __init__(self, lo: int, hi: int, t: Fraction):
        self.lo, self.hi, self.most = lo, hi, int(hi / t)
        self.differ = int(hi * (1 - t) / t)
        parts = self.differ + 1
        self.spare_empty = self.spare_common = 1 + math.ceil(0.04 * parts)
        self.cuts = parts + self.spare_empty + self.spare_common if self.differ else 0
        self.wide = 64 * math.ceil(1.25 * hi / 64)


def schemes(t: Fraction, most: int = 1 << 40) -> list[Scheme]:
    """Size ranges growing by half, up to more members than any text has."""
    out, lo = [], 1
    while lo <= most and len(out) < 64:
        hi = max(lo, lo * 3 // 2)
        out.append(Scheme(lo, hi, t))
        lo = hi + 1
    return out


_EDGES: dict[int, np.ndarray] = {}


def _edges(parts: int) -> np.ndarray:
    """Inner edges of equal ranges; a task remembers those of its schemes."""
    if parts not in _EDGES:
        _EDGES[parts] = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return _EDGES[parts]


def _cut(members: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of ``parts`` equal ranges of the hash order in a sorted set."""
    return np.concatenate(([0], np.searchsorted(members, _edges(parts)), [len(members)]))


def _sums(members: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint of each fragment's members; 0 for an empty one."""
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(members ^ np.uint64(0x5851F42D4C957F2D)))))
    return total[bounds[1:]] - total[bounds[:-1]]


def _node(members: np.ndarray) -> int:
    """The fingerprint of a whole set."""
    with np.errstate(over="ignore"):
        return int((mix(_sums(members, np.array([0, len(members)])) + np.uint64(len(members)))).view(np.int64)[0])


def _parities(members: np.ndarray, wide: int) -> np.ndarray:
    """The parity of the number of members in each of ``wide`` places, as 64-bit words."""
    place = ((members >> np.uint64(32)) * np.uint64(wide) >> np.uint64(32)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=wide) & 1).astype(np.uint8)).view(np.int64)


_BITS = "array<struct<s:int,bits:array<long>>>"


def nodes(docs: DataFrame, key: str, text: str, words: int, t: Fraction) -> DataFrame:
    """``doc, h, n, node, parities``: the text's hash, the size, the fingerprint and, for each scheme, the parities of every row's set."""
    table = schemes(t)
    kind = pa.list_(pa.struct([("s", pa.int32()), ("bits", pa.list_(pa.int64()))]))

    def parities(members: np.ndarray) -> list[dict]:
        fitting = [(s, x) for s, x in enumerate(table) if x.cuts and x.lo <= len(members) <= x.most]
        return [{"s": s, "bits": _parities(members, x.wide)} for s, x in fitting]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = [shingler(value or "") for value in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), piece.column("h"), pa.array([len(m) for m in sets], pa.int64()), pa.array(list(map(_node, sets)), pa.int64()),
                     pa.array(list(map(parities, sets)), kind)],
                    names=["doc", "h", "n", "node", "parities"],
                )

    return docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("h"), F.col(text).alias("text")).mapInArrow(run, f"doc long, h long, n long, node long, parities {_BITS}")


def fingerprints(docs: DataFrame, text: str, words: int, t: Fraction) -> DataFrame:
    """``key, node``: the fragments' fingerprints of every row; a key holds its scheme in its last six bits."""
    table = schemes(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for piece in pieces(batch, "text"):
                keys, node, count = [], [], []
                for value in piece.column("text").to_pylist():
                    members = shingler(value or "")
                    for s, scheme in enumerate(table):
                        if scheme.cuts and scheme.lo <= len(members) <= scheme.most:
                            bounds = _cut(members, scheme.cuts)
                            with np.errstate(over="ignore"):
                                marked = mix(_sums(members, bounds) + mix(np.arange(scheme.cuts, dtype=np.uint64) * np.uint64(64) + np.uint64(s + 1)))
                            marked = (marked & ~np.uint64(63)) | np.uint64(s)
                            empty = bounds[1:] == bounds[:-1]
                            keys.append(marked if empty.sum() > scheme.spare_empty else marked[~empty])
                            node.append(_node(members))
                            count.append(len(keys[-1]))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(node, np.int64), count))], names=["key", "node"],
                    )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key long, node long")


def _possible(pairs: DataFrame, bits: DataFrame, t: Fraction) -> DataFrame:
    """The pairs ``(a, b, s)`` whose parities differ in no more places than sets of their sizes may differ in members."""
    side = lambda x: bits.select(F.col("node").alias(x), "s", F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    differ = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    both = pairs.join(side("a"), ["a", "s"]).join(side("b"), ["b", "s"])
    return both.filter(differ * (t.denominator + t.numerator) <= (F.col("na") + F.col("nb")) * (t.denominator - t.numerator)).select("a", "b", "s")


def _cut_for(texts: DataFrame, words: int) -> DataFrame:
    """``node, to, parts, part, n, members``: the sets of ``texts`` (node, to, parts, text), cut into ``parts`` for the node they go to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                out = []
                for node, to, parts, value in zip(*[piece.column(c).to_pylist() for c in ("node", "to", "parts", "text")]):
                    members = shingler(value or "")
                    bounds = _cut(members, parts)
                    out += [(node, to, parts, i, len(members), members[a:b].view(np.int64)) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else ([],) * 6, types)], names=["node", "to", "parts", "part", "n", "members"])

    return texts.select("node", "to", "parts", "text").mapInArrow(run, "node long, to long, parts int, part int, n long, members array<long>")


def _at(doc: str, h: str) -> Column:
    """Where a text is found: the fingerprint of its row's id, which may be missing or repeated, and of its own hash."""
    return F.xxhash64(doc, h)


def _texts_of(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``at, text`` of the rows that ``wanted`` (at, copies) asks for, and how to give them back.

    They are dealt to buckets once, before they meet what is asked for, so that neither this join nor those on the table move a
    text again. Only rows that are alike in id and text are told apart by taking one of them.
    """
    spark, name = docs.sparkSession, f"texts_{uuid.uuid4().hex}"
    path, buckets = f"{shared_folder(spark)}/{name}", _partitions(spark)
    every = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    every = every.select(_at("doc", "h").alias("at"), "text").repartition(buckets, "at")
    met = every.join(wanted.select("at", "copies").repartition(buckets, "at"), "at")
    texts = met.filter("copies = 1").select("at", "text").unionByName(met.filter("copies > 1").select("at", "text").dropDuplicates(["at"]))
    with giving_back(spark):
        texts.write.bucketBy(buckets, "at").option("path", path).saveAsTable(name)

    def forget() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return spark.table(name), forget


def _verified(pairs: DataFrame, info: DataFrame, texts: DataFrame, words: int, t: Fraction) -> DataFrame:
    """The pairs ``(a, b)`` whose overlap, counted by fragment and summed, reaches the threshold.

    The set of a travels to b, cut as finely as the smaller one of both needs it, and b's own once for all of them.
    """
    side = lambda x: info.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"at{x}"))
    both = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    cuts = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.least("na", "nb") / COUNTED)), F.lit(0))).cast("int")
    both = settle(both.withColumn("parts", cuts), "pairs")
    sent = lambda x: both.select(F.col(f"at{x}").alias("at"), F.col(x).alias("node"), F.col("b").alias("to"), "parts")
    here, mine = (_cut_for(texts.join(asked, "at"), words) for asked in (sent("a"), sent("b").distinct()))
    counted = here.join(mine.select("to", "parts", "part", F.col("n").alias("nb"), F.col("members").alias("mb")), ["to", "parts", "part"])
    summed = counted.groupBy(F.col("node").alias("a"), F.col("to").alias("b")).agg(
        F.sum(F.size(F.array_intersect("members", "mb"))).alias("o"), F.first("n").alias("na"), F.first("nb").alias("nb"),
    )
    near = F.col("o") * t.denominator >= (F.col("na") + F.col("nb") - F.col("o")) * t.numerator
    return summed.filter(near).select("a", "b")


def _across(rows: DataFrame, t: Fraction, parts: int) -> DataFrame:
    """``a, b, s``: pairs of nodes of one group in different components whose parities can reach the threshold.

    ``rows`` has ``key, i, j, side, node, comp, n, s, bits, own``: a node of block i or j of a group, on side 0 or
    1, with the groups before this one that it is in. A pair of nodes in several groups is given by the first of them.
    """
    up, down = t.denominator - t.numerator, t.denominator + t.numerator

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            tail = (pdf[["key", "i", "j"]] == pdf[["key", "i", "j"]].iloc[-1]).all(axis=1).to_numpy()
            yield from groups(pdf[~tail])
            rest = pdf[tail].reset_index(drop=True)
        if rest is not None:
            yield from groups(rest)

    def groups(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for s, part in pdf.groupby("s", sort=False):
            part = part.reset_index(drop=True)
            x = np.concatenate(part["bits"].to_numpy()).astype(np.uint64).reshape(len(part), -1)
            place = part[["key", "i", "j"]].to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]).any(axis=1))))
            side = part["side"].to_numpy()
            left, right, size = [], [], 0
            for lo, hi in zip(edges, [*edges[1:], len(part)]):
                if place[lo, 1] == place[lo, 2]:
                    a, b = np.triu_indices(hi - lo, 1)
                else:
                    one, two = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 1)
                    a, b = np.repeat(one, len(two)), np.tile(two, len(one))
                left.append(a + lo)
                right.append(b + lo)
                size += len(a)
                if size >= TOGETHER:
                    yield found(part, int(s), x, np.concatenate(left), np.concatenate(right))
                    left, right, size = [], [], 0
            if size:
                yield found(part, int(s), x, np.concatenate(left), np.concatenate(right))

    def found(part: pd.DataFrame, s: int, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        comp, n, node = (part[c].to_numpy() for c in ("comp", "n", "node"))
        apart = comp[a] != comp[b]
        a, b = a[apart], b[apart]
        most = (n[a] + n[b]) * up // down
        near = np.zeros(len(a), bool)
        for lo in range(0, len(a), 1 << 15):
            at = slice(lo, lo + (1 << 15))
            near[at] = np.add.reduce(np.bitwise_count(x[a[at]] ^ x[b[at]]), axis=1, dtype=np.int32) <= most[at]
        a, b = a[near], b[near]
        own = part["own"]
        first = np.array([own[i] is None or own[j] is None or set(own[i]).isdisjoint(own[j]) for i, j in zip(a, b)], bool)
        a, b = (a[first], b[first]) if len(first) else (a, b)
        return pd.DataFrame({"a": node[a], "b": node[b], "s": np.full(len(a), s, np.int32)})

    dealt = rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return dealt.mapInPandas(compare, "a long, b long, s int").distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, threshold: str = "0.9") -> DataFrame:
    """``key, n_shingles, component_id`` of every row: the smallest id reachable by links of at least ``threshold``."""
    own = F.when(F.col("n") > 0, F.col("first.doc")).otherwise(F.col("doc"))
    return _classes(docs, key, text, words, threshold).select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _classes(docs: DataFrame, key: str, text: str, words: int, threshold: str) -> DataFrame:
    """``doc, h, n, first`` of every row: its id, its text's hash, its set's size, and the first row of its class."""
    t = Fraction(threshold)
    table = schemes(t)
    spark = docs.sparkSession
    marks = settle(nodes(docs, key, text, words, t), "nodes")
    rows = fingerprints(docs, text, words, t).repartition(_partitions(spark), "key")
    groups = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).cast("int").alias("size"))
    shared = groups.filter("first <> last").select("key", "first", "size")
    grouped = settle(rows.join(shared, "key").select("key", "node", "first", "size").distinct(), "groups")
    grouped = grouped.withColumn("s", F.col("key").bitwiseAND(F.lit(63)).cast("int"))
    spare = F.element_at(F.array(*[F.lit(x.spare_common) for x in table]), F.col("s") + 1)
    weak = settle(grouped.filter(F.col("size") > COMMON).groupBy("node", "s").agg(F.count(F.lit(1)).alias("common")), "common")
    kept = grouped.join(weak, ["node", "s"], "left").filter((F.col("size") <= COMMON) | (F.col("common") > spare)).drop("common")
    # one pair for each node first: that with the smallest node of most of its groups
    often = kept.filter("node <> first").groupBy("node", "s", "first").agg(F.count(F.lit(1)).alias("n"))
    stars = often.groupBy(F.col("node").alias("a"), "s").agg(F.max_by("first", F.struct("n", "first")).alias("b"))
    row = F.struct(F.col("doc").isNull().alias("without"), "doc", "h")
    # a node's set is read from one of its rows
    each = marks.groupBy("node", "doc", "h").agg(F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("parities").alias("parities"))
    info = each.groupBy("node").agg(F.min(F.struct(F.col("doc").isNull().alias("without"), "doc", "h", "copies", "n", "parities")).alias("one"))
    info = settle(info.select("node", _at("one.doc", "one.h").alias("at"), "one.copies", "one.n", "one.parities"), "wanted")
    bits = info.select("node", "n", F.explode("parities").alias("p")).select("node", "n", "p.s", "p.bits")
    stars = settle(_possible(stars, bits, t), "stars")
    # texts of nodes that share a group with another one; whatever is compared is read from these
    wanted = info.join(kept.select("node").union(kept.select("first")).distinct(), "node", "left_semi")
    texts, forget = _texts_of(docs, key, text, wanted)
    links = settle(_verified(stars, info, texts, words, t), "links")
    found = settle(connected_components(links), "classes")

    again = kept.join(found, F.col("node") == F.col("id"), "left")
    again = again.select("key", "node", "s", F.coalesce("component", "node").alias("comp"))
    open_groups = again.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    open_rows = settle(again.join(open_groups.select("key", blocks.alias("blocks")), "key"), "open")
    listed = open_rows.groupBy("node", "s").agg(F.collect_list("key").alias("own"))
    listed = listed.select("node", "s", F.when(F.size("own") <= LISTED, F.col("own")).alias("own"))
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    full = open_rows.join(listed.join(bits, ["node", "s"]), ["node", "s"]).withColumn("own", F.filter("own", lambda k: k < F.col("key")))
    full = full.withColumn("m", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = full.select(
        "key", F.least("m", "o").alias("i"), F.greatest("m", "o").alias("j"), F.when(F.col("m") <= F.col("o"), 0).otherwise(1).alias("side"),
        "node", "comp", "n", "s", "bits", "own",
    )
    more = settle(_across(dealt, t, _partitions(spark)), "across")
    all_links = settle(links.union(_verified(more, info, texts, words, t)), "links")
    forget()
    classes = connected_components(all_links)
    smallest = marks.filter("n > 0").join(classes, F.col("node") == F.col("id"), "left").withColumn("class", F.coalesce("component", "node"))
    by_class = smallest.groupBy("node", "class").agg(F.min(row).alias("one"))
    ids = by_class.join(by_class.groupBy("class").agg(F.min("one").alias("first")), "class").select("node", "first")
    return marks.select("doc", "h", "n", "node").join(ids, "node", "left").select("doc", "h", "n", "first")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: str = "0.8") -> DataFrame:
    """``docs`` with one row of each class of linked documents: that of the smallest id.

    Documents without words stay; of rows alike in id and text one stays. Rows are told apart by id and
    text: of a repeated id only the rows stay that are first of their class, and a class without any id
    keeps the row of the text with the smallest hash.
    """
    found = _classes(docs, key, text, words, threshold)
    stays = (F.col("n") == 0) | (F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("h") == F.col("first.h")))
    first = found.filter(stays).groupBy(F.col("doc").alias("_doc"), F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("_copies"))
    # the caller's columns are one struct meanwhile, whatever they are called
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").cast("long").alias("_id"), F.xxhash64(f"`{text}`").alias("_t"))
    kept = packed.join(first, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_t") == F.col("_h")))
    # only rows that are alike in id and text are ordered, and moved once more
    rest = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (key, text)]
    alike = Window.partitionBy("_id", "_t").orderBy(F.to_json(F.struct(*rest)) if rest else F.lit(""))
    one = kept.filter("_copies > 1").withColumn("_nth", F.row_number().over(alike)).filter("_nth = 1")
    whole = [F.col(f"row.`{c}`") for c in docs.columns]
    return kept.filter("_copies = 1").select(*whole).unionByName(one.select(*whole))


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
