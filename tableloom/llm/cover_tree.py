"""Hard negatives by cover trees over candidates of one length.

Every candidate gets one more component, which brings all candidates to the same length M, and
queries get 0 there. Then ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``: the nearer, the higher the inner
product. Candidates are dealt into blocks, by label where a label is large, and a task builds
a cover tree of each block: centres of a level stand further apart than the level's radius,
every point lies within the radius before of its parent, and the radius halves from level to
level. A node keeps how far its farthest descendant is, so the distance of its centre to a
query bounds all inner products below it from both sides.

A search goes down best first. A node is skipped if everything below it is worse than what is
found, or outside all windows of scores asked for. What is left is scored in whole numbers.
First each anchor's positives are searched, in the blocks of its label; they give the windows,
and all windows of an anchor are searched at once in the blocks of the other labels. Trees are
a table; bounded groups of anchors are sent to them, and at most k rows for each window and
block come back. A row's score is compared with every anchor's in this way, in blocks of rows
and blocks of the stated anchors.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take
no part; only vectors of the same length are compared; repeated ids are rows of their own,
but never positives or negatives of an anchor with that id, and an anchor that stands there
twice is answered twice; ties go to the smaller id; with too few rows all are returned; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.operators.keys import broadcast_if_small
from tableloom.session import settle

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
#: Percentages of the positive's score between which a negative's lies.
LOW, HIGH = 50, 95
#: Rows of a tree, anchors sent together, and trees that share one copy of them.
BLOCK_ROWS, CHUNK_ANCHORS, LANE_BLOCKS = 2048, 256, 16
#: Up to here sums of products are exact as doubles, and as 64-bit numbers.
_DOUBLE, _LONG = 2.0**52, 2.0**62
_FAR = 2**63 - 1


def whole_rows(rows: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """``uid, id, label, dim, v, tie``: usable rows with ``floor(scale * x)`` of each component and a number to deal them by."""
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.select(F.col(f"`{key}`").cast("long").alias("id"), label.cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"))
    good = good.withColumnRenamed("vector", vector).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & usable)
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return good.select(F.monotonically_increasing_id().alias("uid"), "id", "label", F.size(vector).alias("dim"), v.alias("v"), F.rand(13).alias("tie"))


# -- one tree ------------------------------------------------------------------


class CoverTree:
    """A block of rows, each of them one node; ``build`` makes it and ``search`` asks it."""

    def __init__(self, ids, labels, points, top, reach, child, first):
        self.ids, self.labels, self.points = ids, labels, points
        self.top, self.reach, self.child, self.first = top, reach, child, first
        self.same = labels[0] if len(set(labels)) == 1 else None

    @classmethod
    def build(cls, ids: np.ndarray, labels: list[str], points: np.ndarray, longest: float) -> CoverTree:
        """``points`` are whole numbers, ``longest`` is the square of the length all candidates are brought to."""
        n = len(ids)
        x = points.astype(np.float64)
        square = (x * x).sum(1)
        x = np.column_stack([x, np.sqrt(np.maximum(longest - square, 0.0))])
        apart = lambda i: np.sqrt(((x - x[i]) ** 2).sum(1))
        near, home = apart(0), np.zeros(n, np.int64)  # distance to the nearest centre so far, and which it is
        parent, centre = np.full(n, -1), np.zeros(n, bool)
        centre[0] = True
        radius, order = near.max(), [0]
        while True:
            # equal points are no centres of their own: they become children of their centre at the end
            radius = radius / 2
            at_home = home.copy()
            for i in np.flatnonzero(near > radius):
                if near[i] <= radius:
                    continue
                parent[i], centre[i] = at_home[i], True
                order.append(i)
                far = apart(i)
                closer = far < near
                near[closer], home[closer] = far[closer], i
            if not (near > 0).any():
                break
            radius = min(radius, near.max())
        rest = np.flatnonzero(~centre)
        parent[rest] = home[rest]
        # children stand before their parents when the order is read backwards
        reach = np.zeros(n)
        member: list[list[int]] = [[i] for i in range(n)]
        kids: list[list[int]] = [[] for _ in range(n)]
        for i in [*order, *rest.tolist()][::-1]:
            below = np.array(member[i])
            reach[i] = np.sqrt(((x[below] - x[i]) ** 2).sum(1).max()) * (1 + 1e-9)
            if parent[i] >= 0:
                kids[parent[i]].append(i)
                member[parent[i]] += member[i]
                member[i] = []
        first = np.cumsum([0] + [len(k) for k in kids])
        child = np.array([i for k in kids for i in k], np.int64)
        return cls(ids, labels, points, 0, reach, child, first)

    def search(self, query: np.ndarray, own: int, label: str, alike: bool, windows: np.ndarray, k: int, longest: float, exact: type) -> list[list[tuple[int, int]]]:
        """For each window (low, high) its first ``k`` rows as (score, id): of the label (``alike``) or of others, the own id excepted."""
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        if self.same is not None and (self.same == label) != alike:
            return best
        points = self.points.astype(exact) if self.points.dtype != exact else self.points
        query = query.astype(exact)
        length = float((query.astype(np.float64) ** 2).sum()) + longest
        slack = 1 + 1e-9 * length
        low, high = [int(a) for a, _ in windows], [int(b) for _, b in windows]
        floor = list(low)

        def take(rows: np.ndarray, scores: np.ndarray) -> None:
            for j in range(len(best)):
                fit = (scores >= floor[j]) & (scores <= high[j])
                for r in np.flatnonzero(fit):
                    row, score = rows[r], int(scores[r])
                    if (self.labels[row] == label) == alike and self.ids[row] != own:
                        best[j].append((-score, int(self.ids[row])))
                if len(best[j]) > k:
                    best[j] = heapq.nsmallest(k, best[j])
                if len(best[j]) == k:
                    floor[j] = max(low[j], -max(best[j])[0])

        def bounds(scores: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            away = np.sqrt(np.maximum(length - 2 * scores.astype(np.float64), 0.0))
            least, most = np.maximum(away - self.reach[rows], 0.0), away + self.reach[rows]
            return (length - most**2) / 2 - slack, (length - least**2) / 2 + slack

        useful = lambda worst, top: any(top >= floor[j] and worst <= high[j] for j in range(len(best)))
        start = np.array([self.top])
        score = points[start] @ query
        take(start, score)
        worst, top = bounds(score, start)
        heap = [(-top[0], worst[0], self.top)]
        while heap:
            minus, worst_here, node = heapq.heappop(heap)
            if not useful(worst_here, -minus):
                continue
            rows = self.child[self.first[node]:self.first[node + 1]]
            if not len(rows):
                continue
            scores = points[rows] @ query
            take(rows, scores)
            inner = np.flatnonzero(self.first[rows + 1] > self.first[rows])
            if len(inner):
                worst, top = bounds(scores[inner], rows[inner])
                for w, t, r in zip(worst.tolist(), top.tolist(), rows[inner].tolist()):
                    heapq.heappush(heap, (-t, w, r))
        return [[(-s, i) for s, i in sorted(b)] for b in best]


_TREE = "dim int, grp string, bucket int, n int, ids binary, labels array<string>, kind string, points binary, reach binary, child binary, first binary"


def _smallest(points: np.ndarray) -> str:
    """The smallest whole-number type that holds the points."""
    return next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.array_equal(points.astype(k), points))


def trees(rows: DataFrame, longest: float) -> DataFrame:
    """A row for each block (``dim, grp, bucket``) with its rows and the tree over them."""
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        values = np.array(table["v"].to_pylist(), np.int64).reshape(len(ids), -1)[order]
        tree = CoverTree.build(ids[order], [table["label"][int(i)].as_py() for i in order], values, longest)
        kind = _smallest(values) if values.size else "<i1"
        row = {
            "dim": table["dim"][0].as_py(), "grp": table["grp"][0].as_py(), "bucket": table["bucket"][0].as_py(), "n": len(ids), "ids": tree.ids.astype("<i8").tobytes(),
            "labels": tree.labels, "kind": kind, "points": values.astype(kind).tobytes(), "reach": tree.reach.astype("<f8").tobytes(),
            "child": tree.child.astype("<i4").tobytes(), "first": tree.first.astype("<i4").tobytes(),
        }
        types = dict(dim=pa.int32(), grp=pa.string(), bucket=pa.int32(), n=pa.int32(), ids=pa.binary(), labels=pa.list_(pa.string()), kind=pa.string(), points=pa.binary(), reach=pa.binary(), child=pa.binary(), first=pa.binary())
        return pa.table({c: pa.array([row[c]], t) for c, t in types.items()})

    return rows.select("id", "label", "dim", "v", "grp", "bucket").groupBy("dim", "grp", "bucket").applyInArrow(run, _TREE)


def _loaded(row: dict) -> CoverTree:
    whole = lambda c: np.frombuffer(row[c], "<i4").astype(np.int64)
    points = np.frombuffer(row["points"], row["kind"]).reshape(row["n"], -1)
    return CoverTree(np.frombuffer(row["ids"], "<i8"), row["labels"], points, 0, np.frombuffer(row["reach"], "<f8"), whole("child"), whole("first"))


def _searched(pairs: DataFrame, k: int, alike: bool, longest: float, exact: type) -> DataFrame:
    """``uid, nth, id, score``: the first ``k`` rows of each window of each anchor, over all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                tree = _loaded(row)
                tree.points = tree.points.astype(exact)
                out: tuple[list, ...] = ([], [], [], [])
                for a in row["anchors"]:
                    found = tree.search(np.array(a["v"], np.int64), a["id"], a["label"], alike, a["windows"], k, longest, exact)
                    for nth, rows in enumerate(found):
                        for score, id_ in rows:
                            for column, value in zip(out, (a["uid"], nth, id_, score)):
                                column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["uid", "nth", "id", "score"])

    kept = pairs.select("n", "ids", "labels", "kind", "points", "reach", "child", "first", "anchors")
    found = kept.mapInArrow(run, "uid long, nth int, id long, score long")
    order = Window.partitionBy("uid", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# -- the mining ----------------------------------------------------------------


def dealt(vectors: DataFrame, anchor: Column) -> DataFrame:
    """``vectors`` with their block ``grp, bucket`` and the number of blocks and anchors of the group.

    A label with half a block of rows or more has blocks of its own, over which chance deals its rows. Smaller labels
    share blocks, each label in one of them.
    """
    sizes = vectors.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(anchor, 1)).alias("asked"))
    sizes = settle(sizes, "labels")
    small = F.col("rows") * 2 < BLOCK_ROWS
    pool = sizes.filter(small).groupBy("dim").agg(F.ceil(F.sum("rows") / BLOCK_ROWS).cast("int").alias("pools"))
    placed = sizes.join(broadcast_if_small(pool), "dim", "left").select(
        F.col("dim").alias("d"), F.col("label").alias("l"), F.when(small, F.lit("")).otherwise(F.concat(F.lit("="), "label")).alias("grp"),
        F.when(small, F.pmod(F.xxhash64("label"), F.col("pools"))).cast("int").alias("pool"),
        F.when(small, F.lit(1)).otherwise(F.ceil(F.col("rows") / BLOCK_ROWS)).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("asked") / CHUNK_ANCHORS), F.lit(1)).cast("int").alias("chunks"),
    )
    joined = vectors.join(broadcast_if_small(placed), (F.col("dim") == F.col("d")) & (F.col("label") == F.col("l")))
    bucket = F.coalesce("pool", F.least(F.floor(F.col("tie") * F.col("blocks")), F.col("blocks") - 1).cast("int"))
    return joined.withColumn("bucket", bucket).drop("d", "l")


def _anchors(rows: DataFrame, windows: Column, *keys: str) -> DataFrame:
    """Anchors gathered in bounded groups by ``keys``, each with its windows of scores."""
    one = F.struct("uid", "id", "label", "v", windows.alias("windows"))
    return rows.groupBy(*keys).agg(F.collect_list(one).alias("anchors"))


def mine(
    rows: DataFrame, key: str, vector: str, label: Column, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: each anchor's hardest negatives for each of its positives.

    ``anchor`` is a condition on ``id``. A negative has another label and a score from ``low`` to ``high`` percent of the positive's.
    """
    vectors = settle(whole_rows(rows, key, vector, label, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, m, longest = vectors.agg(F.count(F.lit(1)), F.count(F.when(anchor, 1)), F.max(square)).first()
    longest = longest or 0.0
    exact = np.float64 if longest < _DOUBLE else np.int64 if longest < _LONG else object
    placed = settle(dealt(vectors, anchor), "dealt")
    index = settle(trees(placed, longest), "trees")
    asked = placed.filter(anchor)
    everything = F.array(F.array(F.lit(-_FAR), F.lit(_FAR)))

    # positives: each anchor meets the blocks of its own label
    own = _anchors(asked.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks"))), everything, "dim", "grp", "label", "pool", "blocks", "chunk")
    own = own.withColumn("bucket", F.explode(F.when(F.col("pool").isNull(), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("pool"))))
    met = index.join(own.select("dim", "grp", "bucket", "anchors"), ["dim", "grp", "bucket"])
    first = settle(_searched(met, positives, True, longest, exact), "positives")

    # negatives: each anchor meets all blocks but those of its own label alone
    part = lambda percent, more: F.call_function("div", F.col("score").cast("decimal(20,0)") * F.lit(percent) + F.lit(more), F.lit(100))
    none = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))  # half of a negative score is more than the score
    window = F.when(F.col("score") < 0, none).otherwise(F.array(part(low, 99), part(high, 0)))
    sought = first.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("rank", window.alias("w"), F.col("id").alias("positive_id"), "score"))).alias("p"))
    sought = asked.join(sought, "uid")
    blocks = max(1, -(-n // BLOCK_ROWS))
    lanes = min(blocks, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // LANE_BLOCKS)))
    groups = max(1, -(-m // CHUNK_ANCHORS))
    packed = _anchors(sought.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(groups))), F.transform("p", lambda x: x["w"]), "dim", "chunk")
    packed = packed.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    laid = index.withColumn("lane", F.pmod(F.xxhash64("grp", "bucket"), F.lit(lanes)).cast("int"))
    hard = _searched(packed.select("dim", "lane", "anchors").join(laid, ["dim", "lane"]), negatives, False, longest, exact)
    answer = hard.select("uid", (F.col("nth") + 1).alias("prank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    for_each = first.select("uid", F.col("rank").alias("prank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = asked.select("uid", F.col("id").alias("anchor_id"))
    out = answer.join(for_each, ["uid", "prank"]).join(named, "uid")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
