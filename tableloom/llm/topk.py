"""Exact top-k search by distributed histogram selection.

Vectors are turned into whole numbers and packed into blocks. Every block of
queries is scored against every block of rows as a matrix product, several times over:
first to count, for each query, how its scores spread over the bins of a range; the
counts of all blocks are added up, the bin that holds the k-th best score is found and
becomes the next range, until few rows lie above its lower edge or the edge is the
exact k-th score. A last pass keeps the scores at or above the edge, in a block at most the best
k with ties to the smaller id, and the ranks are numbered.

What meets in one place is one count per query and bin, or k rows per query
and block. The blocks are joined by number; the queries are a stated set of rows, so
the scores of all rows are the work that was asked for, and none is stored.

Defined cases: vectors that are null, of another length than the rest, or hold null
or non-finite values take no part; a row whose id is null takes no part; repeated ids
are rows of their own, ordered alike; with fewer than k rows all are returned; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.session import settle

K, SCALE = 20, 64
#: Rows in a block of candidates and of queries, and bins of a histogram.
BLOCK_ROWS, BLOCK_QUERIES, BINS = 4096, 1024, 64
#: Refining stops when at most this many rows of a query lie above the edge.
SLACK = 160


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id, v``: usable rows with ``floor(scale * x)`` of each component."""
    good = rows.filter(F.col(key).isNotNull() & _usable(F.col(vector)))
    return good.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def blocks(vectors: DataFrame, size: int, rows: int) -> DataFrame:
    """``block, n, ids, data``: about ``size`` rows each, packed; ``rows`` is the number of vectors."""
    count = max(1, -(-rows // size))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        data = np.array(pdf["v"].tolist(), dtype="<i8")
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "n": [len(pdf)], "ids": [pdf["id"].to_numpy("<i8").tobytes()], "data": [data.astype("<f8").tobytes()]})

    return dealt.groupBy("block").applyInPandas(pack, "block int, n int, ids binary, data binary")


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(n, -1)


def _pairs(queries: DataFrame, rows: DataFrame, count: int) -> DataFrame:
    """Each block of rows beside each block of queries, joined by the number of the query block."""
    asked = queries.select("block", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("data").alias("qdata"), *[c for c in queries.columns if c in ("lo", "width")])
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).join(asked, "block")


def _scores(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids and scores of one pair of blocks; a query's own row scores below everything."""
    q, x = _matrix(row.qdata, row.qn), _matrix(row.data, row.n)
    qids, ids = np.frombuffer(row.qids, "<i8"), np.frombuffer(row.ids, "<i8")
    if q.shape[1] != x.shape[1]:
        raise ValueError("vectors of different lengths")
    scores = q @ x.T
    at = np.searchsorted(ids, qids)
    own = np.flatnonzero((at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == qids))
    for i in own:
        scores[i, at[i]:np.searchsorted(ids, qids[i], "right")] = -np.inf
    return qids, ids, scores


def _histograms(pairs: DataFrame) -> DataFrame:
    """``id, bin, n``: how many scores of a query fall into each bin of its range; the top bin takes what is above."""
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                qids, _, scores = _scores(row)
                lo, width = np.frombuffer(row.lo, "<f8"), np.frombuffer(row.width, "<f8")
                bins = np.floor((scores - lo[:, None]) / width[:, None])
                flat = np.clip(bins, -1, BINS).astype(np.int64) + 1 + np.arange(len(qids))[:, None] * (BINS + 2)
                counts = np.bincount(flat.ravel(), minlength=len(qids) * (BINS + 2)).reshape(len(qids), -1)
                at, found = np.nonzero(counts[:, 1:])
                yield pd.DataFrame({"id": qids[at], "bin": found.astype(np.int32), "n": counts[at, found + 1]})

    return pairs.mapInPandas(run, "id long, bin int, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))


def _refine(counts: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """The next range of each query: the bin with its k-th score, and how many rows lie above the bin's lower edge."""
    down = Window.partitionBy("id").orderBy(F.desc("bin"))
    summed = counts.withColumn("above", F.sum("n").over(down))
    hit = summed.groupBy("id").agg(
        F.min_by("bin", F.when(F.col("above") >= k, F.col("above"))).alias("bin"),
        F.min(F.when(F.col("above") >= k, F.col("above"))).alias("reach"), F.max("above").alias("all"),
    )
    joined = state.join(hit, "id", "left")
    # with fewer than k rows above the range's lower end, the range stays
    lo = F.when(F.col("bin").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("bin") * F.col("width"))
    width = F.when(F.col("bin").isNull(), F.col("width")).otherwise(F.greatest(F.ceil(F.col("width") / BINS).cast("double"), F.lit(1.0)))
    done = F.col("bin").isNull() | (F.col("width") <= 1) | (F.col("reach") <= SLACK) | F.col("done")
    return joined.select("block", "id", lo.alias("lo"), width.alias("width"), done.alias("done"))


def _packed(state: DataFrame, queries: DataFrame) -> DataFrame:
    """The blocks of queries with their ranges packed in the order of their ids."""
    one = state.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("id", "lo", "width"))).alias("r"))

    def pack(batches):
        for pdf in batches:
            out = pdf.drop(columns=["r"])
            out["lo"] = [np.array([x["lo"] for x in r], "<f8").tobytes() for r in pdf["r"]]
            out["width"] = [np.array([x["width"] for x in r], "<f8").tobytes() for r in pdf["r"]]
            yield out

    return queries.join(one, "block").mapInPandas(pack, "block int, n int, ids binary, data binary, lo binary, width binary")


def _survivors(pairs: DataFrame, k: int) -> DataFrame:
    """``query_id, id, score`` at or above each query's edge; from one block at most the best k, ties to the smaller id."""
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                qids, ids, scores = _scores(row)
                lo = np.frombuffer(row.lo, "<f8")
                out = []
                at, found = np.nonzero((scores >= lo[:, None]) & np.isfinite(scores))
                if len(at):
                    got = scores[at, found]
                    order = np.lexsort((found, -got, at))  # columns stand in the order of the ids
                    at, found, got = at[order], found[order], got[order]
                    place = np.arange(len(at)) - np.searchsorted(at, at)
                    keep = place < k
                    out.append(pd.DataFrame({"query_id": qids[at[keep]], "vec_id": ids[found[keep]], "score": got[keep].astype(np.int64)}))
                yield from out

    return pairs.mapInPandas(run, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, key: str, vector: str, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its k best other rows by inner product."""
    vectors = settle(whole_vectors(rows, key, vector, scale), "vectors")
    asked = vectors.filter(is_query)
    bound = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, m, longest = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.max(bound)).first()
    count = max(1, -(-m // BLOCK_QUERIES))
    packed = settle(blocks(vectors, BLOCK_ROWS, n), "blocks")
    queries = settle(blocks(asked, BLOCK_QUERIES, m), "queries")
    # by Cauchy and Schwarz no score is outside plus or minus the product of the lengths
    reach = F.ceil(bound * (longest or 0.0)) + 1
    width = F.greatest(F.ceil(2 * reach / BINS).cast("double"), F.lit(1.0))
    state = asked.select(
        F.pmod(F.xxhash64("id"), F.lit(count)).cast("int").alias("block"), "id", (-reach).cast("double").alias("lo"), width.alias("width"), F.lit(False).alias("done"),
    )
    while True:
        ranged = _packed(state, queries)
        state = settle(_refine(_histograms(_pairs(ranged, packed, count)), state, k), "ranges")
        if state.filter("NOT done").isEmpty():
            break
    best = _survivors(_pairs(_packed(state, queries), packed, count), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
