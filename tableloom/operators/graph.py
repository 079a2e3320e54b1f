"""Connected components and hierarchies as iterated joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tableloom.session import settle
from tableloom.spec import SpecError


#: Nodes up to which a hierarchy has no stops, one node in how many is one, and the types whose equal values have equal hashes.
FEW, STOPS = 2_000_000, 8
HASHED = {"tinyint", "smallint", "int", "bigint", "string", "date"}


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` with the smallest member id as component.

    Alternating star contraction: the large-star step links every larger
    neighbour of a node to the node's smallest neighbour, the small-star step
    links a node and its smaller neighbours to the smallest of them. Both need
    only the minimum of each neighbourhood, a map-side combined aggregate, and a
    join back that AQE can split, so a hub with a third of all edges is never
    gathered in one task. The number of rounds grows with the logarithm of the
    longest chain. Each round is written to the shared folder; its fingerprint
    tells when nothing changes any more.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    current = settle(_canonical(pairs), "components")
    before = None
    for _ in range(max_rounds):
        seen = Observation()
        current = settle(_small_star(_large_star(current)), "components", seen, *_digest())
        now = seen.get
        if now == before:
            break
        before = now
    else:
        raise SpecError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _canonical(pairs: DataFrame) -> DataFrame:
    """Distinct edges pointing from the larger to the smaller end; loops go."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(lows, "u").filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(down: DataFrame) -> DataFrame:
    """``down`` points from the larger to the smaller end, as the large star leaves it."""
    lows = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(lows, "u")
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lows.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _digest() -> list[Column]:
    """Order-free digest of an edge set: its size and two sums of hashes."""
    one, two = F.xxhash64("u", "v"), F.xxhash64("v", "u", F.lit(1))
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n"), total(one).alias("one"), total(two).alias("two")]


def flatten_hierarchy(nodes: DataFrame, key: str, parent: str, max_depth: int | None = None, keep_unrooted: bool = False, paths: bool = True) -> DataFrame:
    """Every node with its root, depth and path, by pointer doubling.

    A node points to an ancestor and knows the way to it. Each round puts what that ancestor points to, and the two
    ways one after the other, in the place of the pointer, so its reach doubles and a chain of 5,000 nodes takes 13
    rounds. A round is one equi-join whose looked-up side has one row for each node and parent, and is written to the shared folder.
    In a large table every eighth node, by its hash, is a stop: pointers first go to the next stop, a few
    places on, then only the stops double on, and all others take over what their stop found in one last join.
    A node with several parents has a row for each way to a root. A hierarchy deeper than ``max_depth``, if given, is an error. Nodes that no
    root reaches, on or below a cycle or a missing parent, are an error too, or with ``keep_unrooted``
    come back without root, depth and path. Paths of a deep hierarchy are long; without ``paths`` none is made.
    """
    k, p = F.col(f"`{key}`"), F.col(f"`{parent}`")
    top = p.isNull()
    state = nodes.select(
        k.alias("node"), p.alias("up"), F.when(top, k).alias("root"), F.when(top, 0).otherwise(1).alias("depth"), (k.cast("string") if paths else F.lit("")).alias("path"),
    )
    state = settle(state, "hierarchy")
    count = state.count()
    kinds = {state.schema[c].dataType.simpleString() for c in ("node", "up")}
    if count > FEW and len(kinds) == 1 and kinds <= HASHED:
        stop = lambda c: F.pmod(F.xxhash64(c), F.lit(STOPS)) == 0
        state = _doubled(state, count, paths, F.coalesce(stop("up"), F.lit(False)))
        stops = settle(_doubled(state.filter(stop("node")), count, paths), "hierarchy")
        others = state.filter(~stop("node"))
        state = settle(stops.unionByName(_moved(others.filter("up IS NOT NULL"), stops, paths)).unionByName(others.filter("up IS NULL")), "hierarchy")
    else:
        state = _doubled(state, count, paths)
    found, lost = state.filter("root IS NOT NULL").drop("up"), state.filter("root IS NULL")
    n, one, deepest = state.agg(F.count_if(F.col("root").isNull()), F.min(F.when(F.col("root").isNull(), F.col("node"))), F.max(F.when(F.col("root").isNotNull(), F.col("depth")))).first()
    if max_depth is not None and (deepest or 0) > max_depth:
        raise SpecError(f"the hierarchy is deeper than {max_depth} levels")
    if n and not keep_unrooted:
        raise SpecError(f"{n} nodes hang on no root (a cycle or a missing parent), '{one}' for one")
    if n:
        none = lambda c: F.lit(None).cast(found.schema[c].dataType).alias(c)
        found = found.unionByName(lost.select("node").distinct().join(found.select("node"), "node", "left_anti").select("node", *map(none, ("root", "depth", "path"))))
    return found if paths else found.drop("path")


def _moved(here: DataFrame, above: DataFrame, paths: bool) -> DataFrame:
    """``here`` pointing to what its pointers' rows in ``above`` point to."""
    return here.alias("h").join(above.alias("a"), F.col("h.up") == F.col("a.node"), "left").select(
        # without a row for the parent nothing leads on; the node keeps no pointer and no root
        "h.node", "a.up", "a.root", (F.col("h.depth") + F.col("a.depth")).alias("depth"),
        (F.concat("a.path", F.lit(">"), "h.path") if paths else F.lit("")).alias("path"),
    )


def _doubled(state: DataFrame, count: int, paths: bool, resting: Column | None = None) -> DataFrame:
    """Pointers doubled until none moves: all are null, ``resting`` or go round in a cycle."""
    moves = F.col("up").isNotNull() if resting is None else F.col("up").isNotNull() & ~resting
    reach = 1
    while reach < count:
        here = state.filter(moves)
        if here.isEmpty():
            break
        state, reach = settle(state.filter(~moves).unionByName(_moved(here, state, paths)), "hierarchy"), reach * 2
    return state


def iterate(df: DataFrame, step, moved: Column, max_rounds: int = 50) -> tuple[DataFrame, int]:
    """Apply ``step`` until the aggregate ``moved`` over its result is zero.

    ``step`` maps a frame to the next one; each round is written to the shared folder.
    """
    for turn in range(1, max_rounds + 1):
        df = settle(step(df), "iterate")
        if not df.agg(moved).first()[0]:
            return df, turn
    raise SpecError(f"no convergence in {max_rounds} rounds")
