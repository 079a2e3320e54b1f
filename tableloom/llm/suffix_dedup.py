"""Removing repeated byte strings by external suffix sorting of shards.

A byte is removed when a string of ``LENGTH`` bytes over it also starts anywhere else.
Equal strings have equal k-grams, so the leftmost k-gram of smallest hash in a string,
its anchor, is the same wherever the string occurs. Each text falls into stretches of
strings with one anchor; strings of different anchors cannot be equal. Anchors that
occur once are done with; where all stretches of an anchor are alike, all of them repeat.
Only the other stretches are compared: each different one once, sent to the shard of its
anchor and sorted there with all its suffixes (see ``induced``), whose
neighbours with a common prefix of ``LENGTH`` are the repeated strings. The number of
shards follows from the bytes to be sorted, so that a shard fits into a task's memory.

An anchor with very many different stretches, such as the edge of a passage that a third
of all documents share, is not put into one shard. Equal strings have their anchor at the same
offset, so its stretches are cut into cells of neighbouring offsets, whose strings share a core of nearly ``LENGTH``
bytes. Cells whose core occurs once are done with, those that are all alike repeat, few different ones go to a
shard, and the others are cut again. What is left after the narrowest cells, a few strings of each, is counted
string by string by 128-bit hashes, summed in each task before they are spread over all tasks.

Defined cases: a null text is an empty one; texts shorter than ``LENGTH`` lose nothing;
repeated rows are texts that repeat each other; overlapping repetitions count;
an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tableloom.llm.batches import pieces
from tableloom.llm.induced import Shard
from tableloom.llm.shingles import mix
from tableloom.session import settle

LENGTH, GRAM = 200, 32
#: Stretches of one anchor that may meet in one shard.
COMMON = 128
#: Offsets of the anchor in a cell, for each time that the stretches of a common anchor are cut.
CELLS = (43, 11, 3)
#: Bytes of the cells of one core that may meet in one shard, an eighth of what a shard holds on average.
CELL_BYTES = 1 << 20
#: Bytes of stretches that a shard holds on average; its sort needs some 50 bytes of memory for each of them.
SHARD_BYTES = 8 << 20
_SLICE = 1 << 20
_BASE, _OTHER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


class Anchors:
    """Anchors of the strings of a text, and hashes of its parts."""

    def __init__(self):
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.full(_SLICE + LENGTH + 1, _BASE))
            self.back = np.multiply.accumulate(np.full(_SLICE + LENGTH + 1, np.uint64(pow(int(_BASE), -1, 1 << 64))))

    def __call__(self, raw: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """``(key, first, last, mark)``: for each stretch its anchor's hash, its first and last string and its own hash."""
        whole = np.frombuffer(raw, np.uint8)
        for at in range(0, len(whole) - LENGTH + 1, _SLICE):
            b = whole[at:at + _SLICE + LENGTH - 1]
            with np.errstate(over="ignore"):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:len(b)])))
                n = len(b) - GRAM + 1
                grams = mix((sums[GRAM:] - sums[:n]) * self.back[:n])
                place = _smallest(grams, LENGTH - GRAM + 1)
                first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                last = np.append(first[1:], len(place)) - 1
                mark = mix((sums[last + LENGTH] - sums[first]) * self.back[first] + (last - first).astype(np.uint64))
            yield grams[place[first]].view(np.int64), first + at, last + at, mark.view(np.int64)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost smallest value of each window stands: minima from both ends of blocks as wide as the window."""
    low = np.uint64((1 << 21) - 1)
    marked = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    padded = np.full(-(-len(marked) // width) * width, ~np.uint64(0))
    padded[:len(marked)] = marked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return (np.minimum(behind[:count], ahead[width - 1:width - 1 + count]) & low).astype(np.int64)


def _anchors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors()
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = [(r, part) for r, text in zip(piece.column("row").to_pylist(), piece.column("text").to_pylist()) if text for part in find(text.encode())]
                if found:
                    columns = [np.concatenate(c) for c in zip(*(part for _, part in found))]
                    row = np.repeat([r for r, _ in found], [len(part[0]) for _, part in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0]), pa.array(row), pa.array(columns[1].astype(np.int32)), pa.array(columns[2].astype(np.int32)), pa.array(columns[3])],
                        names=["key", "row", "first", "last", "mark"],
                    )

    return rows.mapInArrow(run, "key long, row long, first int, last int, mark long")


def _stretches(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, mark, common, body``: the bytes of the wanted stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                out = []
                for text, parts in zip(piece.column("text").to_pylist(), piece.column("parts").to_pylist()):
                    raw = text.encode()
                    out += [(p["key"], p["mark"], p["common"], raw[p["first"]:p["last"] + LENGTH]) for p in parts]
                key, mark, common, body = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(mark, pa.int64()), pa.array(common, pa.bool_()), pa.array(body, pa.binary())], names=["key", "mark", "common", "body"])

    by_row = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "mark", "common", "first", "last")).alias("parts"))
    both = rows.join(by_row.hint("shuffle_hash"), "row").select("text", "parts")
    return both.mapInArrow(run, "key long, mark long, common boolean, body binary")


def _runs(marks: np.ndarray, base: int) -> list[dict]:
    """Runs of marked positions as first and last, counted from ``base``."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return [{"a": base + int(a), "b": base + int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


_RUNS = "key long, mark long, runs array<struct<a:int,b:int>>"


def _shards(stretches: DataFrame, least: int) -> int:
    """So many shards that each stays at ``SHARD_BYTES``, whatever the input; an anchor has ``COMMON`` stretches of under 400 bytes at most."""
    size = stretches.agg(F.coalesce(F.sum(F.octet_length("body") + F.lit(1)), F.lit(0))).first()[0]
    return max(least, -(-size // SHARD_BYTES))


def _sorted_shards(stretches: DataFrame, shards: int) -> DataFrame:
    """Runs of repeated strings in each stretch, one suffix sort in each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, marks, bases, sizes = [], [], [], []

        def spooled() -> Iterator[bytes]:
            for batch in batches:
                keys.append(batch.column("key").to_numpy())
                marks.append(batch.column("mark").to_numpy())
                bases.append(batch.column("base").to_numpy())
                for body in batch.column("body"):
                    raw = body.as_py()
                    sizes.append(len(raw))
                    yield raw

        shard = Shard(spooled(), LENGTH)
        if not sizes:
            return
        found = shard.repeated(LENGTH)
        ends = np.cumsum(np.array(sizes) + 1)
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        key, mark, base = np.concatenate(keys), np.concatenate(marks), np.concatenate(bases).tolist()
        for lo in range(0, len(sizes), 5000):
            runs = [_runs(found[ends[i] - sizes[i] - 1:ends[i] - 1], base[i]) for i in range(lo, min(lo + 5000, len(sizes)))]
            yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + 5000]), pa.array(mark[lo:lo + 5000]), pa.array(runs, kind)], names=["key", "mark", "runs"])

    return stretches.select("deal", "key", "mark", "base", "body").repartition(shards, "deal").mapInArrow(run, _RUNS)


class Hashes:
    """128-bit hashes of parts of a slice of bytes, of which the first half is that of ``Anchors``."""

    def __init__(self):
        find = Anchors()
        with np.errstate(over="ignore"):
            other = np.multiply.accumulate(np.full(_SLICE + LENGTH + 1, _OTHER))
            back = np.multiply.accumulate(np.full(_SLICE + LENGTH + 1, np.uint64(pow(int(_OTHER), -1, 1 << 64))))
        self.powers = ((find.power, find.back), (other, back))

    def over(self, raw: bytes):
        """A function from where parts of ``raw`` start and end to the two halves of their hashes."""
        b = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            sums = [(np.concatenate((np.zeros(1, np.uint64), np.cumsum(b * power[:len(b)]))), back) for power, back in self.powers]

        def parts(start: np.ndarray, end: np.ndarray, halves: int = 2) -> list[np.ndarray]:
            with np.errstate(over="ignore"):
                return [mix((s[end] - s[start]) * back[start]) for s, back in sums[:halves]]

        return parts


_CELLS = "h long, g long, own_h long, own_g long, key long, mark long, base int, body binary"


def _cells(stretches: DataFrame, width: int) -> DataFrame:
    """The stretches cut into cells of ``width`` offsets of the anchor: the hash of what all strings of a cell share, the hash of
    the stretch's own strings in it, and their bytes, ``base`` strings behind the stretch's first."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, low, span = Hashes(), np.uint64((1 << 21) - 1), np.arange(LENGTH - GRAM + 1)
        for batch in batches:
            for piece in pieces(batch, "body", _SLICE // 8):
                bodies = [x.as_py() for x in piece.column("body")]
                raw = b"".join(bodies)
                size = np.array([len(x) for x in bodies])
                begin = np.cumsum(size) - size
                parts = hashes.over(raw)
                window = begin[:, None] + span
                grams, = parts(window, window + GRAM, 1)
                # the offset of the anchor in the first and in the last string of each stretch
                most = (((grams & ~low) | span.astype(np.uint64)).min(axis=1) & low).astype(np.int64)
                least = most - (size - LENGTH)
                count = most // width - least // width + 1
                row = np.repeat(np.arange(len(size)), count)
                cell = (least // width)[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                lo, hi = cell * width, np.minimum(cell * width + width - 1, LENGTH - GRAM)
                place, a, b = (begin + most)[row], np.maximum(lo, least[row]), np.minimum(hi, most[row])
                start, end = place - b, place - a + LENGTH
                found = [x.view(np.int64) for x in (*parts(place - lo, place - hi + LENGTH), *parts(start, end))]
                kept = [piece.column(c).to_numpy()[row] for c in ("key", "mark")]
                base = (piece.column("base").to_numpy()[row] + most[row] - b).astype(np.int32)
                body = [raw[x:y] for x, y in zip(start.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*found, *kept, base)] + [pa.array(body, pa.binary())], names=["h", "g", "own_h", "own_g", "key", "mark", "base", "body"])

    return stretches.select("key", "mark", "base", "body").mapInArrow(cells, _CELLS)


_PLACED = ("deal", "key", "mark", "base", "body")


def _cut_common(stretches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the stretches of common anchors the parts to be sorted in shards, and ``key, mark, runs`` of all others."""
    few, runs, left = [], [], stretches
    for width in CELLS:
        # so many cells, of at most so many bytes each
        most = max(1, CELL_BYTES // (LENGTH + width))
        cells = settle(_cells(left, width), "cells")
        cores = cells.groupBy("h", "g").agg(
            F.count(F.lit(1)).alias("n"), (F.min("own_h") == F.max("own_h")).alias("same_h"), (F.min("own_g") == F.max("own_g")).alias("same_g")
        )
        cores = cores.filter("n > 1").select("h", "g", F.col("n").alias("cells"), (F.col("same_h") & F.col("same_g")).alias("alike"))
        # written, so that the join knows its size
        shared = settle(cells.join(settle(cores, "cores"), ["h", "g"]).withColumnRenamed("h", "deal"), "shared")
        whole = F.array(F.struct(F.col("base").alias("a"), (F.col("base") + F.octet_length("body") - LENGTH).cast("int").alias("b")))
        runs.append(shared.filter("alike").select("key", "mark", whole.alias("runs")))
        few.append(shared.filter(f"NOT alike AND cells <= {most}").select(*_PLACED))
        left = shared.filter(f"NOT alike AND cells > {most}").select(*_PLACED)
    runs.append(_counted_strings(left))
    return reduce(DataFrame.unionByName, few), reduce(DataFrame.unionByName, runs)


_STRINGS = "h long, g long, key long, mark long, at int"


def _counted_strings(stretches: DataFrame) -> DataFrame:
    """The same for stretches, or for parts of them that start at ``base``, by counting each string's hash.

    Counts are summed in each task before they are shuffled, and only the hashes of the repeated strings are joined back, so
    that a string of very many stretches is one row a task when it is counted, and a skewed key that AQE splits when joined.
    """
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for piece in pieces(batch, "body", _SLICE // 8):
                bodies = [x.as_py() for x in piece.column("body")]
                count = np.array([len(x) - LENGTH + 1 for x in bodies])
                begin = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(begin, count) + at
                found = [x.view(np.int64) for x in hashes.over(b"".join(bodies))(start, start + LENGTH)]
                key, mark, base = (np.repeat(piece.column(c).to_numpy(), count) for c in ("key", "mark", "base"))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*found, key, mark, (at + base).astype(np.int32))], names=["h", "g", "key", "mark", "at"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            found = []
            for places in batch.column("places"):
                at = np.sort(places.values.to_numpy())
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
                found.append([{"a": a, "b": b} for a, b in zip(at[first].tolist(), at[np.append(first[1:], len(at)) - 1].tolist())])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("mark"), pa.array(found, kind)], names=["key", "mark", "runs"])

    base = F.col("base") if "base" in stretches.columns else F.lit(0)
    every = stretches.select("key", "mark", base.alias("base"), "body").mapInArrow(strings, _STRINGS)
    twice = every.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "g")
    # written, so that the join knows its size; a stretch has fewer than LENGTH strings, so its places are few
    again = every.join(settle(twice, "twice"), ["h", "g"])
    return again.groupBy("key", "mark").agg(F.collect_list("at").alias("places")).mapInArrow(runs, _RUNS)


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """``row, first, last``: the first and last string of each run of repeated strings in the rows ``row, text``."""
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _anchors(rows).repartition(width, "key")
    shared = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.min("mark") == F.max("mark")).alias("alike")).filter("n > 1")
    again = settle(found.join(shared.select("key", "alike"), "key"), "anchors")
    different = again.filter("NOT alike").groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last")).alias("one"))
    different = settle(different.select("key", "mark", "n", "one.*"), "stretches")
    sizes = different.groupBy("key").agg(F.count(F.lit(1)).alias("stretches"))
    wanted = different.join(sizes, "key").withColumn("common", F.col("stretches") > COMMON)
    bodies = settle(_stretches(rows, wanted), "bodies")
    placed = bodies.select(F.col("key").alias("deal"), "key", "mark", F.lit(0).alias("base"), "body", "common")
    few, settled = _cut_common(placed.filter("common"))
    rare = placed.filter("NOT common").select(*_PLACED).unionByName(few)
    # one row a stretch, however many parts of it were found
    settled = settled.groupBy("key", "mark").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    runs = _sorted_shards(rare, _shards(rare, 4 * width)).unionByName(settled)
    # a stretch that occurs twice repeats as a whole
    twice = different.filter("n > 1").select("key", "mark", F.array(F.struct(F.lit(0).alias("a"), (F.col("last") - F.col("first")).alias("b"))).alias("runs"))
    part = again.filter("NOT alike").join(runs.unionByName(twice), ["key", "mark"]).select("row", "first", F.explode("runs").alias("r"))
    return again.filter("alike").select("row", "first", "last").unionByName(part.select("row", (F.col("first") + F.col("r.a")).alias("first"), (F.col("first") + F.col("r.b")).alias("last")))


def _cut(raw: bytes, ranges: list | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    if not ranges:
        return raw, 0
    gone = np.zeros(len(raw) + 1, np.int64)
    for r in ranges:
        gone[r["first"]] += 1
        gone[r["last"] + LENGTH] -= 1
    left = np.cumsum(gone[:-1]) == 0
    return np.frombuffer(raw, np.uint8)[left].tobytes(), int((np.diff(np.concatenate(([True], left)).astype(np.int8)) < 0).sum())


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and with ``keep_bytes`` what is left as ``kept``."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("_key"), F.col(text).alias("text"))
    ranges = repeated_ranges(numbered.select("row", "text"))
    by_row = ranges.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    both = numbered.join(by_row.hint("shuffle_hash"), "row", "left").select(F.col("_key").alias(key), "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                out = []
                for value, parts in zip(piece.column("text").to_pylist(), piece.column("ranges").to_pylist()):
                    raw = (value or "").encode()
                    kept, spans = _cut(raw, parts)
                    out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                n, removed, spans, digest, kept = zip(*out)
                arrays = [piece.column(key), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
                names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_bytes:
                    arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[key].dataType.simpleString()
    return both.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)
