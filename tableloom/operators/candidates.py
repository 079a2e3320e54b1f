"""Candidate pairs, complete for a similarity floor.

Sets of words: similar enough sets share some of their rarest words. It suffices to compare
items sharing so many of the first tokens in order of global frequency (prefix
filtering), and a shared token counts only where its places leave room for the overlap the floor demands (positional
filtering) and parities of the sets do not differ in too many bits. Large sets share words that stand side by side in this order
in both of them, as the words in which they differ are too few to part all those they share.

Edit distance: ``k`` edits leave one of ``k + 1`` disjoint pieces of a text unchanged (the pigeonhole
principle). The longer text of a pair names its rarest ``k + 1`` disjoint grams, and the shorter one
has to have one of them. Pieces need not cover the text, so
what everybody shares, a common beginning for instance, is no piece. One unchanged piece has exactly as many edits before it as
pieces (see ``similar_texts``), so the first and the last piece may not move at all and those between them little; the places are part of what
texts meet by. What meets is compared by signatures of its letters before and behind the piece and then at once, with a bound on
the distance, so only similar pairs are ever moved. Equal texts are compared once.

Texts meet inside tasks: a large block is dealt into parts, and a task takes a part and another one (or the same), so what is moved
are the texts, so many times as their block has parts, and never their grams.

Neither loses a pair above the floor, and the pairs of a whole group are never formed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tableloom.operators.numbering import range_count
from tableloom.session import once, settle

LOWEST_FUZZY_FLOOR = 0.5
SLACK = 1e-9
#: The longest pieces of a text, and the cells in which uses of grams are counted: their table has at most so many entries.
LONGEST, CELLS = 6, 1 << 20
#: Texts of at most so many letters meet at exact places; longer ones have too many of them.
PLACED = 64
#: Classes of letters in a signature, each with a bit for one letter and a bit for a second one.
CLASSES = 31
#: Letters and places of pieces in a part of a block: as many as make so many parts of them all, within bounds. A task holds some 40 bytes for each of two parts.
PARTS, LEAST_PART, MOST_PART = 12, 1 << 17, 5_000_000
#: Keys of shorter texts and pairs that a task looks at together, and pairs whose distance it looks at together.
KEYS, PAIRS, HELD = 1 << 20, 1 << 17, 1 << 20
#: Words of 64 bits in the parities of a set.
PARITIES = 4
#: Sets have to share one of their rarest words and as many more as this share of the smaller one, at most as many as the floor demands.
SHARE = 16
#: Sets of at least so many words meet by two words that stand side by side, and have to share one more of these for each so many words.
LARGE, PAIRED = 64, 64


def _in_tasks(floor: float) -> tuple[Callable, Callable, Callable]:
    """``tried, cells, pieces`` and what they are made of: helpers that travel into tasks by value, so that workers need not have this module."""
    tried, _, alike, _, at_places, _, chosen = _helpers(floor)

    def cells(t: str, q: int) -> list[int]:
        """The cell of each gram of ``q`` letters."""
        return at_places(alike([t]), q)[0].tolist()

    def pieces(t: str, uses: np.ndarray) -> tuple[int, list[int], list[int]]:
        """The edits a text may have, and the places (from 0) and lengths of its pieces."""
        places, sizes = chosen(alike([t]), uses)
        return tried(len(t))[0], places[0].tolist(), sizes[0].tolist()

    return tried, cells, pieces


def _helpers(floor: float) -> tuple[Callable, ...]:
    """``tried, partners, alike, hashes, at_places, groups, chosen``: texts of one length are looked at together, as a table of letters."""
    def tried(size: int) -> tuple[int, range]:
        """How many edits a pair may have whose longer text has ``size`` letters, and the lengths of pieces it tries:
        from the greatest there is room for down to half of it."""
        edits = math.floor(size * (1 - floor) + SLACK)
        most = min(size // (edits + 1), LONGEST)
        return edits, range(most, max(math.ceil(most / 2), 1) - 1, -1)

    def partners(size: int) -> list[int]:
        """The lengths of pieces that a text of ``size`` letters or a longer partner tries."""
        return sorted({q for m in range(size, math.floor(size / floor + SLACK) + 1) for q in tried(m)[1] if q <= size})

    def alike(texts: list[str]) -> np.ndarray:
        """Texts of one length as a row of letters each."""
        return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), -1)

    def hashes(codes: np.ndarray, q: int) -> np.ndarray:
        """A hash of each gram of ``q`` letters."""
        room = codes.shape[1] - q + 1
        h = np.full((len(codes), room), q, np.uint64)
        for n in range(q):
            h = (h ^ codes[:, n:n + room]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def at_places(codes: np.ndarray, q: int, placed: bool | None = None) -> np.ndarray:
        """The cell of each gram of ``q`` letters, at its place where texts are short."""
        h = hashes(codes, q)
        if codes.shape[1] <= PLACED if placed is None else placed:
            h = (h ^ np.arange(h.shape[1]).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return (h % CELLS).astype(np.int64)

    def groups(texts: list[str], letters: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """Lengths and the rows of the texts that have them, about so many letters at a time."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ranked = np.argsort(size, kind="stable")
        for rows in np.split(ranked, np.flatnonzero(np.diff(size[ranked])) + 1):
            n = int(size[rows[0]]) if len(rows) else 0
            step = max(1, letters // max(n, 1))
            for lo in range(0, len(rows) if n else 0, step):
                yield n, rows[lo:lo + step]

    def chosen(codes: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (from 0) and lengths of each text's pieces: one disjoint piece more than edits, as rare as may be.

        The pieces of short texts have lengths of their own, and one that may stand at several places counts so many times. Those of a long
        text have one length and places that differ by multiples of it. The longest pieces from the first place on
        always suffice, so every text has its pieces.
        """
        rows, size = codes.shape
        edits, lengths = tried(size)
        found = {q: uses[at_places(codes, q)] for q in lengths}
        if size > PLACED:
            places, sizes = np.zeros((rows, edits + 1), np.int32), np.zeros((rows, edits + 1), np.int32)
            for row in range(rows):
                choices = []
                for q in lengths:
                    for start in range(q):
                        use = found[q][row, start::q]
                        if len(use) > edits:
                            rarest = np.argsort(use, kind="stable")[:edits + 1]
                            choices.append((int(use[rarest].sum()), q, start + q * np.sort(rarest)))
                _, q, at = min(choices, key=lambda c: (c[0], c[1], c[2].tolist()))
                places[row], sizes[row] = at, q
            return places, sizes
        # the least uses of the first i pieces within the first so many letters, and the length of the piece that ends there
        none = 1 << 60
        least, ends = np.zeros((size + 1, rows), np.int64), []
        for i in range(edits + 1):
            weight, here, end = 2 * min(i, edits - i) + 1, np.full((size + 1, rows), none), np.zeros((size + 1, rows), np.int32)
            for upto in range(1, size + 1):
                low, length = here[upto - 1].copy(), end[upto]
                for q in lengths:
                    if q <= upto:
                        n = least[upto - q] + weight * found[q][:, upto - q] + 1
                        better = n < low
                        low[better], length[better] = n[better], q
                here[upto] = low
            least = here
            ends.append(end)
        places, sizes = np.empty((rows, edits + 1), np.int32), np.empty((rows, edits + 1), np.int32)
        upto, every = np.full(rows, size), np.arange(rows)
        for i in range(edits, -1, -1):
            while (idle := ends[i][upto, every] == 0).any():
                upto = upto - idle
            sizes[:, i] = ends[i][upto, every]
            upto = upto - sizes[:, i]
            places[:, i] = upto
        return places, sizes

    return tried, partners, alike, hashes, at_places, groups, chosen


def gram_uses(items: DataFrame, floor: float) -> np.ndarray:
    """How often the grams of each cell occur in texts ``t``. Cells are hashes, so that the array's size does not grow with the data;
    rarity only decides which pieces are looked at first, never which pairs are found."""
    _, partners, alike, _, at_places, groups, _ = _helpers(floor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, found, held = np.zeros(CELLS, np.int64), [], 0
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for n, rows in groups(texts):
                codes = alike([texts[row] for row in rows])
                for q in partners(n):
                    for placed in {n <= PLACED, n <= PLACED * floor - 1}:
                        found.append(at_places(codes, q, placed).ravel())
                        held += len(found[-1])
                if held > CELLS:
                    counts += np.bincount(np.concatenate(found), minlength=CELLS)
                    found, held = [], 0
        if held:
            counts += np.bincount(np.concatenate(found), minlength=CELLS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["cell", "n"])

    return _by_cell(items.select("t").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")))


def _by_cell(counted: DataFrame) -> np.ndarray:
    """The counts ``cell, n`` as one array of ``CELLS`` numbers."""
    rows, uses = counted.toArrow(), np.zeros(CELLS, np.int64)
    uses[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return uses


def rarest_pieces(items: DataFrame, uses: np.ndarray, floor: float) -> DataFrame:
    """``items`` with ``places`` (from 0) and ``lengths`` of the pieces, in order. No row leaves its task."""
    _, _, alike, _, _, groups, choose = _helpers(floor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for _, rows in groups(texts):
                places, lengths = choose(alike([texts[row] for row in rows]), uses)
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * places.shape[1])
                out = batch.take(pa.array(rows))
                for name, found in (("places", places), ("lengths", lengths)):
                    out = out.append_column(name, pa.ListArray.from_arrays(ends, pa.array(found.ravel())))
                yield out

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(run, f"{names}, places array<int>, lengths array<int>")


def _meeting(floor: float) -> Callable:
    """What runs over rows sorted by cell: pairs of texts that may be similar, each with the longer one first.

    A cell is all rows with one ``h, i, j``; ``side`` tells its two parts apart, and is 2 where a part meets itself. Several small
    cells are looked at together.
    """
    tried, partners, alike, hashes, _, groups, _ = _helpers(floor)
    mix = np.uint64(0xD6E8FEB86659FD93)

    def lacks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(x & ~y)

    def signatures(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the letters before and from each place on. Two bits for each class of letters: whether it occurs, and whether twice.
        An edit takes at most one bit away and adds at most one."""
        rows, n = codes.shape
        one = np.uint64(1) << (codes % CLASSES).astype(np.uint64)
        out = []
        for letters in (range(n), range(n - 1, -1, -1)):
            made, first, second = np.zeros((rows, n + 1), np.uint64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            for at in letters:
                second = second | first & one[:, at]
                first = first | one[:, at]
                made[:, at + 1 if letters.step > 0 else at] = first | second << np.uint64(CLASSES)
            out.append(made)
        return out[0], out[1]

    def few_edits(r: np.ndarray, s: np.ndarray, classes: np.ndarray, size: np.ndarray, edits: np.ndarray) -> np.ndarray:
        """Whether rows ``r`` of at most 64 letters may be so few edits from rows ``s``: the distance of their letters' classes, a column of all texts in a step by bits."""
        rows, at = np.unique(r, return_inverse=True)
        longest = int(size[rows].max(initial=1))
        word = np.uint32 if longest <= 32 else np.uint64
        bits = np.zeros((len(rows), 64), word)
        for p in range(longest):
            here = np.flatnonzero(size[rows] > p)
            bits[here, classes[rows[here], p]] |= word(1 << p)
        bits, at, letters = bits.ravel(), at * 64, classes[s]
        one, last, few = word(1), (size[r] - 1).astype(word), size[s]
        up, down, score = np.full(len(r), ~word(0)), np.zeros(len(r), word), size[r].astype(np.int32)
        least = int(few.min(initial=0))
        for p in range(int(few.max(initial=0))):
            same = bits[at + letters[:, p]]
            x = same | down
            h = (((same & up) + up) ^ up) | same
            more, less = down | ~(h | up), up & h
            step = ((more >> last) & one).astype(np.int8) - ((less >> last) & one).astype(np.int8)
            score += step if p < least else np.where(few > p, step, np.int8(0))
            more, less = (more << one) | one, less << one
            up, down = less | ~(x | more), more & x
        return score <= edits[r]

    def met(table: pa.Table) -> Iterator[pa.RecordBatch]:
        # in order of their lengths, so that the shorter one of two texts is the earlier one
        table = table.take(pa.array(np.argsort(np.fromiter(map(len, table.column("t").to_pylist()), np.int64, len(table)), kind="stable"))).combine_chunks()
        total, texts = len(table), table.column("t").to_pylist()
        size = np.fromiter(map(len, texts), np.int64, total)
        edits = np.array([tried(n)[0] for n in range(int(size.max(initial=0)) + 1)])[size]
        side = table.column("side").to_numpy()
        _, cell = np.unique(np.rec.fromarrays([table.column(c).to_numpy() for c in ("h", "i", "j")]), return_inverse=True)
        # the side on which a text's partners stand
        home, away = (np.uint64(3) * cell.astype(np.uint64) + x.astype(np.uint64) for x in (side, np.where(side < 2, 1 - side, 2)))
        low = np.uint64(total.bit_length())
        classes = np.zeros((total, PLACED), np.uint8)
        lists = {c: (table.column(c).chunk(0).values.to_numpy(), table.column(c).chunk(0).offsets.to_numpy()) for c in ("places", "lengths")}

        def keyed(h: np.ndarray, q, place, where: np.ndarray) -> np.ndarray:
            """Keys with room for a row's number."""
            out = (h ^ (np.asarray(place).astype(np.uint64) << np.uint64(8)) ^ np.asarray(q).astype(np.uint64)) * mix
            out ^= out >> np.uint64(32)
            out = (out ^ where) * mix
            return (out ^ out >> np.uint64(31)) << low

        # what the longer texts look for: piece i at its places, counted from the nearer end, with the letters before and behind it
        look: tuple[list, list] = ([], [])
        used = set()
        for n, rows in groups(texts):
            codes, k = alike([texts[row] for row in rows]), tried(n)[0]
            if n <= PLACED:
                classes[rows, :n] = codes % 64
            before, behind = signatures(codes)
            cut = lambda c: lists[c][0][lists[c][1][rows][:, None] + np.arange(k + 1)]  # noqa: B023, E731
            places, lengths = cut("places"), cut("lengths")
            h, every = np.zeros(places.shape, np.uint64), np.arange(len(rows))[:, None]
            for q in tried(n)[1]:
                known = hashes(codes, q)
                h = np.where(lengths == q, known[every, np.minimum(places, n - q)], h)
            left, right = before[every, places], behind[every, places + lengths]
            for i in range(k + 1):
                end, most = int(n <= PLACED and i > k - i), min(i, k - i)
                for move in range(-most, most + 1) if n <= PLACED else (0,):
                    at, q = places[:, i], lengths[:, i]
                    place = (n - at - q if end else at) + move + 1 if n <= PLACED else np.zeros(len(rows), np.int64)
                    here = np.flatnonzero(place >= (n <= PLACED))
                    used.update(np.unique(end << 48 | q[here].astype(np.int64) << 32 | place[here]).tolist())
                    key = keyed(h[here, i], q[here], place[here], home[rows[here]]) | rows[here].astype(np.uint64)
                    look[end].append((key, rows[here].astype(np.int32), np.full(len(here), i, np.int8), at[here].astype(np.int32), left[here, i], right[here, i]))
        index = []
        for entries in look:
            columns = [np.concatenate(c) for c in zip(*entries)]
            ranked = np.argsort(columns[0]) if entries else []
            index.append([c[ranked] for c in columns])
        look[0].clear()
        look[1].clear()

        def shown(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            both = np.sort(np.concatenate(found))
            both = both[np.append(True, both[1:] != both[:-1])]
            r, s = both // total, both % total
            near = np.ones(len(r), bool)
            short = np.flatnonzero(size[r] <= 64)
            for lo in range(0, len(short), 1 << 15):
                some = short[lo:lo + (1 << 15)]
                near[some] = few_edits(r[some], s[some], classes, size, edits)
            r, s = r[near], s[near]
            for lo in range(0, len(r), 5000):
                x, y = (table.take(pa.array(c[lo:lo + 5000])).combine_chunks() for c in (r, s))
                columns = [*(z.column(c) for z in (x, y) for c in ("id", "block", "t", "side")), pa.array(edits[r[lo:lo + 5000]].astype(np.int32))]
                columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=[*(f"{c}_{z}" for z in "rs" for c in ("id", "block", "t", "side")), "edits"])

        def beside(end: int, stands: list[tuple]) -> Iterator[np.ndarray]:
            """Pairs, as one number each, of the texts that stand where longer ones look, as far as letters and places allow them."""
            if not index[end] or not stands:
                return
            keys, owner, nth, start, left, right = index[end]
            mine, row, at, sl, sr = (np.concatenate(c) for c in zip(*stands))
            order = np.argsort(mine)
            mine, row, at, sl, sr = (c[order] for c in (mine, row, at, sl, sr))
            lo = np.searchsorted(keys, mine | row.astype(np.uint64), "right")
            count = np.searchsorted(keys, mine | np.uint64((1 << int(low)) - 1), "right") - lo
            some = np.flatnonzero(count)
            lo, count, row, at, sl, sr = (c[some] for c in (lo, count, row, at, sl, sr))
            ends, first = np.cumsum(count), 0
            while first < len(ends):
                done = int(ends[first - 1]) if first else 0
                upto = max(first + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
                many = count[first:upto]
                x = np.arange(int(ends[upto - 1]) - done) + np.repeat(lo[first:upto] - (ends[first:upto] - many - done), many)
                y = np.repeat(np.arange(first, upto), many)
                first = upto
                for theirs, ours, far in ((sl, left, 0), (sr, right, 1)) if end else ((sr, right, 1), (sl, left, 0)):
                    few = edits[owner[x]] - nth[x] if far else nth[x]
                    a, b = ours[x], theirs[y]
                    keep = np.flatnonzero(np.maximum(lacks(a, b), lacks(b, a)) <= few)
                    x, y = x[keep], y[keep]
                r, s, i = owner[x].astype(np.int64), row[y], nth[x]
                less, move, k = size[r] - size[s], at[y] - start[x], edits[r]
                keep = (less <= k) & (np.abs(move) <= i) & (np.abs(move + less) <= k - i) & (home[r] == away[s]) & (r > s)
                yield r[keep] * total + s[keep]

        found, held = [], 0
        for n, rows in groups(texts, 1 << 17):
            codes = alike([texts[row] for row in rows])
            before, behind = signatures(codes)
            stands: tuple[list, list] = ([], [])
            lengths = partners(n)
            for q in lengths:
                known = hashes(codes, q)
                for at in range(n - q + 1):
                    for end, place in ([(0, at + 1), (1, n - at - q + 1)] if n <= PLACED else []) + ([(0, 0)] if n > PLACED * floor - 1 else []):
                        if end << 48 | q << 32 | place in used:
                            stands[end].append((keyed(known[:, at], q, place, away[rows]), rows, np.full(len(rows), at), before[:, at], behind[:, at + q]))
                if q != lengths[-1] and (len(stands[0]) + len(stands[1])) * len(rows) < KEYS:
                    continue
                for end in (0, 1):
                    for pairs in beside(end, stands[end]):
                        found.append(pairs)
                        held += len(pairs)
                        if held >= HELD:
                            yield from shown(found)
                            found, held = [], 0
                stands = [], []
        if held:
            yield from shown(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, weight = [], 0
        for batch in batches:
            kept.append(batch)
            weight += pc.sum(batch.column("weight")).as_py()
            if weight < MOST_PART:
                continue
            # up to where the last cell begins
            table = pa.Table.from_batches(kept)
            keys = [table.column(c).to_numpy() for c in ("h", "i", "j")]
            begins = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in keys]))
            if len(begins):
                yield from met(table.slice(0, int(begins[-1]) + 1))
                table = table.slice(int(begins[-1]) + 1)
                kept, weight = table.to_batches(), pc.sum(table.column("weight")).as_py()
        if kept:
            yield from met(pa.Table.from_batches(kept))

    return run


def similar_texts(left: DataFrame, right: DataFrame | None, floor: float) -> DataFrame:
    """Pairs of edit similarity >= ``floor``; inputs have ``id``, ``block`` and ``t``.

    Without ``right`` the frame is compared with itself and ``id_a < id_b``. Equal texts of a block are compared once; their pairs are
    filled in at the end.

    Let a text be cut at its ``k + 1`` pieces, the letters between two of them counted to one of them, and let ``g`` be the edits before a piece less
    the number of pieces before it. ``g`` starts at 0, ends below it and falls by one at most, at an unchanged piece. Where it first
    falls below 0, piece ``i`` is unchanged, ``i`` edits lie before it and at most ``k - i`` behind it. So it lies within ``i`` places from the
    beginning and within ``k - i`` from the end of where it was, and what stands before it differs by ``i`` edits, what stands behind by ``k - i``.
    """
    def items(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        texts = once(df.filter("block IS NOT NULL AND length(t) > 0").select("id", "block", "t"), "texts")
        alike = texts.groupBy("block", "t").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        # its letters, and the places of its pieces: 1, 3, 5 up to the middle one and down again
        size = F.length("t")
        k = F.floor(size * (1 - floor) + SLACK)
        alike = alike.withColumn("weight", size.cast("long") + F.when(size <= PLACED, F.floor((k * k + 2 * k + 2) / 2)).otherwise(k + 1))
        # few bytes, much work: left alone, small texts would share a task
        return texts, settle(alike.repartition(range_count(texts), "id"), "texts")

    def members(texts: DataFrame, shown: DataFrame) -> DataFrame | None:
        """Each text's ``rep``, or None where all of them are different."""
        if shown.filter("copies > 1").isEmpty():
            return None
        return settle(texts.join(shown.select("block", "t", F.col("id").alias("rep"), "copies"), ["block", "t"]).select("id", "rep", "copies"), "members")

    def filled(pairs: DataFrame, side: str, copies: DataFrame | None) -> DataFrame:
        """``pairs`` of representatives with all members in the place of those in ``side``."""
        if copies is None:
            return pairs
        other = "id_b" if side == "id_a" else "id_a"
        return pairs.join(copies.select(F.col("rep").alias(side), F.col("id").alias("member")), side).select(F.col("member").alias(side), other)

    texts_a, a = items(left)
    texts_b, b = (texts_a, a) if right is None else items(right)
    one_table = right is None
    every = a if one_table else a.unionByName(b)
    part = min(max((every.agg(F.sum("weight")).first()[0] or 0) // PARTS, LEAST_PART), MOST_PART)

    def parted(df: DataFrame) -> DataFrame:
        """In how many parts the larger blocks are; there are few of them."""
        counted = df.groupBy("block").agg(F.sum("weight").alias("n")).filter(F.col("n") > part)
        return counted.select("block", F.ceil(F.col("n") / part).cast("int").alias("parts"))

    def dealt(df: DataFrame, other: DataFrame, sides: tuple[int, int]) -> DataFrame:
        """Each text in the cells of its part and each part it meets."""
        chosen = rarest_pieces(df.select("id", "block", "t", "weight"), gram_uses(other, floor), floor)
        mine = chosen.join(F.broadcast(parted(df)), "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        if one_table:
            mine = mine.withColumn("over", F.col("parts"))
        else:
            mine = mine.join(F.broadcast(parted(other).withColumnRenamed("parts", "over")), "block", "left").withColumn("over", F.coalesce("over", F.lit(1)))
        own = F.pmod(F.xxhash64("id", "t"), F.col("parts")).cast("int")
        met = mine.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("over") - 1)))
        if one_table:
            i, j, side = F.least("own", "met"), F.greatest("own", "met"), F.when(F.col("own") == F.col("met"), 2).otherwise((F.col("own") > F.col("met")).cast("int"))
        else:
            i, j, side = (F.col("own"), F.col("met"), F.lit(sides[0])) if sides[0] == 0 else (F.col("met"), F.col("own"), F.lit(sides[0]))
        return met.select(F.xxhash64("block").alias("h"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"), "id", "block", "t", "weight", "places", "lengths")

    cells = dealt(a, b, (0, 1)) if one_table else dealt(a, b, (0, 1)).unionByName(dealt(b, a, (1, 0)))
    kinds = {c: f"{c}_{{0}} {cells.schema[c].dataType.simpleString()}" for c in ("id", "block", "t", "side")}
    sorted_cells = cells.repartition(range_count(every), "h", "i", "j").sortWithinPartitions("h", "i", "j")
    pairs = sorted_cells.mapInArrow(_meeting(floor), ", ".join(k.format(z) for z in "rs" for k in kinds.values()) + ", edits int")
    # cells are told apart by a hash of the block
    pairs = pairs.filter(F.col("block_r") == F.col("block_s")).filter("levenshtein(t_r, t_s, edits) >= 0")
    if one_table:
        found = pairs.select(F.col("id_r").alias("id_a"), F.col("id_s").alias("id_b")).distinct()
        copies = members(texts_a, a)
        if copies is None:
            return found.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
        several = copies.filter("copies > 1")
        equal = several.alias("x").join(several.alias("y"), F.expr("x.rep = y.rep AND x.id < y.id")).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
        both = filled(filled(found, "id_a", copies), "id_b", copies)
        return both.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).unionByName(equal)
    first = F.col("side_r") == 0
    found = pairs.select(F.when(first, F.col("id_r")).otherwise(F.col("id_s")).alias("id_a"), F.when(first, F.col("id_s")).otherwise(F.col("id_r")).alias("id_b")).distinct()
    return filled(filled(found, "id_a", members(texts_a, a)), "id_b", members(texts_b, b)).select("id_a", "id_b")


def _large(floor: float) -> int | float:
    """From how many words on a set meets by neighbours: those of it that a similar set shares have to be one at least."""
    return max(LARGE, math.ceil(2 / (2 * floor - 1))) if floor > 0.5 else math.inf


def _rarest_words(sets: DataFrame, uses: np.ndarray, floor: float) -> DataFrame:
    """Rows ``id, size, paired, word, ahead`` and parities of ``id, words``, the hashes of a set: its rarest words, ``ahead`` counting a word and all behind it.

    Those of a large set are ``paired``, a word with the next one. Parities are ``PARITIES`` times 64 bits, each telling whether an odd number of words fell on it: sets differ in as many words at least as in bits.
    Words of one hash stand beside each other and are looked at together, so they only add candidates.
    """
    parities = [f"parity{n}" for n in range(PARITIES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 500):
                batch = whole.slice(lo, 500)
                words = batch.column("words")
                size = np.diff(words.offsets.to_numpy())
                hashes, row, begin = words.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
                ranked = np.lexsort((hashes, uses[hashes % CELLS], row))
                hashes_by_rank, at = hashes[ranked], np.arange(len(hashes)) - begin[row]
                least = np.ceil(size * floor - SLACK)
                first = at < (size - least + np.minimum(size // SHARE, least - 1) + 1)[row]
                first[1:] |= first[:-1] & (hashes_by_rank[1:] == hashes_by_rank[:-1]) & (row[1:] == row[:-1])
                first &= (size <= large / floor + SLACK)[row]
                # as places follow the order of words, so do pairs of neighbours: prefixes of them serve like prefixes of words
                least_paired = np.maximum(np.ceil(size * (2 * floor - 1) - 1 - SLACK), 1)
                paired = (at < (size - least_paired + np.minimum(size // PAIRED, least_paired - 1))[row]) & (size >= large)[row]
                after = np.append(hashes_by_rank[1:], 0)
                pair = (hashes_by_rank.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ after.view(np.uint64)).view(np.int64)
                bits = []
                for n in range(PARITIES):
                    bit = np.where(hashes % PARITIES == n, np.uint64(1) << (hashes // PARITIES % 64).astype(np.uint64), np.uint64(0))
                    bits.append(np.bitwise_xor.reduceat(bit, begin).view(np.int64))
                for kind, chosen, key in ((False, first, hashes_by_rank), (True, paired, pair)):
                    here = row[chosen]
                    columns = [batch.column("id").take(pa.array(here)), size[here].astype(np.int32), np.full(len(here), kind), key[chosen], (size[row] - at)[chosen].astype(np.int32), *(x[here] for x in bits)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "size", "paired", "word", "ahead", *parities])

    kind, large = sets.schema["id"].dataType.simpleString(), _large(floor)
    return sets.mapInArrow(run, f"id {kind}, size int, paired boolean, word long, ahead int, " + ", ".join(f"{c} long" for c in parities))


def similar_word_sets(left: DataFrame, right: DataFrame | None, text: str, floor: float = 0.7) -> DataFrame:
    """``id_a, id_b, similarity`` of the pairs whose sets of words have Jaccard similarity >= ``floor``.

    Words are ordered inside tasks, by the uses of their cells (see ``gram_uses``), so only each text's rarest words are shuffled. They
    carry parities of the whole set. Sets of ``n`` words that are similar enough share ``m`` words at least among their first
    ``n - ceil(n * floor) + m`` each, for any ``m`` up to their overlap; what shares ``1 + n // SHARE`` is compared by its words.

    One rare word is shared by many large sets, whose parities tell nothing, so these meet by pairs of neighbours: of ``o`` shared words ``o - 1`` pairs follow
    each other, and each of the ``d`` words in one set alone parts one of them at most. ``o - 1 - d`` is least with the smallest partner, which is
    ``floor`` times as large and has no word of its own: ``(2 * floor - 1) * n - 1`` of a set's ``n - 1`` pairs are shared. Of its first ones ``1 + n // PAIRED`` have to be.
    """
    def words(df: DataFrame) -> DataFrame:
        made = F.array_distinct(F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != ""))
        return settle(df.select("id", made.alias("tokens")).filter(F.size("tokens") > 0), "words")

    a = words(left)
    b = a if right is None else words(right)
    every = a if right is None else a.unionByName(b)
    # a hash has one of CELLS cells, so that the counts do not grow with the data; they only decide which words are looked at, never which pairs are found
    cell = F.pmod(F.xxhash64(F.col("word")), F.lit(CELLS))
    counted = every.select(F.explode("tokens").alias("word")).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    uses = _by_cell(counted)
    rarest = lambda df: _rarest_words(df.select("id", F.transform("tokens", lambda w: F.xxhash64(w)).alias("words")), uses, floor)
    ra = rarest(a)
    rb = ra if right is None else rarest(b)
    both = F.col("a.size") + F.col("b.size")
    near = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * floor - SLACK
    # all that two sets share lies before the one place or behind the other
    before = F.least(F.col("a.size") - F.col("a.ahead"), F.col("b.size") - F.col("b.ahead"))
    enough = before + F.least("a.ahead", "b.ahead") >= F.ceil(both * (floor / (1 + floor)) - SLACK)
    odd = sum((F.bit_count(F.col(f"a.parity{n}").bitwiseXOR(F.col(f"b.parity{n}"))) for n in range(1, PARITIES)), F.bit_count(F.col("a.parity0").bitwiseXOR(F.col("b.parity0"))))
    large = _large(floor)
    one_way = F.col("a.paired") | (F.least("a.size", "b.size") < F.lit(float(large)))
    match = (F.col("a.word") == F.col("b.word")) & (F.col("a.paired") == F.col("b.paired")) & one_way & near & enough & (odd <= both * ((1 - floor) / (1 + floor)) + SLACK)
    if right is None:
        match = match & (F.col("a.id") < F.col("b.id"))
    size = F.least("a.size", "b.size")
    sure = F.when(F.col("a.paired"), F.greatest(F.ceil(size * (2 * floor - 1) - 1 - SLACK), F.lit(1))).otherwise(F.ceil(size * floor - SLACK))
    more = F.least(F.floor(size / F.when(F.col("a.paired"), PAIRED).otherwise(SHARE)), sure - 1)
    met = ra.alias("a").join(rb.alias("b"), match).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), more.alias("more"))
    pairs = settle(met.groupBy("id_a", "id_b", "more").agg(F.count(F.lit(1)).alias("n")).filter("n > more").select("id_a", "id_b"), "pairs")
    # as one text, words are a fraction of the bytes that a list of them is
    side = lambda df, tag: df.select(F.col("id").alias(f"id_{tag}"), F.concat_ws(" ", "tokens").alias(f"words_{tag}"))
    full = pairs.join(side(a, "a"), "id_a").join(side(b, "b"), "id_b").select(
        "id_a", "id_b", F.split("words_a", " ").alias("ta"), F.split("words_b", " ").alias("tb")
    )
    shared = F.size(F.array_intersect("ta", "tb"))
    score = shared / (F.size("ta") + F.size("tb") - shared)
    return full.select("id_a", "id_b", score.alias("similarity")).filter(F.col("similarity") >= floor - SLACK)


def near_values(left: DataFrame, right: DataFrame | None, ceiling: float) -> DataFrame:
    """Candidates whose numbers differ by at most ``ceiling`` percent of either one, each pair once.

    Inputs have a unique ``id``, ``block`` and a number ``v``; a column ``row`` of theirs comes back as ``row_a`` and ``row_b``. Numbers are put into bands
    of ratio ``1 + ceiling / 100``; two near numbers of one sign lie in the same
    band or few bands apart. One of them stands in one band only, so a pair meets once.
    """
    share = ceiling / 100
    bands = math.ceil(-math.log1p(-share) / math.log1p(share))  # the larger number may be the base
    also = [c for c in left.columns if c == "row"]

    def banded(df: DataFrame, spread: bool) -> DataFrame:
        usable = df.select("id", "block", F.col("v").cast("double").alias("v"), *also).filter("block IS NOT NULL AND v <> 0")
        band = F.floor(F.ln(F.abs("v")) / F.lit(math.log1p(share)))
        reach = F.explode(F.sequence(band - bands, band + bands)) if spread else band
        return usable.select("id", "block", "v", *also, F.signum("v").alias("sign"), reach.alias("band"))

    a, b = banded(left, False).alias("a"), banded(left if right is None else right, True).alias("b")
    match = (F.col("a.band") == F.col("b.band")) & (F.col("a.sign") == F.col("b.sign"))
    match = match & F.col("a.block").eqNullSafe(F.col("b.block"))
    if right is None:
        match = match & (F.col("a.id") < F.col("b.id"))
    near = F.abs(F.col("a.v") - F.col("b.v")) <= F.greatest(F.abs("a.v"), F.abs("b.v")) * (share + SLACK)
    return a.join(b, match & near).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), *[F.col(f"{t}.{c}").alias(f"{c}_{t}") for c in also for t in "ab"])
