"""How far the sources of a language stand apart, counted on bitmaps of terms.

Each group of documents (a language's source) gives every kept term a rounded share of its
words. Two groups with shares p and q of a term differ there by ``floor((p - q)^2 / q)``, and
by the sum of this over all kept terms as a whole. A share depends only on how often the term
occurs in the group, so terms are stored by count: a bitmap of term ids for each (group,
count). The AND of two groups' bitmaps and its number of ones say in how many terms one group
has count c and the other count d; that number times the difference of c and d is the share of
this cell in the sum. Cells with a zero have no bitmap and follow as complements.

Terms of a language are dealt into chunks of like frequency, in which a group has few
different counts, and a bitmap covers one chunk. Sources are dealt into blocks, and one task
takes one chunk of two blocks, so neither many terms nor many sources meet in one place. All
arithmetic is on whole numbers; the pairs that come out are the result itself, one row each.

Defined cases: a null text, language or source counts as the empty one; a group without kept
terms still occurs, with value 0 for its pairs where its language keeps none; one source alone
has no pairs; equal values rank by the item's bytes; repeated rows count as often as they
stand there; an empty table gives an empty result; other columns are not read. Texts are cut
at separators while they are counted, so a very long one needs no list of all its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tableloom.llm.batches import pieces
from tableloom.operators.keys import broadcast_if_small
from tableloom.session import settle

#: A kept term stands in at least so many documents; shares are counted in parts of a milliard; ranks of terms reported.
LEAST_DOCS, PARTS, TOP_TERMS = 3, 1_000_000_000, 200
#: Different (group, term) entries held by a task before they are handed on.
ENTRIES = 400_000
#: Sources in a block, and terms in a chunk by the binary logarithm of their number of occurrences.
BLOCK_SOURCES = 64
WIDTHS = ((9, 64), (6, 512), (0, 4096))
_SLICE = 1 << 20

#: Bytes of terms, with A-Z lowered; all others separate. Bytes from 0x80 belong to characters beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, at most about a slice at a time."""
    plain, at = text.translate(_TERM_BYTES), 0
    while at < len(plain):
        end = plain.find(b" ", at + _SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame, text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``groups, term, n, docs``: occurrences of each term in a group, and documents with it."""
    names = [f"g{i}" for i in range(len(groups))]
    read = docs.select(*[F.coalesce(F.col(f"`{g}`").cast("string"), F.lit("")).cast("binary").alias(a) for g, a in zip(groups, names)], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}

        def drained() -> Iterator[pa.RecordBatch]:
            for key, (often, within) in seen.items():
                terms = list(often)
                for lo in range(0, len(terms), 50_000):
                    part = terms[lo:lo + 50_000]
                    columns = [pa.array([k] * len(part), pa.binary()) for k in key]
                    numbers = [pa.array([c[t] for t in part], pa.int64()) for c in (often, within)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(part, pa.binary()), *numbers], names=[*names, "term", "n", "docs"])
            seen.clear()

        held = 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                for *key, body in zip(*[piece.column(n).to_pylist() for n in (*names, "text")]):
                    often, within = seen.setdefault(tuple(key), (Counter(), Counter()))
                    held -= len(often)
                    mine: set[bytes] = set()
                    for terms in _slices(body):
                        often.update(terms)
                        mine.update(terms)
                    within.update(mine)
                    held += len(often)
                    if held > ENTRIES:
                        yield from drained()
                        held = 0
        yield from drained()

    ddl = ", ".join(f"{n} binary" for n in names)
    counted = read.mapInArrow(run, f"{ddl}, term binary, n long, docs long").groupBy(*names, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counted.select(*[F.col(a).cast("string").alias(g) for g, a in zip(groups, names)], F.col("term").cast("string").alias("term"), "n", "docs")


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(PARTS * (n + 1) / (total + kept))``, exact for any counts."""
    up = (n + 1).cast("decimal(25,0)") * F.lit(PARTS).cast("decimal(10,0)")
    return F.call_function("div", up, (total + kept).cast("decimal(25,0)")) + 1


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; shares are at most a milliard and one, so the square is exact."""
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(counts: DataFrame) -> DataFrame:
    """``lang, term, total, chunk, pos``: terms of enough documents, dealt into chunks of like frequency."""
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("d")).filter(F.col("d") >= LEAST_DOCS)
    kept = settle(kept.select("lang", "term", "total", F.floor(F.log2("total")).cast("int").alias("level")), "terms")
    width = F.coalesce(*[F.when(F.col("level") >= least, F.lit(w)) for least, w in WIDTHS])
    # one row for each language and binary order of frequency
    sizes = kept.groupBy("lang", "level").agg(F.ceil(F.count(F.lit(1)) / F.max(width)).cast("int").alias("chunks"))
    dealt = kept.join(broadcast_if_small(sizes), ["lang", "level"])
    dealt = dealt.withColumn("chunk", F.concat_ws(".", "level", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("string")))
    place = Window.partitionBy("lang", "chunk").orderBy("term")
    return dealt.select("lang", "term", "total", "chunk", (F.row_number().over(place) - 1).alias("pos"))


def bitmaps(entries: DataFrame) -> DataFrame:
    """``lang, chunk, source, n, word, bits, p, p0, block, blocks``: the terms a group has n times, 64 in a word."""
    keys = ["lang", "chunk", "source", "n", "p", "p0", "block", "blocks"]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    return entries.groupBy(*keys, F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))


def _cells(pdf: pd.DataFrame) -> Iterator[tuple[str, str, int]]:
    """For each two groups of one chunk: what the terms that both have add, beyond what complements say of them."""
    lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
    pdf = pdf.sort_values(["source", "n"], kind="stable")
    level = ((pdf["source"] != pdf["source"].shift()) | (pdf["n"] != pdf["n"].shift())).cumsum().to_numpy() - 1
    first = np.searchsorted(level, np.arange(level[-1] + 1))
    maps = np.zeros((len(first), int(pdf["word"].max()) + 1), np.uint64)
    maps[level, pdf["word"].to_numpy()] = pdf["bits"].to_numpy().view(np.uint64)
    head = pdf.iloc[first]
    names, starts = np.unique(head["source"].to_numpy(dtype=object), return_index=True)
    order = np.argsort(starts)
    names, starts = names[order], np.sort(starts)
    p, p0, block = (head[c].to_numpy() for c in ("p", "p0", "block"))
    ends = np.append(starts[1:], len(first))
    other = lambda a, b: (a - b) ** 2 // b
    for g, (a, b) in enumerate(zip(starts, ends)):
        if block[a] != lo:
            continue
        mine, q0 = p[a:b], p0[a]
        # every other group once: the later ones of the own block, all of another block
        for h in range(len(names)) if lo != hi else range(g + 1, len(names)):
            c, d = starts[h], ends[h]
            if h == g or block[c] != hi:
                continue
            joint = np.zeros((b - a, d - c), np.int64)
            for w in range(maps.shape[1]):
                joint += np.bitwise_count(maps[a:b, w, None] & maps[None, c:d, w])
            x, y = np.nonzero(joint)
            if not len(x):
                continue
            n, u, v, r0 = joint[x, y], mine[x], p[c:d][y], p0[c]
            there = n * (other(u, v) - other(u, r0) - other(q0, v) + other(q0, r0))
            back = n * (other(v, u) - other(v, q0) - other(r0, u) + other(r0, q0))
            yield names[g], names[h], int(there.sum())
            yield names[h], names[g], int(back.sum())


def _paired(maps: DataFrame) -> DataFrame:
    """``lang, source, item, added`` summed over chunks, from one task for each chunk of two blocks of sources."""
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    both = maps.withColumn("o", others).select("*", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"))

    def run(rows: pa.Table) -> pa.Table:
        got, texts = list(_cells(rows.to_pandas())), pa.string()
        return pa.table({
            "lang": pa.array([rows["lang"][0].as_py()] * len(got), texts), "source": pa.array([g for g, _, _ in got], texts),
            "item": pa.array([h for _, h, _ in got], texts), "added": pa.array([v for _, _, v in got], pa.int64()),
        })

    made = both.groupBy("lang", "chunk", "lo", "hi").applyInArrow(run, "lang string, source string, item string, added long")
    return made.groupBy("lang", "source", "item").agg(F.sum(F.col("added").cast("decimal(38,0)")).alias("added"))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: the distance of each group to the others of its language, and its own terms."""
    counts = settle(term_counts(docs), "counts")
    kept = kept_terms(counts)
    entries = settle(counts.drop("docs").join(kept, ["lang", "term"]), "entries")
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    langs = entries.groupBy("lang").agg(F.sum("n").alias("lang_words")).join(
        entries.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang")
    sources = named.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = named.join(sources, "lang").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES).cast("int")
    groups = groups.select(
        "lang", "source", zero("words"), zero("lang_words"), zero("kept"), blocks.alias("blocks"), F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"),
    )
    p0 = F.when(F.col("kept") > 0, share(F.lit(0), F.col("words"), F.col("kept")))
    groups = settle(groups.withColumn("p0", p0), "groups")
    shared = entries.join(broadcast_if_small(groups), ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("words"), F.col("kept")), "q": share(F.col("total"), F.col("lang_words"), F.col("kept")),
    })
    return _pair_part(shared, groups).unionByName(_term_part(shared))


def _pair_part(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """All other sources of each group. Terms that only one group has, or none, come from how many terms it has at each count."""
    maps = settle(bitmaps(shared), "bitmaps")
    levels = maps.groupBy("lang", "source", "n", "p", "p0").agg(F.sum(F.bit_count("bits")).alias("terms"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("i0"))
    alone = levels.join(other, "lang").filter("source <> item")
    there = F.col("terms") * (difference(F.col("p"), F.col("i0")) - difference(F.col("p0"), F.col("i0")))
    back = F.col("terms") * (difference(F.col("i0"), F.col("p")) - difference(F.col("i0"), F.col("p0")))
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    # both directions of a pair come from one pass over the levels: what a group has is missing on the item's side, and the other way round
    alone = alone.groupBy("lang", "source", "item").agg(exact(there).alias("mine"), exact(back).alias("theirs"))
    mine = alone.select("lang", "source", "item", F.col("mine").alias("added"))
    theirs = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("theirs").alias("added"))
    extra = _paired(maps).unionByName(mine).unionByName(theirs).groupBy("lang", "source", "item").agg(F.sum("added").alias("added"))
    pairs = groups.join(other, "lang").filter("source <> item")
    none = F.when(F.col("kept") > 0, (F.col("kept") * difference(F.col("p0"), F.col("i0"))).cast("decimal(38,0)")).otherwise(F.lit(0))
    valued = pairs.join(extra, ["lang", "source", "item"], "left").withColumn("value", (none + F.coalesce("added", F.lit(0))).cast("long"))
    return _ranked(valued.withColumn("part", F.lit("pair")))


def _term_part(shared: DataFrame) -> DataFrame:
    """The terms of which a group has more than its language."""
    above = shared.filter("p > q").withColumns({"value": difference(F.col("p"), F.col("q")), "part": F.lit("term"), "item": F.col("term")})
    return _ranked(above).filter(F.col("rank") <= TOP_TERMS)


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank")
