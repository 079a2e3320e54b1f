"""Token counts by prefix dynamic programming.

For a BPE vocabulary the segmentation of every prefix ends in exactly one piece
that may follow the segmentation of what stands before it: two pieces may be
neighbours when the text of both is segmented into just these two. So one pass over
a chunk finds the last piece, and with it the exact token count, of each of its
prefixes. Counts of chunks add up along a text (see ``chunks``), which gives the exact
count at every prefix of the text: how far a budget of tokens reaches, or whether
a cut at a given place fits, is looked up without encoding anything again.

Defined cases: a null or empty text has no tokens; the prefix of length 0 counts 0;
repeated rows and ties give equal results; an empty table gives an empty result.
Extra columns are carried along; one named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.llm.batches import with_columns
from tableloom.llm.chunks import Processor, Table, cut, frequent_chunks, worked_out


class PrefixCounts:
    """The dynamic programme over chunks of one model."""

    def __init__(self, model: str):
        self.processor = Processor(model)
        sp = self.processor.sp
        plain = [p for i, p in enumerate(map(sp.id_to_piece, range(sp.get_piece_size()))) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.pieces = set(plain)
        self.longest = max(map(len, plain))
        #: beginnings of the reversed pieces, to stop early when looking back from a place
        self.ends = {p[i:] for p in plain for i in range(len(p))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.bytes = {c: self._plain(c) for c in map(chr, range(256)) if c not in self.pieces}

    def _plain(self, char: str) -> int:
        return len(self.processor.ids([char])[0])

    def may_follow(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            sp = self.processor.sp
            known = self.pairs[key] = sp.encode("\n" + left + right, out_type=str)[len(self.processor.line):] == [left, right]
        return known

    def __call__(self, chunk: str) -> list[int]:
        """Token counts of the prefixes of lengths 1 to ``len(chunk)``."""
        counts = [0]
        self._go_on(chunk, counts, [""])
        return counts[1:]

    def _go_on(self, chunk: str, counts: list[int], last: list[str]) -> None:
        """Carry the programme on, from the prefixes that ``counts`` and ``last`` know to the whole chunk."""
        ends, pieces, pairs, longest = self.ends, self.pieces, self.pairs, self.longest
        for end in range(len(counts), len(chunk) + 1):
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                tail = chunk[start:end]
                if tail not in ends:
                    start = -1
                    break
                if tail in pieces:
                    left = last[start]
                    if not left:
                        break
                    known = pairs.get((left, tail))
                    if known or known is None and self.may_follow(left, tail):
                        break
            else:
                start = -1
            if start >= 0:
                counts.append(counts[start] + 1)
                last.append(tail)
            else:
                char = chunk[end - 1]
                if char not in self.bytes:
                    self.bytes[char] = self._plain(char)
                counts.append(counts[end - 1] + self.bytes[char])
                # bytes never merge: what follows them starts afresh
                last.append("")

    def many(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """The same for many chunks, in their alphabetical order: a prefix that a chunk shares with the one before it is not worked out again."""
        out: list[tuple[int, ...]] = [()] * len(chunks)
        before, counts, last = "", [0], [""]
        for i in sorted(range(len(chunks)), key=chunks.__getitem__):
            chunk, same = chunks[i], 0
            for a, b in zip(before, chunk):
                if a != b:
                    break
                same += 1
            del counts[same + 1:], last[same + 1:]
            self._go_on(chunk, counts, last)
            out[i] = tuple(counts[1:])
            before = chunk
        return out


def prefix_counts(docs: DataFrame, model: str, text: str = "text", out: str = "prefix_counts") -> DataFrame:
    """``docs`` with the token count at each prefix of the text: entry i is for its first i code points."""
    head = docs.sparkSession.sparkContext.broadcast(frequent_chunks(docs, text))

    def make():
        dp = PrefixCounts(model)
        table = Table(head.value, dp.many)
        return lambda texts: [[_prefixes(found) for found in table.look(list(map(cut, texts)))]]

    return with_columns(docs, text, f"`{out}` array<int>", make)


def _prefixes(found: list[tuple[int, ...]]) -> list[int]:
    """Counts along the chunks of one text; the marker added before a text is no character of it."""
    out, base = [], 0
    for inner in found:
        out.extend([base + n for n in inner])
        base += inner[-1]
    return [0, *out[1:]]


def token_counts(docs: DataFrame, model: str, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the number of tokens of each whole text: the entry of its longest prefix."""
    def totals():
        dp = PrefixCounts(model)
        return lambda chunks: [inner[-1] for inner in dp.many(chunks)]

    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(worked_out(spark, frequent_chunks(docs, text), totals))

    def make():
        table = Table(head.value, totals())
        return lambda texts: [[sum(found) for found in table.look(list(map(cut, texts)))]]

    return with_columns(docs, text, f"`{out}` long", make, keep)


def fits(counts: str | Column, budget: int) -> Column:
    """The longest prefix, in code points, whose exact count is within ``budget``, from a column of prefix counts."""
    c = F.col(counts) if isinstance(counts, str) else counts
    return F.aggregate(
        c, F.struct(F.lit(-1).alias("at"), F.lit(0).alias("best")),
        lambda s, n: F.struct((s["at"] + 1).alias("at"), F.when(n <= budget, s["at"] + 1).otherwise(s["best"]).alias("best")),
        lambda s: s["best"],
    )


def count_at(counts: str | Column, length: int | Column) -> Column:
    """The exact count of the first ``length`` code points (of the whole text beyond its end)."""
    c = F.col(counts) if isinstance(counts, str) else counts
    n = F.lit(length) if isinstance(length, int) else length
    return F.get(c, F.least(n, F.size(c) - 1))
