"""The distinct-chunk table: texts cut where no piece of a SentencePiece model can reach across.

In a BPE model a merge joins two neighbouring symbols into a piece of the
vocabulary. Where no piece has a white-space marker behind another character, no
merge crosses the place before a marker, and none touches a character that is in
no longer piece, such as a line end. Between those places a text falls into
chunks (a run of markers and the word behind it), and the segmentation of a
chunk does not depend on what stands around it.

All chunks of all texts are counted. The most frequent ones, up to a fixed
number of entries of bounded length, make a table whose every chunk is worked
out once; the table, at most ``TABLE_ENTRIES * (CHUNK_BYTES + ids)`` bytes, is broadcast and joined
back by position. The long tail, most of which occurs a single time, is worked
out once per piece of a task. So neither texts nor positions are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableloom.llm.batches import pieces
from tableloom.session import settle

MARK = "▁"
#: Entries of the broadcast table and the longest chunk it may hold, in bytes: at most some tens of megabytes.
TABLE_ENTRIES, CHUNK_BYTES = 200_000, 48
#: The tail a task remembers is dropped when it reaches this many chunks.
TAIL_ENTRIES = 400_000
_SEP = "\x1e"


def cut(text: str) -> list[str]:
    """The chunks of one text, with the marker that the model puts before a text; none for an empty text."""
    if not text:
        return []
    if _SEP in text:
        parts = text.split(_SEP)
        # the separator itself is no part of any longer piece, hence a chunk
        out = cut(parts[0]) if parts[0] else [MARK]
        for part in parts[1:]:
            out.append(_SEP)
            out.extend(_cut(part.replace(" ", MARK)))
        return out
    return _cut(MARK + text.replace(" ", MARK))


def _cut(marked: str) -> list[str]:
    if not marked:
        return []
    spread = marked.replace(MARK, _SEP + MARK)
    if MARK + _SEP + MARK in spread:
        spread = spread.replace(MARK + _SEP, MARK)
    if "\n" in spread:
        spread = spread.replace("\n", _SEP + "\n" + _SEP)
    return [c for c in spread.split(_SEP) if c]


class Processor:
    """A SentencePiece model checked for the property that the cuts rely on."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        inside = [p for p in map(self.sp.id_to_piece, range(self.sp.get_piece_size())) if len(p) > 1]
        if any(MARK in p.lstrip(MARK) or "\n" in p or _SEP in p for p in inside):
            raise ValueError("pieces of this model reach across white-space markers")
        self.line = self.sp.encode("\n")

    def ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks as they stand inside a text; a line end before each keeps the model's own marker apart."""
        skip = len(self.line)
        return [ids[skip:] for ids in self.sp.encode(["\n" + c for c in chunks], num_threads=1)]

    def texts(self, ids: list[list[int]]) -> list[str]:
        """What the ids of chunks decode to inside a text."""
        return [t[1:] for t in self.sp.decode([self.line[-1:] + x for x in ids], num_threads=1)]


def count_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(chunk, n)`` for every distinct chunk of all texts."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 16 << 20):
                found: Counter[str] = Counter()
                for value in piece.column(0).to_pylist():
                    if value:
                        found.update(cut(value))
                names, sizes = list(found), list(found.values())
                for lo in range(0, len(names), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(names[lo:lo + 50_000], pa.string()), pa.array(sizes[lo:lo + 50_000], pa.int64())], names=["chunk", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "chunk string, n long")
    return counted.groupBy("chunk").agg(F.sum("n").alias("n"))


def _most(sizes: DataFrame, room: int, ascending: bool) -> tuple[int | None, int]:
    """Of ``(part, n)`` the parts in order as long as their sum is within ``room``: the first that is left out, and the room before it."""
    for part, n in sorted(map(tuple, sizes.collect()), reverse=not ascending):
        if n > room:
            return part, room
        room -= n
    return None, room


def frequent_chunks(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """The most frequent chunks that occur more than once, bounded in number and length.

    Only sizes of a thousand classes of like frequency, and of the parts of the class at the border, are sent to the driver to find the border,
    then the chunks themselves; a sort would send as many from every partition.
    """
    level, part = F.floor(F.log2("n") * 16), F.pmod(F.xxhash64("chunk"), F.lit(1024))
    short = settle(count_chunks(docs, text).filter(f"octet_length(chunk) <= {CHUNK_BYTES} AND n > 1"), "chunks")
    border, room = _most(short.groupBy(level).count(), entries, False)
    if border is not None:
        last, _ = _most(short.filter(level == border).groupBy(part).count(), room, True)
        inside = F.lit(True) if last is None else part < last
        short = short.filter((level > border) | ((level == border) & inside))
    return short.select("chunk").toArrow().column(0).to_pylist()


def worked_out(spark: SparkSession, head: list[str], make: Callable[[], Callable[[list[str]], list[int]]]) -> dict[str, int]:
    """The number that the function of ``make()`` gives for each chunk of ``head``, worked out once for all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(work(batch.column(0).to_pylist()), pa.int64())], names=["chunk", "n"])

    if not head:
        return {}
    rows = spark.createDataFrame(pa.table({"chunk": pa.array(head, pa.string())}))
    dealt = rows.repartition(max(1, min(spark.sparkContext.defaultParallelism, len(head) // 1000)))
    done = dealt.mapInArrow(run, "chunk string, n long").toArrow()
    return dict(zip(done.column(0).to_pylist(), done.column(1).to_pylist()))


class Table:
    """Chunks to what ``work`` gives for them: a fixed head, which may have been worked out before, and a tail of bounded size."""

    def __init__(self, head: list[str] | dict[str, int], work: Callable[[list[str]], list]):
        self.head = head if isinstance(head, dict) else dict(zip(head, work(head))) if head else {}
        self.known, self.work = dict(self.head), work

    def look(self, texts: list[list[str]]) -> Iterator[list]:
        """The entries of the chunks of each text, in their order; what is missing in all is worked out in one go."""
        if len(self.known) > len(self.head) + TAIL_ENTRIES:
            self.known = dict(self.head)
        known = self.known
        if missing := [c for c in set().union(*texts) if c not in known]:
            known.update(zip(missing, self.work(missing)))
        for chunks in texts:
            yield list(map(known.__getitem__, chunks))
