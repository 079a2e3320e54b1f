"""SentencePiece encoding and decoding through the distinct-chunk table.

Each distinct marked word is segmented by the library once for the table and its
ids are joined back by position; decoding looks the decoded form of each chunk up in
the same way. Results are those of the library on the whole text.

Defined cases: a null or empty text has no pieces, only the begin and end ids
that were asked for, and decodes to the empty text; the marker character itself
in a text counts as a blank, as in the library; ties and repeated rows give equal
results; an empty table gives an empty result. Extra columns are carried along,
and one named like a result column is replaced.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tableloom.llm.batches import with_columns
from tableloom.llm.chunks import Processor, Table, cut, frequent_chunks


def _entries(processor: Processor):
    """Chunks to (ids as 32-bit words, decoded text)."""
    def work(chunks: list[str]) -> list[tuple[bytes, str]]:
        ids = processor.ids(chunks)
        return [(array("I", x).tobytes(), t) for x, t in zip(ids, processor.texts(ids))]

    return work


def _codec(model: str, head, begin: bool, end: bool):
    """A function from texts to (ids as bytes, decoded text) of each."""
    processor = Processor(model)
    table = Table(head.value, _entries(processor))
    before = array("I", [processor.sp.bos_id()] if begin else []).tobytes()
    after = array("I", [processor.sp.eos_id()] if end else []).tobytes()

    def run(texts: list[str]):
        for found in table.look(list(map(cut, texts))):
            decoded = "".join([t for _, t in found])
            # the blank that the model put before the text goes again
            yield before + b"".join([b for b, _ in found]) + after, decoded[1:] if decoded[:1] == " " else decoded

    return run


def encode(docs: DataFrame, model: str, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``decoded string`` of each whole text."""
    head = docs.sparkSession.sparkContext.broadcast(frequent_chunks(docs, text))

    def make():
        run = _codec(model, head, begin, end)

        def work(texts):
            pairs = list(run(texts))
            return [[np.frombuffer(b, "<i4") for b, _ in pairs], [t for _, t in pairs]]

        return work

    return with_columns(docs, text, "ids array<int>, decoded string", make)


def digest(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of each whole text, with begin and end ids."""
    head = docs.sparkSession.sparkContext.broadcast(frequent_chunks(docs, text))

    def make():
        run = _codec(model, head, True, True)

        def work(texts):
            rows = [(len(b) // 4, hashlib.sha256(b).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for b, t in run(texts)]
            return list(zip(*rows)) or [[], [], []]

        return work

    return with_columns(docs, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make, [key])


def decode(docs: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded string`` of an array of ids; a null array decodes to the empty text."""
    def run(batches):
        import pyarrow as pa

        sp = Processor(model).sp
        for batch in batches:
            values = [[] if v is None else v for v in batch.column(ids).to_pylist()]
            kept = [n for n in batch.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array([sp.decode(v) for v in values], pa.string())], names=[*kept, "decoded"])

    plain = docs.drop("decoded")
    return plain.mapInArrow(run, plain.withColumn("decoded", F.lit("")).schema)
