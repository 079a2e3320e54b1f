"""Text columns handed to batch functions on the executors, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` holds about ``limit`` bytes; a longer single text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        yield batch.slice(lo, hi - lo)


def with_columns(df: DataFrame, text: str, ddl: str, make: Callable[[], Callable[[list], Sequence]], keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the columns of ``ddl`` computed from the text column.

    ``make()`` is called once in each task and gives a function from a list of
    texts (null is given as the empty value) to one sequence per new column. ``keep`` names the columns to
    carry along (default: all). A column of ``df`` named like a new one is replaced.
    """
    schema = _parse_datatype_string(ddl)
    new = {f.name.lower() for f in schema}
    kept = [f for f in df.schema if f.name.lower() not in new and (keep is None or f.name in keep)]
    out = StructType([*kept, *schema])
    names = [f.name for f in kept]
    empty = b"" if df.schema[text].dataType.typeName() == "binary" else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, target = make(), _arrow(schema)
        for batch in batches:
            for piece in pieces(batch, text):
                values = [empty if v is None else v for v in piece.column(text).to_pylist()]
                added = [pa.array(v, type=f.type) for v, f in zip(work(values), target)]
                yield pa.RecordBatch.from_arrays([piece.column(n) for n in names] + added, names=names + target.names)

    return df.select(*dict.fromkeys([*names, text])).mapInArrow(run, out)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
