"""Incremental file ingest as Structured Streaming micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tableloom.sources.files import FileSpec
from tableloom.spec import CORRUPT, SOURCE_PATH, SpecError


def stream_files(spark: SparkSession, path: str, spec: FileSpec, files_per_batch: int | None = None) -> DataFrame:
    """New files below ``path`` as a stream; the checkpoint remembers which were read."""
    if not spec.schema:
        raise SpecError("a stream needs a fixed schema")
    schema = T.StructType.fromDDL(spec.schema)
    reader = spark.readStream.format(spec.format).options(**spec.options)
    if spec.format == "csv":
        reader = reader.options(header=spec.header, sep=spec.delimiter or ",", multiLine=spec.multiline)
    if spec.format != "parquet" and spec.on_bad_records == "quarantine":
        schema = schema.add(CORRUPT, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(schema).load(path).withColumn(SOURCE_PATH, F.col("_metadata.file_path"))


def ingest_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process everything available, then stop.

    A micro-batch may be replayed after a failure, so ``handle`` gets the batch
    id to make its write repeatable; ``write_batch`` does that for folders.
    """
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(folder: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to its own subfolder; a replay overwrites it."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    return handle
