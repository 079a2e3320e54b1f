"""File reads: formats, bad records, lineage column, incremental listings."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableloom.operators.schema import check_contract
from tableloom.spec import CORRUPT, SOURCE_PATH, SpecError, choice

# What becomes of records that do not fit the schema.
BAD_RECORDS = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "quarantine": "PERMISSIVE"}
FORMATS = {"csv": "csv", "tsv": "csv", "txt": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "xml": "xml"}
FIRST_MARK = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class FileSpec:
    """How to read a set of files."""

    extension: str
    delimiter: str | None = None
    header: bool = True
    encoding: str | None = None
    multiline: bool = False
    schema: str | None = None
    on_bad_records: str = "quarantine"
    allow_missing_columns: bool = True
    xml_xpath: str | None = None
    function: Callable | None = None
    options: dict[str, str] = field(default_factory=dict)

    @property
    def format(self) -> str:
        return FORMATS[choice(self.extension.lstrip("."), FORMATS, "file extension")]


def row_tag(xpath: str) -> str:
    """The repeating element of a simple path such as ``//catalog/book``."""
    found = re.fullmatch(r"[/.]*(?:[\w:.-]+/+)*(?:[\w.-]+:)?([\w.-]+)", xpath.strip())
    if not found:
        raise SpecError(f"xml_xpath '{xpath}' is not a plain path to a repeating element")
    return found.group(1)


def _reader(spark: SparkSession, spec: FileSpec):
    reader = spark.read.options(**spec.options)
    if spec.encoding and spec.format != "parquet":
        reader = reader.option("encoding", spec.encoding)
    if spec.format == "csv":
        sep = spec.delimiter or ("\t" if spec.extension.lstrip(".").lower() == "tsv" else ",")
        reader = reader.options(sep=sep, header=spec.header, multiLine=spec.multiline)
    elif spec.format == "json":
        reader = reader.option("multiLine", spec.multiline)
    elif spec.format == "xml":
        reader = reader.option("rowTag", row_tag(spec.xml_xpath or "/row"))
    elif spec.format == "parquet":
        reader = reader.option("mergeSchema", spec.allow_missing_columns)
    if spec.schema and spec.format != "parquet":
        mode = BAD_RECORDS[choice(spec.on_bad_records, BAD_RECORDS, "on_bad_records")]
        schema = T.StructType.fromDDL(spec.schema)
        if mode == "PERMISSIVE":
            schema = schema.add(CORRUPT, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema).option("mode", mode)
    return reader.format(spec.format)


def null_types_to_string(df: DataFrame) -> DataFrame:
    """Columns inferred without any value have no type; give them text."""
    empty = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in empty}) if empty else df


def read_files(spark: SparkSession, paths: list[str], spec: FileSpec, below: str | None = None) -> DataFrame:
    """All paths in one scan, with the file each row came from; ``below`` is the folder that holds the table.

    A function of the specification takes the place of the scan: ``function(file_paths, metadata, spark)`` gets the
    paths, which may be folders, and the specification as a dictionary, with the options that bound an incremental read.
    """
    if spec.function is not None:
        metadata = {f.name: getattr(spec, f.name) for f in fields(spec) if f.name != "function"}
        return spec.function(paths, metadata, spark)
    reader = _reader(spark, spec)
    df = null_types_to_string((reader.option("basePath", below) if below else reader).load(paths))
    if spec.schema and spec.format == "parquet":
        check_contract(df, spec.schema)
    return df.withColumn(SOURCE_PATH, F.col("_metadata.file_path"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    if any(c in path for c in "*?[{"):
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder).isDirectory()


def read_mixed_files(spark: SparkSession, paths: list[str], spec: FileSpec) -> DataFrame:
    """Files of different layouts: one scan per distinct header or schema.

    The layouts are found by reading headers and footers only, in one job for all files; files that share
    one are read together, so jobs and plan grow with layouts rather than files.
    """
    if spec.format == "csv" and spec.header:
        groups = _paths_by_csv_header(spark, paths)
    elif spec.format == "parquet":
        groups = _paths_by_footer(spark, paths)
    else:
        return read_files(spark, paths, spec)
    # columns that stand in folder names are found below the given path
    below = lambda key: key[0] if isinstance(key, tuple) else None
    frames = [read_files(spark, same, spec, below(key)) for key, same in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=spec.allow_missing_columns), frames)


def _paths_by_csv_header(spark: SparkSession, paths: list[str]) -> dict[tuple, list[str]]:
    """Files, those in subfolders too, by the folder given for them and first line: one Spark job reads each file's first block."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    first = lines.filter("_metadata.file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    heads = first.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min_by("value", "at").alias("head"))
    return _grouped(_folders(spark, paths), heads.orderBy("path").collect())


def _folders(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The given paths that are folders, by the address their files' paths begin with."""
    folders = {}
    for given in filter(lambda p: _is_folder(spark, p), paths):
        path = spark._jvm.org.apache.hadoop.fs.Path(given)
        folders[path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath().rstrip("/") + "/"] = given
    return folders


def _grouped(folders: dict[str, str], heads: list) -> dict[tuple, list[str]]:
    """Files (rows ``path, head``) by the folder given for them, their head and the columns in their folders' names."""
    groups: dict[tuple, list[str]] = {}
    for row in heads:
        below = max((f for f in folders if f in row.path), key=len, default=None)
        # files under different folder columns are different layouts, even with one header
        inner = row.path.split(below, 1)[1].split("/")[:-1] if below else []
        columns = tuple(part.split("=")[0] for part in inner if "=" in part)
        groups.setdefault((folders[below] if columns else None, row.head, columns), []).append(row.path)
    return groups


def _footer_reader(content: bool):
    """A function for tasks that gives each file's schema from its footer; null where Arrow cannot open the address.

    With ``content`` the file's bytes come with the row, for stores that only Spark's readers reach.
    """
    def run(batches):
        import io
        from urllib.parse import unquote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            heads = []
            for at, path in enumerate(batch.column(0).to_pylist()):
                try:
                    if content:
                        heads.append(pq.read_schema(io.BytesIO(batch.column(1)[at].as_py())))
                        continue
                    local = path[5:] if path.startswith("file:/") else None
                    place, inner = (fs.LocalFileSystem(), "/" + local.lstrip("/")) if local else fs.FileSystem.from_uri(unquote(path))
                    heads.append(pq.read_schema(inner, filesystem=place))
                except (OSError, ValueError, pa.ArrowException):
                    heads.append(None)
            said = pa.array([None if h is None else h.remove_metadata().to_string() for h in heads], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), said], names=["path", "head"])

    return run


def _paths_by_footer(spark: SparkSession, paths: list[str]) -> dict[tuple, list[str]]:
    """Parquet files by folder and schema: tasks read the footers, one job for all files.

    Files that Arrow cannot open where they lie are read whole by Spark, in one more job.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    heads = listed.select("path").mapInArrow(_footer_reader(False), "path string, head string").collect()
    unread = [r.path for r in heads if r.head is None]
    if unread:
        whole = spark.read.format("binaryFile").load(unread).select("path", "content")
        late = whole.mapInArrow(_footer_reader(True), "path string, head string").collect()
        if broken := [r.path for r in late if r.head is None]:
            raise SpecError(f"no parquet file: {broken[0]}")
        heads = [r for r in heads if r.head is not None] + late
    return _grouped(_folders(spark, paths), sorted(heads))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path and modification time of the files below ``path``; contents are not read.

    A path that does not exist has no files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "modificationTime")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, modificationTime timestamp")


def read_changed_files(
    spark: SparkSession, path: str, spec: FileSpec, mark: str = FIRST_MARK, pattern: str | None = None
) -> tuple[DataFrame | None, str]:
    """Files modified after ``mark``; returns their rows and the new mark.

    The listing is reduced to its latest modification time, which becomes the
    new mark. The scan selects files between the two marks itself, so no list
    of paths passes through the driver, and a file that arrives meanwhile waits
    for the next run.
    """
    new = list_files(spark, path, pattern).filter(F.col("modificationTime") > F.lit(mark).cast("timestamp"))
    latest = new.agg(
        F.max("modificationTime").cast("string").alias("mark"),
        (F.max("modificationTime") + F.expr("interval 1 millisecond")).cast("string").alias("before"),
    ).first()
    if latest["mark"] is None:
        return None, mark
    window = {"modifiedAfter": mark, "modifiedBefore": latest["before"], "recursiveFileLookup": "true"}
    window = {k: v.replace(" ", "T") for k, v in window.items()}
    if pattern:
        window["pathGlobFilter"] = pattern
    return read_files(spark, [path], replace(spec, options={**spec.options, **window})), latest["mark"]


def read_new_folders(
    spark: SparkSession, base: str, spec: FileSpec, mark: str = "-1"
) -> tuple[DataFrame | None, str]:
    """Staging folders named by time stamp and later than ``mark``; archives are skipped."""
    listed = list_files(spark, base, f"*.{spec.extension.lstrip('.')}")
    parts = F.split("path", "/")
    named = listed.withColumn("folder", F.element_at(parts, -2)).filter(
        F.col("folder").rlike("^[0-9]+$") & ~F.col("path").contains("/Archived_")
    )
    later = named.filter(F.col("folder").cast("decimal(38,0)") > F.lit(mark).cast("decimal(38,0)"))
    found = sorted((r["folder"] for r in later.select("folder").distinct().collect()), key=int)
    if not found:
        return None, mark
    return read_files(spark, [f"{base.rstrip('/')}/{f}" for f in found], spec), found[-1]


def stage(
    spark: SparkSession, function: Callable[[dict, SparkSession], dict], base: str, at: datetime, metadata: dict | None = None
) -> dict:
    """Let a custom function land files in a new time-stamped folder below ``base``.

    The function gets the folder as ``staging_folder``, must write its files
    directly into it, and returns ``rows_copied`` and ``next_watermark_value``.
    A retry at the same time overwrites the folder; ``read_new_folders`` picks it up.
    """
    folder = f"{base.rstrip('/')}/{at:%Y%m%d%H%M%S}"
    made = function({**(metadata or {}), "staging_folder": folder}, spark)
    if missing := {"rows_copied", "next_watermark_value"} - set(made or {}):
        raise SpecError(f"the staging function did not return {', '.join(sorted(missing))}")
    nested = list_files(spark, folder).filter(F.element_at(F.split("path", "/"), -2) != folder.rsplit("/", 1)[-1])
    if int(made["rows_copied"]) > 0 and not nested.isEmpty():
        raise SpecError("staged files must lie directly in the staging folder")
    return {**made, "staging_folder": folder}


def csv_to_parquet(spark: SparkSession, paths: list[str], spec: FileSpec, out: str) -> DataFrame:
    """Rewrite staged text files as parquet and read that instead; the text stays."""
    read_files(spark, paths, spec).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
