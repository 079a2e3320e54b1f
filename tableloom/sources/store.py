"""Named tables as versioned parquet folders, and single-purpose file outputs.

Spark cannot overwrite a folder it is reading, so each new state is written to
a folder of its own, and a version is a pointer file that lists the folders it is made of. Readers see
either the old or the new state; an append adds a folder and lists it beside the old ones;
earlier versions stay for change feeds until ``forget`` drops them. A pointer is written under
another name and then renamed, never over an existing one: readers meet whole pointers only, and
of two runs that end at once one fails or, for an append, tries again.

A table may instead be partitioned by columns. Then runs replace single partitions in place with Spark's
dynamic partition overwrite, other partitions' files stay as they are, and no history is kept.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tableloom.spec import SpecError, choice

# Placeholders allowed in an output path.
PLACEHOLDERS = ("%Y", "%m", "%d", "%B", "%b", "%H", "%M", "%S", "%f", "%j", "%W", "%A", "%a")
OUTPUT_FORMATS = {"csv": "csv", "txt": "csv", "json": "json", "jsonl": "json", "ndjson": "json", "parquet": "parquet"}


class TableStore:
    """Resolve logical names to frames: registered frames, views, or stored versions."""

    def __init__(self, spark: SparkSession, root: str | None = None, frames: dict[str, DataFrame] | None = None):
        self.spark, self.root, self.frames = spark, root.rstrip("/") if root else None, dict(frames or {})

    def register(self, name: str, df: DataFrame) -> None:
        self.frames[name.lower()] = df

    def read(self, name: str, version: int | None = None) -> DataFrame:
        known = {k.lower(): v for k, v in self.frames.items()}
        if version is None and name.lower() in known:
            return known[name.lower()]
        at = self.version(name) if version is None else version
        if at is not None:
            pointer = self._pointer(name, at)
            if pointer is None:
                raise SpecError(f"version {at} of '{name}' is not kept")
            parts = [f"{self._folder(name)}/{p}" for p in pointer["parts"]]
            if pointer.get("by"):
                schema = StructType.fromJson(pointer["schema"])
                return self.spark.read.schema(schema).parquet(*parts).select(*[F.col(f"`{c}`") for c in schema.names])
            return self.spark.read.option("mergeSchema", len(parts) > 1).parquet(*parts)
        if self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        raise SpecError(f"table '{name}' is not known")

    def exists(self, name: str) -> bool:
        return name.lower() in {k.lower() for k in self.frames} or self.version(name) is not None

    def version(self, name: str) -> int | None:
        """Current version, the highest whole pointer; None without one."""
        if self.root is None:
            return None
        pointers = self._files(f"{self._folder(name)}/_current")
        numbers = sorted((int(p[1:]) for p in pointers if p[0] == "p" and p[1:].isdigit()), reverse=True)
        return next((n for n in numbers if self._pointer(name, n)), None)

    def write(self, name: str, df: DataFrame, batch: int | None = None, by: list[str] | None = None) -> int:
        """Write the table's next state and make it current, together with the id of the micro-batch it is from.

        ``by`` partitions the table; a null in these columns is refused.
        """
        new = (self.version(name) or 0) + 1
        part = self._part(name, df, by)
        if not self._point(name, new, [part], batch, by, df.schema if by else None):
            raise SpecError(f"another run has written version {new} of '{name}'")
        if by:
            self.forget(name)
        return new

    def partitioned_by(self, name: str) -> list[str]:
        """The columns whose partitions the table replaces in place; none for a table of versions."""
        at = self.version(name)
        return (self._pointer(name, at).get("by") or []) if at else []

    def replace_partitions(self, name: str, df: DataFrame, batch: int | None = None, emptied: list[str] | None = None) -> int:
        """Put ``df`` in the place of the partitions it has rows for, and drop the folders ``emptied``.

        Files of all other partitions are neither read nor written. ``df`` must not read the table; ``emptied`` holds
        addresses as the files' metadata give them. A run that breaks off
        is repeated with the same rows: replacing a partition twice changes nothing.
        """
        at = self.version(name)
        pointer = self._pointer(name, at)
        self._partitions(df, pointer["by"]).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
            f"{self._folder(name)}/{pointer['parts'][0]}"
        )
        for folder in emptied or []:
            fs, target = self._fs(self.spark._jvm.java.net.URI(folder))
            fs.delete(target, True)
        return self._moved_on(name, at, pointer, df, batch)

    def add_to_partitions(self, name: str, df: DataFrame, batch: int | None = None) -> int:
        """Add files to the partitions of ``df``; what is there stays."""
        at = self.version(name)
        pointer = self._pointer(name, at)
        self._partitions(df, pointer["by"]).mode("append").parquet(f"{self._folder(name)}/{pointer['parts'][0]}")
        return self._moved_on(name, at, pointer, df, batch)

    def _moved_on(self, name: str, at: int, pointer: dict, df: DataFrame, batch: int | None) -> int:
        known = StructType.fromJson(pointer["schema"])
        wider = StructType([*known, *[f for f in df.schema if f.name not in known.names]])
        if not self._point(name, at + 1, pointer["parts"], batch, pointer["by"], wider):
            raise SpecError(f"another run has written version {at + 1} of '{name}'")
        self.forget(name)
        return at + 1

    @staticmethod
    def _partitions(df: DataFrame, by: list[str]):
        """A writer with rows gathered by partition; Spark splits large partitions over several tasks."""
        for c in by:
            refuse = F.raise_error(F.lit(f"a null partition value in '{c}'")).cast("boolean")
            df = df.filter(F.when(F.col(f"`{c}`").isNull(), refuse).otherwise(F.lit(True)))
        return df.hint("rebalance", *by).write.partitionBy(*by)

    def append(self, name: str, df: DataFrame, batch: int | None = None, tries: int = 10) -> int:
        """Add a folder of rows to the table: what is there is neither read nor written."""
        if self.partitioned_by(name):
            return self.add_to_partitions(name, df, batch)
        part = self._part(name, df)
        for _ in range(tries):
            at = self.version(name)
            old = self._pointer(name, at)["parts"] if at else []
            if self._point(name, (at or 0) + 1, [*old, part], batch):
                return (at or 0) + 1
        raise SpecError(f"'{name}' changed {tries} times while rows were added")

    def batch(self, name: str) -> int | None:
        """The id of the last micro-batch that the table holds."""
        at = self.version(name)
        return self._pointer(name, at)["batch"] if at else None

    def forget(self, name: str, keep: int = 1) -> None:
        """Drop all but the newest ``keep`` versions and the folders that none of these lists."""
        at = self.version(name) or 0
        kept = {p for v in range(max(1, at - keep + 1), at + 1) for p in (self._pointer(name, v) or {"parts": []})["parts"]}
        for pointer in self._files(f"{self._folder(name)}/_current"):
            if pointer[1:].isdigit() and int(pointer[1:]) <= at - keep:
                self._delete(f"{self._folder(name)}/_current/{pointer}")
        for folder in self._files(self._folder(name)):
            if folder.startswith("part-") and folder not in kept:
                self._delete(f"{self._folder(name)}/{folder}")

    def append_rows(self, name: str, df: DataFrame) -> None:
        """Add rows to an append-only table such as a log or a quarantine."""
        self.append(name, df) if self.version(name) else self.write(name, df)

    def _part(self, name: str, df: DataFrame, by: list[str] | None = None) -> str:
        if self.root is None:
            raise SpecError("this store has no folder to write to")
        part = f"part-{uuid.uuid4().hex}"
        (self._partitions(df, by) if by else df.write).parquet(f"{self._folder(name)}/{part}")
        return part

    def _pointer(self, name: str, version: int) -> dict | None:
        """What a version is made of; None where its pointer is missing or broken."""
        fs, target = self._fs(f"{self._folder(name)}/_current/p{version}")
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _point(self, name: str, version: int, parts: list[str], batch: int | None, by: list[str] | None = None, schema: StructType | None = None) -> bool:
        """Make a version current; False when it exists already. The batch id of the version before stays if none is given."""
        before = (self._pointer(name, version - 1) or {}).get("batch") if batch is None else batch
        pointer = {"parts": parts, "batch": before} | ({"by": by, "schema": schema.jsonValue()} if by else {})
        folder = f"{self._folder(name)}/_current"
        fs, draft = self._fs(f"{folder}/_draft-{uuid.uuid4().hex}")
        _, target = self._fs(f"{folder}/p{version}")
        if fs.exists(target) and not self._pointer(name, version):
            fs.delete(target, False)  # left empty by a run that broke off
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(pointer).encode()))
        stream.close()
        try:
            # unlike FileSystem.rename on local disks, this one never replaces an existing file
            none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
            context.rename(draft, target, none)
        except Py4JJavaError as err:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(err.java_exception.getClass().getName()):
                return False
            raise
        self.frames.pop(name.lower(), None)
        return True

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _fs(self, path):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _files(self, path: str) -> list[str]:
        fs, target = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def stamp_path(path: str, now: datetime) -> str:
    """Fill date and time placeholders of an output path."""
    for mark in PLACEHOLDERS:
        path = path.replace(mark, now.strftime(mark)) if mark in path else path
    return path


def write_output(df: DataFrame, path: str, delimiter: str | None = None, now: datetime | None = None, single: bool = False) -> str:
    """Write files for other systems; the extension decides the format.

    The result is a folder of part files written in parallel. ``single`` asks
    for one file with exactly this name, written by one task and meant for reports; an
    earlier one is replaced. The file is written beside and renamed, so nobody reads half of it.
    """
    target = stamp_path(path, now) if now else path
    extension = target.rsplit(".", 1)[-1].lower() if "." in target.rsplit("/", 1)[-1] else "parquet"
    kind = OUTPUT_FORMATS[choice(extension, OUTPUT_FORMATS, "output format")]
    writer = (df.coalesce(1) if single else df).write.mode("overwrite")
    if kind == "csv":
        writer = writer.options(header=True, sep=delimiter or ("\t" if extension == "txt" else ","))
    if not single:
        writer.format(kind).save(target)
        return target
    draft = f"{target}-draft-{uuid.uuid4().hex}"
    writer.format(kind).save(draft)
    jvm = df.sparkSession._jvm
    folder, final = jvm.org.apache.hadoop.fs.Path(draft), jvm.org.apache.hadoop.fs.Path(target)
    fs = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    if fs.exists(final):
        fs.delete(final, True)
    fs.rename(part, final)
    fs.delete(folder, True)
    return target
