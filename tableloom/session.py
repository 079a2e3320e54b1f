"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_spark(app: str = "tableloom", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session with the engine's SQL settings; ``extra`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the engine's SQL settings on a session somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    It is named by ``spark.checkpoint.dir``; without that setting nothing is written
    anywhere, because executors could neither write nor re-read one machine's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return named.rstrip("/")


_OWNED: ContextVar[list[str] | None] = ContextVar("settled_paths", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside the block when it ends.

    For code that has written its results by then, such as one table's run.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark's setting under which a statement's shuffle files are deleted when it ends.
GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def giving_back(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what is written inside the block as soon as it is written; nothing reads them again."""
    before = spark.conf.get(GIVE_BACK, None)
    spark.conf.set(GIVE_BACK, "true")
    try:
        yield
    finally:
        spark.conf.unset(GIVE_BACK) if before is None else spark.conf.set(GIVE_BACK, before)


def settle(df: DataFrame, label: str = "stage", watch: Observation | None = None, *measures: Column) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, survives executor loss, and gives
    the planner real sizes for what follows. ``watch`` collects aggregate
    ``measures`` of the rows while they are written.
    """
    df = df.observe(watch, *measures) if watch is not None else df
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    with giving_back(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Plan nodes that are as cheap to run again as to read back.
CHEAP = ("Project", "Filter", "LogicalRelation", "LocalRelation", "InMemoryRelation", "Range", "ResolvedHint", "SubqueryAlias")
#: File formats of which a scan reads the needed columns only.
COLUMNAR = ("ParquetFileFormat", "OrcFileFormat")


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _repeatable(node) -> bool:
    """A plan of projections and filters over columnar files or data at hand, the same rows each time."""
    name = node.getClass().getSimpleName()
    if name not in CHEAP or not all(e.deterministic() for e in _items(node.expressions())):
        return False
    if name == "LogicalRelation":
        relation = node.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.fileFormat().getClass().getSimpleName() not in COLUMNAR:
            return False
    return all(map(_repeatable, _items(node.children())))


def once(df: DataFrame, label: str = "input") -> DataFrame:
    """``df`` ready to be read several times by one operator.

    A plain scan of columnar files with filters and projections is cheap to repeat with pruned
    columns and is returned as it is. Anything that joins, aggregates or sorts, reads text files or a database,
    or may differ from one run to the next is settled first, so a chain of multi-pass operators costs the sum of its
    passes and not their product.
    """
    return df if _repeatable(df._jdf.queryExecution().optimizedPlan()) else settle(df, label)
