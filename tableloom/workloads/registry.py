"""Named queries over the test tables, each with an equivalent in SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableloom.plans.steps import StepContext, apply_steps
from tableloom.session import apply_settings
from tableloom.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The test tables of one folder as attributes, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = apply_settings(spark), folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def store(self, **frames: DataFrame) -> TableStore:
        return TableStore(self.spark, frames=frames)

    def steps(self, df: DataFrame, *steps: dict, **frames: DataFrame) -> DataFrame:
        """Run declarative steps over ``df`` with ``frames`` as the tables they may name."""
        return apply_steps(df, steps, StepContext(self.store(**frames)))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""
    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[name] = sql.strip()
        return fn
    return wrap
