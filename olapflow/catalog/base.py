"""Registry of the checked queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from olapflow.session import tune
from olapflow.streaming.batches import read_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one folder: ``t.events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream(self, name: str) -> DataFrame:
        """The same table as unbounded input."""
        return read_stream(self.spark, self.folder, getattr(self, name).schema, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL twin when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(tune(spark), folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def money(column: str):
    """Amounts with two decimals as exact decimals, so sums do not depend on order."""
    return F.col(column).cast("decimal(12,2)")


def total(column):
    """Exact sum of an amount, given back as a double."""
    return F.sum(money(column) if isinstance(column, str) else column).cast("double")


def iso_day(column):
    return F.date_format(column, "yyyy-MM-dd")


def iso_time(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
