"""What the text operators share: word patterns, scratch tables, settings, the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from olapflow.session import scratch_path, tune

#: The white space that separates words, as a set for trimming and as a pattern.
SPACE = " \t\n\x0b\x0c\r"
SPACES, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def settle(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches of few rows, since texts may be long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return settle(spark).read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``, with its SQL when there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a cut in the lineage that
    outlives executors. For small columns that several jobs need."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))
