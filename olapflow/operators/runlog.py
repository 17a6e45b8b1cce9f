"""Process run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from olapflow.operators.window import next_value

LOG_SCHEMA = "process_id string, process_name string, status string, created_at timestamp"


def log_event(spark: SparkSession, path: str, process_id: str, process_name: str, status: str) -> None:
    """Append one status row; earlier rows are never touched."""
    row = spark.range(1).select(
        F.lit(process_id).alias("process_id"),
        F.lit(process_name).alias("process_name"),
        F.lit(status).alias("status"),
        F.current_timestamp().alias("created_at"),
    )
    row.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def run_log_view(
    log: DataFrame,
    key: str = "process_id",
    order: Sequence[str] = ("created_at",),
    status: str = "status",
    chunk: Column | None = None,
) -> DataFrame:
    """Each start with the row that follows it: final status, end and duration in seconds.

    A start without a follower is still running.
    """
    paired = next_value(log, [key], list(order), {"__status": status, "end_time": order[0]}, chunk)
    started = paired.where(F.col(status) == "running").withColumnRenamed(order[0], "start_time")
    return started.withColumns(
        {
            status: F.coalesce("__status", F.col(status)),
            "duration": F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")),
        }
    ).drop("__status")


def count_running(view: DataFrame, name: str, column: str = "process_name", status: str = "status") -> DataFrame:
    """Number of runs of a process that have not ended."""
    running = view.where((F.col(column) == name) & (F.col(status) == "running"))
    return running.agg(F.count(F.lit(1)).alias("running"))
