"""Running streams: micro-batches, sinks, file arrival, cached results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from olapflow.session import scratch_path


def read_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*", files_per_batch: int = 1, kind: str = "parquet"
) -> DataFrame:
    """Unbounded input from files that land in a folder."""
    return (
        spark.readStream.format(kind)
        .schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def ingest_new_files(
    spark: SparkSession, folder: str, schema, out: str, checkpoint: str, header: bool = True, pattern: str = "*.csv"
) -> StreamingQuery:
    """Load every file that has landed since the last run, each exactly once, then stop."""
    arrivals = (
        spark.readStream.schema(schema).option("header", header).option("pathGlobFilter", pattern).csv(folder)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    return (
        arrivals.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def for_each_batch(
    stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, mode="append"
) -> StreamingQuery:
    """Run a function per micro-batch. Batch size is set on the source (records or files
    per trigger); ``every`` sets the batch interval, without it pending input is drained."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def batch_summary_writer(path: str, aggs: Sequence[Column]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: one summary row per batch, stamped with batch and time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        row = batch.agg(*aggs).withColumns({"batch_id": F.lit(batch_id), "written_at": F.current_timestamp()})
        row.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def drain(stream: DataFrame, mode: str = "append", label: str = "stream") -> DataFrame:
    """Process all pending input of a stream and read back what it put out.

    Append output is the union of all batches; complete output is the last batch.
    Output and checkpoint live in the shared folder.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    run = for_each_batch(stream, write, f"{path}/checkpoint", mode=mode)
    run.awaitTermination()
    if run.exception():
        raise run.exception()
    if mode == "complete":
        return spark.read.parquet(f"{path}/rows/batch={run.lastProgress['batchId']}")
    return spark.read.parquet(f"{path}/rows").drop("batch")


def write_windowed(stream: DataFrame, ts: str, size: str, path: str, checkpoint: str) -> StreamingQuery:
    """Rows to files grouped by window start, in append mode."""
    label = F.date_format(F.window(ts, size).start, "yyyy-MM-dd-HH-mm-ss")
    return (
        stream.withColumn("window_start", label)
        .writeStream.format("parquet")
        .partitionBy("window_start")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_view(stream: DataFrame, name: str) -> None:
    """Make a live stream available to SQL."""
    stream.createOrReplaceTempView(name)


def cache_query(
    df: DataFrame,
    id_col: str,
    ts: str,
    last: int | None = None,
    last_period_ms: int | None = None,
    from_id: int | None = None,
    to_id: int | None = None,
    max_new: int | None = None,
) -> DataFrame:
    """Rows of a stream's sink table: an id range, the last ms, the last n, or at most n new."""
    if from_id is not None:
        df = df.where(F.col(id_col) >= from_id)
    if to_id is not None:
        df = df.where(F.col(id_col) <= to_id)
    if last_period_ms is not None:
        newest = df.agg(F.max(ts).alias("t")).scalar()
        df = df.where(F.col(ts) > newest - F.expr(f"INTERVAL '{last_period_ms / 1000}' SECOND"))
    if last is not None:
        df = df.orderBy(F.col(id_col).desc()).limit(last)
    if max_new is not None:
        df = df.orderBy(F.col(id_col)).limit(max_new)
    return df
