"""Message topics and document indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_kafka(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, max_records: int | None = None,
    start: str = "latest",
) -> DataFrame:
    """Topic as a stream of key, message, topic, partition, offset, timestamp.

    Needs the Kafka connector package on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return decode_kafka(reader.load())


def decode_kafka(raw: DataFrame) -> DataFrame:
    """Source records with key and message as text."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("message"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def to_kafka_rows(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """Key and value as the sink expects them."""
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Stream of key/value rows to a topic."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def to_documents(df: DataFrame, index: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Keyed JSON documents, and the rows that cannot become one, with the reason."""
    marked = df.withColumn("__body", F.to_json(F.struct(*df.columns)))
    reason = F.when(F.col(id_col).isNull(), F.lit("no id")).when(F.col("__body").isNull(), F.lit("no body"))
    marked = marked.withColumn("reason", reason)
    good = marked.where(F.col("reason").isNull()).select(
        F.lit(index).alias("index"), F.col(id_col).cast("string").alias("id"), F.col("__body").alias("document")
    )
    return good, marked.where(F.col("reason").isNotNull()).drop("__body")


def document_writer(path: str, index: str, id_col: str):
    """``foreachBatch`` function: documents and rejected rows, each in its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = to_documents(batch, index, id_col)
        good.write.mode("overwrite").parquet(f"{path}/documents/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{path}/rejected/batch={batch_id}")

    return write
