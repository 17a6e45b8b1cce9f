"""Regular time buckets with fillers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.operators.window import next_value, running

#: Buckets that one array holds at most.
BLOCK = 4096


def bucket_numbers(df: DataFrame, keys: Sequence[str], last: Column) -> DataFrame:
    """Numbers 0 to ``last`` (a constant) as ``__i`` for each of the keys of ``df``.

    They come in blocks. Without keys the blocks are a range that Spark deals to tasks;
    with keys one small row per key and block is shuffled, so that the numbers of a single
    key are made by many tasks as well.
    """
    spark = df.sparkSession
    blocks = spark.range(1).select((F.floor(last / BLOCK) + 1).cast("bigint")).first()[0]
    if not keys:
        grid = spark.range(0, max(blocks or 0, 0)).select(F.col("id").alias("__block"))
    elif blocks is None or blocks < 1:
        grid = df.select(*keys).limit(0).withColumn("__block", F.lit(0).cast("bigint"))
    else:
        grid = df.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("__block"))
        if blocks > 1:
            tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks)
            grid = grid.repartition(tasks, *keys, "__block")
    first = F.col("__block") * BLOCK
    return grid.select(*keys, F.explode(F.sequence(first, F.least(first + (BLOCK - 1), last.cast("bigint")))).alias("__i"))


def fill_buckets(
    df: DataFrame,
    ts: str,
    every: str,
    start: Column,
    end: Column,
    keys: Sequence[str],
    value: Column,
    name: str = "value",
    fill: str | None = None,
    cumulative: bool = False,
) -> DataFrame:
    """Aggregate ``value`` into buckets of ``every`` over [start, end], gaps included.

    ``fill`` is None (null), ``previous`` (last known value) or ``linear`` (between
    the neighbouring known values; null after the last one). ``cumulative`` adds a
    running total that treats gaps as zero. Rows are aggregated per (keys, bucket)
    first. The buckets of a key come in blocks, and what is carried over a gap or a block
    travels as in the ordered operators, so no array and no task holds a long range whole.
    ``every`` is of fixed length (seconds to weeks); buckets count from ``start``.
    """
    if fill not in (None, "previous", "linear"):
        raise ValueError(f"unknown fill {fill!r}")
    keys = list(keys)
    step = F.expr(f"INTERVAL {every}")
    in_range = (F.col(ts) >= start) & (F.col(ts) < end + step)
    width = F.timestamp_diff("MICROSECOND", start, start + step)
    at = F.floor(F.timestamp_diff("MICROSECOND", start, F.col(ts)) / width).cast("bigint")
    known = df.where(in_range).groupBy(*keys, at.alias("__i")).agg(value.alias(name)).where(F.col(name).isNotNull())
    if fill == "linear":
        known = next_value(known, keys, ["__i"], {"__ni": "__i", "__nv": name})

    last = F.floor(F.timestamp_diff("MICROSECOND", start, end) / width).cast("bigint")
    grid = bucket_numbers(df, keys, last)
    left, right = grid.alias("g"), known.alias("k")
    same = F.col("g.__i") == F.col("k.__i")
    for key in keys:
        same = same & F.col(f"g.{key}").eqNullSafe(F.col(f"k.{key}"))
    more = ["k.__ni", "k.__nv"] if fill == "linear" else []
    out = left.join(right, same, "left").select("g.*", f"k.{name}", *more)

    if cumulative:
        out = running(out, keys, ["__i"], F.coalesce(name, F.lit(0)), "cumulative")
    if fill:
        fields = ["__i", name, *(["__ni", "__nv"] if fill == "linear" else [])]
        seen = F.when(F.col(name).isNotNull(), F.struct(*fields))
        out = running(out, keys, ["__i"], seen, "__seen", "max")
        filled = F.col(f"__seen.{name}")
        if fill == "linear":
            share = (F.col("__i") - F.col("__seen.__i")) / (F.col("__seen.__ni") - F.col("__seen.__i"))
            between = F.col(f"__seen.{name}") + (F.col("__seen.__nv") - F.col(f"__seen.{name}")) * share
            filled = F.coalesce(F.col(name), between)
        out = out.withColumn(name, filled)
    bucket = F.timestamp_add("MICROSECOND", F.col("__i") * width, start).alias("bucket")
    return out.select(*keys, bucket, name, *(["cumulative"] if cumulative else []))
