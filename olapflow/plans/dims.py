"""Date dimensions, working days and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from olapflow.functions.dates import calendar_fields
from olapflow.operators.window import row_index


def date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Date dimension of [start, end], both days included."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"), F.to_date(F.lit(end)).alias("hi"))
    return date_dim_of(bounds, "lo", "hi")


def date_dim_of(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Date dimension over the range held in a one-row frame."""
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("the_date"))
    return days.withColumns(calendar_fields(F.col("the_date")))


def role_playing(dim: DataFrame, role: str) -> DataFrame:
    """The same dimension under another role: every column gets the role as prefix."""
    return dim.select(*[F.col(c).alias(f"{role}_{c}") for c in dim.columns])


def add_working_days(dim: DataFrame, day: str = "the_date", flag: str = "is_working_day") -> DataFrame:
    """Add the running number of working days. The frame is a calendar, one row per day."""
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return dim.withColumn("working_day_no", F.sum(flag).over(upto).cast("bigint"))


def working_days_between(
    df: DataFrame, start: str, end: str, dim: DataFrame, name: str = "working_days"
) -> DataFrame:
    """Working days in (start, end], as the difference of two calendar lookups."""
    numbers = dim.select("the_date", "working_day_no")
    a = numbers.select(F.col("the_date").alias("__a"), F.col("working_day_no").alias("__na"))
    b = numbers.select(F.col("the_date").alias("__b"), F.col("working_day_no").alias("__nb"))
    return (
        df.join(a, F.col(start) == F.col("__a"), "left")
        .join(b, F.col(end) == F.col("__b"), "left")
        .withColumn(name, F.col("__nb") - F.col("__na"))
        .drop("__a", "__b", "__na", "__nb")
    )


def assign_keys(
    dim: DataFrame,
    incoming: DataFrame,
    natural_key: Sequence[str],
    sk: str,
    order: Sequence[str] | None = None,
    chunk: Column | None = None,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """The dimension with every unknown natural key added under a new surrogate key.

    All columns of the dimension stay. New rows get the ``attributes`` of the incoming
    rows, the smallest combination where a key comes with several, and null elsewhere.

    Known keys keep theirs. New ones follow the largest known key in the order of
    ``order``; numbering runs per chunk, so no task sees all new keys. Without an
    order they are spread over hash buckets and numbered by (bucket, key).
    """
    natural_key = list(natural_key)
    known = dim.select(*natural_key)
    described = incoming.groupBy(*natural_key).agg(F.min(F.struct(F.lit(0), *attributes)).alias("__told"))
    cond = reduce(and_, [known[k].eqNullSafe(described[k]) for k in natural_key])
    fresh = described.join(known, cond, "left_anti")
    if order is None:
        fresh = fresh.withColumn("__h", F.pmod(F.xxhash64(*natural_key), F.lit(4096)).cast("int"))
        numbered = row_index(fresh, [], ["__h", *natural_key], "__i", 1, F.col("__h"))
    else:
        numbered = row_index(fresh, [], order, "__i", 1, chunk)
    top = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias("top"))
    # one row by construction, read once as a scalar subquery
    told = [F.col(f"__told.{a}").alias(a) for a in attributes]
    added = numbered.select((F.col("__i") + top.scalar()).alias(sk), *natural_key, *told)
    rest = [c for c in dim.columns if c not in (sk, *natural_key)]
    whole = dim.select(F.col(sk).cast("bigint").alias(sk), *natural_key, *rest)
    return whole.unionByName(added, allowMissingColumns=True)
