"""Error routing and golden-data comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_errors(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and failing rows with error count and names."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)) for label, ok in checks.items()])
    )
    marked = df.withColumn("error_codes", failed).withColumn("error_count", F.size("error_codes"))
    good = marked.where(F.col("error_count") == 0).drop("error_codes", "error_count")
    bad = marked.where(F.col("error_count") > 0).withColumn("error_codes", F.array_join("error_codes", ","))
    return good, bad


def abort_if(bad: DataFrame, message: str = "rows failed their checks") -> None:
    """Stop when there is a failing row; the error carries how many."""
    n = bad.count()
    if n:
        raise ValueError(f"{n} {message}")


def golden_diff(
    actual: DataFrame, golden: DataFrame, mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows that differ between a result and its expected data, as a multiset.

    ``mapping`` renames result fields to golden fields. ``surplus`` is positive for rows
    only the result has, negative for missing ones; no rows means equal. One grouping of
    both sides replaces two set differences.
    """
    columns = golden.columns
    got = actual.withColumnsRenamed(dict(mapping or {})).select(*columns).withColumn("surplus", F.lit(1))
    want = golden.withColumn("surplus", F.lit(-1))
    both = got.unionByName(want)
    return both.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")


def conserved(total_a: DataFrame, total_b: DataFrame, column: str, tolerance: str = "0.01") -> DataFrame:
    """Two one-row totals side by side, and whether they agree."""
    left = total_a.select(F.col(column).cast("decimal(38,6)").alias("a"))
    out = left.withColumn("b", total_b.select(F.col(column).cast("decimal(38,6)").alias("b")).scalar())
    return out.withColumn("equal", F.abs(F.col("a") - F.col("b")) <= F.lit(tolerance).cast("decimal(38,6)"))
