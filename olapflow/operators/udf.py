"""User functions on rows, windows and groups, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.operators.window import row_index


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Typed row function over batches, one row out per row in. Prefer column expressions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = fn(batch)
            if len(out) != len(batch):
                raise ValueError("a row function must keep the number of rows")
            yield out

    return df.mapInPandas(run, schema)


def flat_map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Batch function that may return any number of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def apply_window(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    combine: Sequence[Column],
) -> DataFrame:
    """Custom window aggregate in two steps.

    ``partial`` reduces one Arrow batch to rows of ``schema`` (which holds window_start
    and the keys); ``combine`` folds those with built-in aggregates. No window is ever
    gathered in one Python call.
    """
    windowed = df.withColumn("window_start", F.window(ts, size).start)
    return flat_map_rows(windowed, partial, schema).groupBy("window_start", *keys).agg(*combine)


def per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    block: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Run a function per group of records, in order. It always sees the whole group, in one
    call of one task: for groups that fit into a task's memory.

    With ``block`` the groups are runs of that many rows of a key, numbered by
    ``block_no``: choose it for functions that work on parts, where keys may be large. Rows
    come to Python sorted, in Arrow batches, and the function is called for each block in
    them, so a block costs no more than the call.
    """
    if block is None:
        return df.groupBy(*keys).applyInPandas(lambda pdf: fn(pdf.sort_values(list(order))), schema)
    numbered = row_index(df, keys, order, "__i", chunk=chunk).withColumn("block_no", F.expr(f"__i div {int(block)}"))
    names = [c for c in numbered.columns if c != "__i"]
    # a null turns the whole numbers or flags of a batch into another type; a block's own nulls are put back
    plain = {f.name: f.dataType for f in numbered.schema if f.name in names and isinstance(f.dataType, (T.IntegralType, T.BooleanType))}
    nulls = {c: f"__null{i}" for i, c in enumerate(plain)}
    dealt = numbered.withColumns({n: F.col(c).isNull() for c, n in nulls.items()}).repartition(*keys, "block_no")
    dealt = dealt.sortWithinPartitions(*keys, "block_no", "__i")
    dealt = dealt.withColumns({c: F.coalesce(c, F.lit(0).cast(kind)) for c, kind in plain.items()})

    def calls(pdf: pd.DataFrame, bounds: Sequence[int]) -> list[pd.DataFrame]:
        own, out = pdf[names], []
        gone = {c: pdf[n].to_numpy() for c, n in nulls.items() if pdf[n].any()}
        for a, b in zip(bounds, bounds[1:]):
            group = own.iloc[a:b].reset_index(drop=True)
            for c, at in gone.items():
                if at[a:b].any():
                    group[c] = group[c].astype(object if group[c].dtype == bool else "float64").mask(at[a:b], None)
            out.append(fn(group))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_block: list[pd.DataFrame] = []
        for pdf in batches:
            starts = np.flatnonzero(pdf["__i"].to_numpy() % block == 0).tolist()
            if not starts:
                open_block.append(pdf)
                continue
            out = []
            if starts[0]:
                open_block.append(pdf.iloc[: starts[0]])
            if open_block:
                whole = pd.concat(open_block)
                out = calls(whole, [0, len(whole)])
            yield from _results(out + calls(pdf, starts))
            open_block = [pdf.iloc[starts[-1] :]]
        if open_block:
            whole = pd.concat(open_block)
            yield from _results(calls(whole, [0, len(whole)]))

    return dealt.mapInPandas(run, schema)


def _results(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of many calls as one frame; whole numbers beside nulls stay whole."""
    frames = [f for f in frames if len(f)]
    if frames:
        mixed = [c for c in frames[0].columns if len({f[c].dtype for f in frames}) > 1]
        yield pd.concat([f.astype(dict.fromkeys(mixed, object)) for f in frames] if mixed else frames, ignore_index=True)


def register_functions(spark: SparkSession) -> None:
    """SQL functions of this library; their bodies are inlined into the query plan."""
    for body in (
        "date_key_of(d DATE) RETURNS INT RETURN year(d) * 10000 + month(d) * 100 + day(d)",
        "in_box(lon DOUBLE, lat DOUBLE, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE) RETURNS BOOLEAN "
        "RETURN lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy",
        "make_point(lon DOUBLE, lat DOUBLE) RETURNS STRUCT<x: DOUBLE, y: DOUBLE> "
        "RETURN CASE WHEN abs(lat) <= 90 AND abs(lon) <= 180 THEN named_struct('x', lon, 'y', lat) END",
        "safe_ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN try_divide(a, b)",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")


def repartition_by(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Hash partitions chosen by the user."""
    return df.repartition(n, *columns)
