"""Ordered operators over keyed rows.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. These functions
count the rows of each key. The rows of large keys, and frames without keys, are sorted
into ranges of (keys, order) once and stored with the number of their range, the *chunk*;
a window task then sees one (key, chunk) only. What must cross a chunk border travels as
one extra *carry row* per (key, chunk), found by its chunk number from a partially
aggregated summary. No border value comes to the driver or into a plan, so plans are alike
for any number of rows. Without large keys they are plain windows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.session import stored

_CHUNK, _SIDE, _AT, _POS = "__chunk", "__side", "__at", "__pos"


#: Rows of a key up to which one task sorts them all; larger keys are split into chunks of
#: about as many.
CHUNK_ROWS = 200_000


def order_bounds(df: DataFrame, column: str, parts: int) -> list[str]:
    """Smallest values, as text, of about ``parts`` ranges of equal row counts.

    The column is range-sorted once; one value per range comes to the driver. Nulls are
    left out. No bounds are needed for one range.
    """
    if parts <= 1:
        return []
    ranges = df.select(F.col(column).alias("v")).where("v is not null").repartitionByRange(parts, "v")
    lowest = ranges.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("v").cast("string").alias("v"))
    return [r.v for r in sorted(lowest.collect(), key=lambda r: r.p)]


def bound_index(column: Column, bounds: Sequence, kind: T.DataType) -> Column:
    """Position (from 1) of the range a value falls in; nulls and lower values are in the
    first. Two levels of bounds keep the search short."""
    if not bounds:
        return F.lit(1)
    values = F.array(*[F.lit(b).cast(kind) for b in bounds])
    width = max(1, math.isqrt(len(bounds)))
    heads = F.array(*[F.lit(b).cast(kind) for b in bounds[::width]])
    head = F.greatest(F.size(F.filter(heads, lambda b: b <= column)), F.lit(1))
    block = F.slice(values, (head - 1) * width + 1, F.lit(width))
    return F.greatest((head - 1) * width + F.size(F.filter(block, lambda b: b <= column)), F.lit(1))


#: Ranges that a frame is cut into at most, so that a row for each can be broadcast; beyond
#: that the ranges grow.
MOST_RANGES = 50_000

#: Chunk number of rows whose keys are not split.
_WHOLE = -1


def _ranges(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """The frame range-sorted by ``columns`` and stored, with ``__chunk``, the number of the
    range, and ``__pos``, the position in it from 0."""
    parts = min(max(1, -(-rows // CHUNK_ROWS)), MOST_RANGES)
    ranged = df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # its low bits count a task's rows
    return stored(ranged.select("*", F.spark_partition_id().alias(_CHUNK), place.alias(_POS)), "ranges")


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | None):
    """The frame with ``__chunk``, or None if no key has more rows than a task should sort.

    Keys are counted, and only those over ``CHUNK_ROWS`` are split, into ranges of all
    their rows. All other keys are one chunk each.
    """
    if chunk is not None:
        return df.withColumn(_CHUNK, chunk)
    if not keys:
        rows = df.count()
        return _ranges(df, order, rows).drop(_POS) if rows > CHUNK_ROWS else None
    counted = df.groupBy(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias(_AT))
    large = counted.where(F.col(_AT) > CHUNK_ROWS)
    rows = large.agg(F.sum(_AT)).first()[0]
    if not rows:
        return None
    large = stored(large, "large-keys")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    split = _ranges(df.join(large, same, "left_semi"), [*keys, *order], rows).drop(_POS)
    return split.unionByName(df.join(large, same, "left_anti").withColumn(_CHUNK, F.lit(_WHOLE)))


def _crossing(rows: DataFrame, chunk: Column | None) -> DataFrame:
    """The rows whose keys have several chunks, or may have."""
    return rows if chunk is not None else rows.where(F.col(_CHUNK) != _WHOLE)


def _neighbour(df, keys, order, fields, chunk, forward: bool) -> DataFrame:
    """Add ``fields`` (new name -> source column) of the next or previous row."""
    names = df.columns
    chunked = _chunked(df, keys, order, chunk)
    if chunked is None:
        shift = F.lead if forward else F.lag
        near = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*names, *[shift(src).over(near).alias(name) for name, src in fields.items()])
    plain = set(fields.values()) == {order[0]}
    if plain:  # the edge of a chunk is a minimum or maximum: a hash aggregate, no sort
        at = F.col(order[0])
    else:
        at = F.struct(
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
            *[F.col(src).alias(f"v{i}") for i, src in enumerate(fields.values())],
        )
    rows = chunked.withColumn(_AT, at)
    edge = F.min(_AT) if forward else F.max(_AT)
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    shift = F.lead if forward else F.lag
    carry = (
        _crossing(rows, chunk).groupBy(*keys, _CHUNK)
        .agg(edge.alias(_AT))
        .withColumn(_AT, shift(_AT).over(by_chunk))
        .where(F.col(_AT).isNotNull())
        .withColumn(_SIDE, F.lit(1 if forward else -1))
    )
    both = rows.withColumn(_SIDE, F.lit(0)).unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(_SIDE, *order)
    out = both.withColumn(_AT, shift(_AT).over(inside)).where(F.col(_SIDE) == 0)
    added = [F.col(_AT if plain else f"{_AT}.v{i}").alias(name) for i, name in enumerate(fields)]
    return out.select(*names, *added)


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: dict[str, str],
    chunk: Column | None = None,
) -> DataFrame:
    """Add columns of the following row of the same keys, null on the last row.

    ``order`` must be unique within the keys. ``fields`` maps new names to source
    columns.
    """
    return _neighbour(df, list(keys), list(order), fields, chunk, forward=True)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: dict[str, str],
    chunk: Column | None = None,
) -> DataFrame:
    """Add columns of the preceding row of the same keys, null on the first row."""
    return _neighbour(df, list(keys), list(order), fields, chunk, forward=False)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    how: str = "sum",
    chunk: Column | None = None,
    before: bool = False,
) -> DataFrame:
    """Add the running ``sum``, ``max`` or ``min`` of ``value`` per key.

    ``before`` leaves the current row out. Decimal and whole-number sums are exact
    and do not depend on task order.
    """
    keys, order = list(keys), list(order)
    fold = {"sum": F.sum, "max": F.max, "min": F.min}[how]
    names = df.columns
    upto = -1 if before else Window.currentRow
    chunked = _chunked(df, keys, order, chunk)
    if chunked is None:
        kind = df.select(fold(value).alias(_AT)).schema[_AT].dataType
        inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        out = df.withColumn(_AT, fold(value.cast(kind)).over(inside).cast(kind))
        return out.select(*[c for c in names if c != name], F.col(_AT).alias(name))
    rows = chunked.withColumn(_AT, value)
    kind = rows.select(fold(_AT).alias(_AT)).schema[_AT].dataType
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        _crossing(rows, chunk).groupBy(*keys, _CHUNK)
        .agg(fold(_AT).alias(_AT))
        .withColumn(_AT, fold(_AT).over(earlier).cast(kind))
        .where(F.col(_AT).isNotNull())
        .withColumn(_SIDE, F.lit(-1))
    )
    both = (
        rows.withColumn(_AT, F.col(_AT).cast(kind))
        .withColumn(_SIDE, F.lit(0))
        .unionByName(carry, allowMissingColumns=True)
    )
    inside = (
        Window.partitionBy(*keys, _CHUNK)
        .orderBy(_SIDE, *order)
        .rowsBetween(Window.unboundedPreceding, upto)
    )
    out = both.withColumn(name, fold(_AT).over(inside).cast(kind)).where(F.col(_SIDE) == 0)
    return out.select(*[c for c in names if c != name], name)


def running_sum(df, keys, order, value, name="running", chunk=None) -> DataFrame:
    """Cumulative sum per key, one result per input row."""
    column = F.col(value) if isinstance(value, str) else value
    return running(df, keys, order, column, name, "sum", chunk)


def row_index(df, keys, order, name="row_index", start=0, chunk=None) -> DataFrame:
    """Position of each row within its keys, counted from ``start``. Without keys rows are
    sorted into ranges once, and a range's rows are numbered from the sizes of those before
    it; nothing else moves."""
    if not keys and chunk is None:
        rows = df.count()
        if rows > CHUNK_ROWS:
            ranged = _ranges(df, order, rows)
            before = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            sizes = ranged.groupBy(_CHUNK).agg(F.count(F.lit(1)).alias(_AT))
            sizes = sizes.select(_CHUNK, F.coalesce(F.sum(_AT).over(before), F.lit(0)).alias(_AT))
            numbered = ranged.join(F.broadcast(sizes), _CHUNK)  # at most MOST_RANGES rows
            return numbered.select(*[c for c in df.columns if c != name], (F.col(_AT) + F.col(_POS) + start).alias(name))
    out = running(df, keys, order, F.lit(1).cast("bigint"), name, "sum", chunk)
    return out.withColumn(name, F.col(name) + F.lit(start - 1))


def next_event(df, key, order, default, column=None, name="next_event", chunk=None) -> DataFrame:
    """Following event time of a key; ``default`` (the as-of date) on the last one."""
    column = column or order[0]
    out = next_value(df, [key] if isinstance(key, str) else key, order, {name: column}, chunk)
    return out.withColumn(name, F.coalesce(name, default))


def previous_status(df, keys, order, status, name="prev_status", chunk=None) -> DataFrame:
    """Status the key held before this row."""
    return previous_value(df, keys, order, {name: status}, chunk)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of each key, by partial aggregation; no per-key sort task."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row")
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(newest).select("row.*")


def count_window(df, keys, order, n, aggs, chunk=None) -> DataFrame:
    """One row per key for every full run of ``n`` rows; a short tail gives none."""
    numbered = row_index(df, keys, order, "__i", chunk=chunk)
    return (
        numbered.withColumn("window_no", F.expr(f"__i div {int(n)}"))
        .groupBy(*keys, "window_no")
        .agg(*aggs, F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") == n)
        .drop("__n")
    )


def late_rows(df, arrival, ts, allowed, chunk=None) -> DataFrame:
    """Rows whose time lies before the running maximum of earlier arrivals minus ``allowed``."""
    out = running(df, [], [arrival], F.col(ts), "max_seen", "max", chunk, before=True)
    return out.where(F.col(ts) < F.col("max_seen") - F.expr(f"INTERVAL {allowed}"))
