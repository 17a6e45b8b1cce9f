"""Event-time windows that run unchanged on batch and on streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, column: str, max_late: str = "0 seconds", name: str = "event_time") -> DataFrame:
    """Declare the event time. On a stream it also sets the watermark, which Spark moves
    between micro-batches; rows later than ``max_late`` behind it are dropped there."""
    out = df.withColumn(name, F.col(column).cast("timestamp"))
    return out.withWatermark(name, max_late) if df.isStreaming else out


def with_ingest_time(df: DataFrame, name: str = "ingest_time") -> DataFrame:
    """Time at which the row entered the pipeline, for processing-time windows."""
    return df.withColumn(name, F.current_timestamp())


def _flat(df: DataFrame, bounds: str) -> DataFrame:
    start, end = F.col("window.start"), F.col("window.end")
    if bounds == "millis":
        start, end = F.unix_millis(start.cast("timestamp")), F.unix_millis(end.cast("timestamp"))
    rest = [c for c in df.columns if c != "window"]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


def tumbling(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column], bounds: str = "timestamp"
) -> DataFrame:
    """Aggregates per key and fixed window; bounds as timestamps or epoch ``millis``."""
    return _flat(df.groupBy(F.window(ts, size), *keys).agg(*aggs), bounds)


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], aggs: Sequence[Column], bounds="timestamp"
) -> DataFrame:
    """Aggregates per key and overlapping window of ``size`` every ``slide``."""
    return _flat(df.groupBy(F.window(ts, size, slide), *keys).agg(*aggs), bounds)


def session(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column], bounds="timestamp"
) -> DataFrame:
    """Aggregates per key and run of events less than ``gap`` apart.

    With ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` (see session.py)
    sessions are merged before the shuffle.
    """
    out = df.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*aggs)
    return _flat(out, bounds)


def global_window(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per key over everything seen; on a stream use complete or update mode."""
    return df.groupBy(*keys).agg(*aggs)


def parse_events(df: DataFrame, column: str, schema: str, must_have: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of JSON events; documents without a required field are dropped."""
    out = df.select(*keep, F.from_json(column, schema).alias("__e")).select(*keep, "__e.*")
    for field in must_have:
        out = out.where(F.col(field).isNotNull())
    return out


def topic_pattern(pattern: str) -> str:
    """Regular expression of a topic filter: ``+`` is one level, a final ``#`` any number."""
    if pattern == "#":
        return "^.*$"
    head, tail = (pattern[:-2], "(/.*)?") if pattern.endswith("/#") else (pattern, "")
    levels = ["[^/]*" if level == "+" else "\\Q" + level + "\\E" for level in head.split("/")]
    return "^" + "/".join(levels) + tail + "$"


def topic_match(df: DataFrame, pattern: str, column: str = "topic") -> DataFrame:
    """Rows whose topic a subscription filter covers."""
    return df.where(F.col(column).rlike(topic_pattern(pattern)))
