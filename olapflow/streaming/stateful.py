"""Keyed streaming state: count windows, late rows, running totals, cached rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from olapflow.operators.join import null_safe_join
from olapflow.operators.window import row_index, running_sum


def _micros(column: pd.Series) -> np.ndarray:
    """Times as microseconds since 1970; the lowest value for null."""
    if isinstance(column.dtype, pd.DatetimeTZDtype):
        column = column.dt.tz_convert("UTC").dt.tz_localize(None)
    return column.to_numpy(dtype="datetime64[us]").astype("int64")


def _named(rows: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Batches under the stream's own column names, which computed columns lose on the way."""
    for batch in rows:
        yield batch.set_axis(names, axis=1)


_NULL = np.iinfo("int64").min

#: Shards that keys are dealt to. One call of Python and one state sees to all keys of a
#: shard, so the cost of a batch follows its rows and not the number of keys.
SHARDS = 256


def _sharded(stream: DataFrame, keys: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """The stream with ``__shard``, the same for all records of a key. Null keys have shards
    of their own, apart from those that are flagged."""
    nulls = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    return stream.withColumn("__shard", (F.pmod(F.xxhash64(*keys), F.lit(shards)) + nulls * shards).cast("int"))


def _flagged(stream: DataFrame, used: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Whole numbers outside ``used`` as a value and a flag for null, since pandas would make
    floats of them beside a null, and their names."""
    plain = [f for f in stream.schema if isinstance(f.dataType, T.IntegralType) and f.nullable and f.name not in used]
    flags = {f"__null_{f.name}": F.col(f"`{f.name}`").isNull() for f in plain}
    return stream.withColumns(flags | {f.name: F.coalesce(f"`{f.name}`", F.lit(0).cast(f.dataType)) for f in plain}), [f.name for f in plain]


def _unflagged(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(f"__null_{c}"), F.col(f"`{c}`")) for c in names}).drop(*[f"__null_{c}" for c in names])


def _by(keys: Sequence[str], flagged: Sequence[str]) -> list[str]:
    """The keys, with their flags."""
    return [*keys, *[f"__null_{k}" for k in keys if k in flagged]]


def _codes(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """A number from 0 for the key of each row; a null key is a key."""
    return frame.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()


def _joined(frames: Sequence[pd.DataFrame]) -> pd.DataFrame:
    """Frames of equal columns as one; whole numbers beside nulls stay whole."""
    frames = [f for f in frames if len(f)] or list(frames[:1])
    mixed = [c for c in frames[0].columns if len({f[c].dtype for f in frames}) > 1]
    return pd.concat([f.astype(dict.fromkeys(mixed, object)) for f in frames], ignore_index=True)


def _packed(frame: pd.DataFrame) -> bytes:
    """A frame as one value of a state."""
    table, sink = pa.Table.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(value)).read_pandas()


class _CountWindow(StatefulProcessor):
    """Sum and size of the open window of each key of a shard; a row for every ``n`` rows."""

    def __init__(self, columns: Sequence[str], keys: Sequence[str], value: str, n: int, order: Sequence[str]):
        self.columns, self.keys, self.value, self.n, self.order = list(columns), list(keys), value, n, list(order)

    def init(self, handle) -> None:
        self.state = handle.getValueState("open", "held binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = _unpacked(self.state.get()[0]) if self.state.exists() else None
        rows = _named(rows, [*self.columns, "__shard"])
        if self.order:  # the shard's rows of one batch, in order
            rows = [pd.concat(list(rows)).sort_values(self.order)]
        for batch in rows:
            held, done = self._counted(held, batch)
            if len(done):
                yield done
        self.state.update((_packed(held),))

    def _counted(self, held: pd.DataFrame | None, batch: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Open windows after a batch, and the windows it has filled."""
        known = 0 if held is None else len(held)
        named = batch[self.keys] if held is None else _joined([held[self.keys], batch[self.keys]])
        named = named.reset_index(drop=True)
        codes = _codes(named, self.keys)
        size = int(codes.max()) + 1
        first = np.full(size, len(codes))
        np.minimum.at(first, codes, np.arange(len(codes)))
        window_no, filled, total = np.zeros(size, "int64"), np.zeros(size, "int64"), np.zeros(size)
        if known:
            window_no[codes[:known]], filled[codes[:known]], total[codes[:known]] = held["window_no"], held["filled"], held["total"]
        of, values = codes[known:], batch[self.value].to_numpy(dtype="float64")
        by_key = np.argsort(of, kind="stable")
        of, values = of[by_key], values[by_key]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        at = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)])) + filled[of]  # from the open window's start
        no = at // self.n
        parts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (no[1:] != no[:-1])])
        sums, of_part, no_part = np.add.reduceat(values, parts), of[parts], no[parts]
        sums = sums + np.where(no_part == 0, total[of_part], 0.0)
        full = (at[np.r_[parts[1:], len(of)] - 1] + 1) % self.n == 0
        out = named.iloc[first[of_part[full]]].reset_index(drop=True)
        out = out.assign(window_no=window_no[of_part[full]] + no_part[full], n=np.int64(self.n), total=sums[full])
        rows = np.bincount(of, minlength=size)
        ends = filled + rows
        total[rows > 0] = 0.0
        total[of_part[~full]] = sums[~full]
        keys = named.iloc[first].reset_index(drop=True)
        return keys.assign(window_no=window_no + ends // self.n, filled=ends % self.n, total=total), out

    def close(self) -> None:
        pass


def count_window_stream(stream: DataFrame, keys: Sequence[str], value: str, n: int, order: Sequence[str] = ()) -> DataFrame:
    """One row per key after every ``n`` records in arrival order.

    Records of one micro-batch have no order of their own: with ``order`` they are taken in
    that order, for which a shard's records of a batch are held together; without it they
    pass through in Arrow batches as they come. State per key is three numbers, kept by
    shard. Needs the RocksDB state store set in session.py.
    """
    fed, flagged = _flagged(stream.select(*dict.fromkeys([*keys, value, *order])), [value, *order])
    by = _by(keys, flagged)
    kinds = ", ".join(f"`{k}` {fed.schema[k].dataType.simpleString()}" for k in by)
    out = _sharded(fed, by).groupBy("__shard").transformWithStateInPandas(
        statefulProcessor=_CountWindow(fed.columns, by, value, n, order),
        outputStructType=f"{kinds}, window_no bigint, n bigint, total double",
        outputMode="Append",
        timeMode="None",
    )
    return _unflagged(out, flagged)


class _KeySums:
    """Sums per key of the batches so far, kept as one small table per batch.

    A batch adds the sums of its own keys only. Every ``COMPACT`` batches the tables before
    are folded into one, so a batch reads at most that many. Tables are written per batch
    id with overwrite, so a repeated batch changes nothing.
    """

    COMPACT = 32

    def __init__(self, path: str, keys: Sequence[str], name: str, kind: str):
        self.path, self.keys, self.name, self.kind = path, list(keys), name, kind

    def _read(self, spark, schema: T.StructType, batch_id: int, since: int) -> DataFrame:
        paths = [f"{self.path}/batch={i}" for i in range(since, batch_id)] + ([f"{self.path}/upto={since}"] if since else [])
        parts = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return parts.groupBy(*self.keys).agg(F.sum(self.name).cast(self.kind).alias(self.name))

    def before(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Sums per key over all earlier batches."""
        fields = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in self.keys)
        schema = T.StructType.fromDDL(f"{fields}, `{self.name}` {self.kind}")
        since = batch_id // self.COMPACT * self.COMPACT
        if since and since == batch_id:
            folded = self._read(batch.sparkSession, schema, batch_id, since - self.COMPACT)
            folded.write.mode("overwrite").parquet(f"{self.path}/upto={since}")
        return self._read(batch.sparkSession, schema, batch_id, since)

    def add(self, batch: DataFrame, batch_id: int, value: Column) -> None:
        own = batch.groupBy(*self.keys).agg(F.sum(value).cast(self.kind).alias(self.name))
        own.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def running_total_writer(keys: Sequence[str], order: Sequence[str], value: Column, kind: str, path: str, chunk: Column | None = None):
    """``foreachBatch`` function: one running total per input record.

    A micro-batch is totalled with chunked windows, so a hot key spreads over tasks, and
    continues from the sums of the batches before. Records must not arrive in a
    later batch than their successors. Output is written per batch id with
    overwrite, so a repeated batch changes nothing.
    """
    keys = list(keys)
    sums = _KeySums(f"{path}/totals", keys, "__before", kind)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        totals = running_sum(batch, keys, order, value.cast(kind), "running", chunk)
        out = null_safe_join(totals, sums.before(batch, batch_id), keys, "left").withColumn(
            "running", (F.col("running") + F.coalesce("__before", F.lit(0))).cast(kind)
        )
        out.drop("__before").write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        sums.add(batch, batch_id, value)
        batch.unpersist()

    return write


def count_window_writer(keys: Sequence[str], order: Sequence[str], value: Column, kind: str, n: int, path: str):
    """``foreachBatch`` function: windows of ``n`` records per key, for keys of any size.

    Two steps instead of one state per key: the records of a batch are numbered within
    their key in ``order``, a large key in ranges over many tasks; the count of its earlier
    records is the key's offset. What each batch adds to a window is one row with a count
    and a sum, and ``count_windows`` merges the rows of a window. Exact for decimals.
    """
    keys = list(keys)
    counts = _KeySums(f"{path}/counts", keys, "__seen", "bigint")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        numbered = null_safe_join(row_index(batch, keys, order, "__i"), counts.before(batch, batch_id), keys, "left")
        at = F.col("__i") + F.coalesce("__seen", F.lit(0))
        parts = numbered.groupBy(*keys, F.floor(at / n).cast("bigint").alias("window_no")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).cast(kind).alias("total")
        )
        parts.write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
        counts.add(batch, batch_id, F.lit(1))
        batch.unpersist()

    return write


def count_windows(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The full windows that ``count_window_writer`` has written so far."""
    parts = spark.read.parquet(f"{path}/windows").drop("batch")
    keys = [c for c in parts.columns if c not in ("window_no", "n", "total")]
    kind = parts.schema["total"].dataType
    whole = parts.groupBy(*keys, "window_no").agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total"))
    return whole.where(F.col("n") == n)


class _LateRows(StatefulProcessor):
    """Highest time seen of each key of a shard; each record is compared with it as it was
    before its batch."""

    def __init__(self, columns: Sequence[str], keys: Sequence[str], ts: str, allowed_ms: int, keep_ms: int):
        self.columns, self.keys, self.ts, self.allowed, self.keep = list(columns), list(keys), ts, allowed_ms * 1000, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("marks", "held binary, timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        value, timer = self.state.get() if self.state.exists() else (None, -1)
        held = None if value is None else _unpacked(value)
        expires = max(timerValues.getCurrentWatermarkInMs(), 0) + self.keep if self.keep else -1
        seen = [] if held is None else [held]
        for batch in _named(rows, [*self.columns, "__shard"]):
            batch = batch[self.columns].reset_index(drop=True)
            times = _micros(batch[self.ts])
            named = batch[self.keys] if held is None else _joined([held[self.keys], batch[self.keys]])
            codes = _codes(named, self.keys)
            marks = np.full(int(codes.max()) + 1, _NULL)
            if held is not None:
                marks[codes[: len(held)]] = held["high"]
            mark = marks[codes[len(named) - len(batch) :]]
            known = (times != _NULL) & (mark != _NULL)
            behind = np.where(known, mark - np.where(known, times, 0), 0)
            yield batch.assign(late=known & (behind > self.allowed), behind_ms=np.maximum(behind, 0) // 1000)
            seen.append(self._highest(batch[self.keys].assign(high=times, expires=np.int64(expires))))
        self._keep(self._highest(_joined(seen)), timer)

    def _highest(self, seen: pd.DataFrame) -> pd.DataFrame:
        return seen.groupby(self.keys, sort=False, dropna=False, as_index=False)[["high", "expires"]].max()

    def _keep(self, held: pd.DataFrame, timer: int) -> None:
        """Keep the marks and see to a timer for the key that will have been silent first."""
        wanted = int(held["expires"].min()) if self.keep and len(held) else -1
        if timer != wanted:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if wanted >= 0:
                self.handle.registerTimer(wanted)
        self.state.update((_packed(held), wanted))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, fired = _unpacked(self.state.get()[0]), expiredTimerInfo.getExpiryTimeInMs()
        left = held[held["expires"] >= max(fired + 1, timerValues.getCurrentWatermarkInMs())]  # silent keys start anew
        if len(left):
            self._keep(left, -1)  # the timer that fired is gone already
        else:
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def late_rows_stream(stream: DataFrame, keys: Sequence[str], ts: str, allowed_ms: int, keep_ms: int = 0) -> DataFrame:
    """Every record with ``late`` and ``behind_ms``, so that late ones are an output of
    their own and none is dropped.

    A record is late if its time ``ts`` lies more than ``allowed_ms`` before the highest
    time its key had shown in earlier micro-batches; records of one batch do not make
    each other late. A null time is never late. ``behind_ms`` is the distance to that
    mark, 0 if none. State per key is two times, kept by shard. With ``keep_ms`` the stream must carry a
    watermark on its arrival time (a column other than ``ts``); a key that has been silent
    for that long is forgotten by an event-time timer.
    """
    fed, flagged = _flagged(stream, [ts])
    by = _by(keys, flagged)
    schema = T.StructType([*fed.schema.fields, T.StructField("late", T.BooleanType()), T.StructField("behind_ms", T.LongType())])
    out = _sharded(fed, by).groupBy("__shard").transformWithStateInPandas(
        statefulProcessor=_LateRows(fed.columns, by, ts, allowed_ms, keep_ms), outputStructType=schema, outputMode="Append",
        timeMode="EventTime" if keep_ms else "None",
    )
    return _unflagged(out, flagged)


class _OrderedTotals(StatefulProcessor):
    """Records of a shard that wait for the watermark, and the totals of those released."""

    def __init__(self, keys: Sequence[str], ts: str, order: Sequence[str], value: str, columns: Sequence[str]):
        self.keys, self.ts, self.order, self.value, self.columns = list(keys), ts, list(order), value, list(columns)

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.totals = handle.getValueState("totals", "held binary")
        self.timer = handle.getValueState("timer", "timer bigint")

    def _set(self, timer: int, first: int | None) -> None:
        """See to a timer just after the earliest waiting record."""
        wanted = -1 if first is None else first // 1000 + 1
        if timer != wanted:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if wanted >= 0:
                self.handle.registerTimer(wanted)
        self.timer.update((wanted,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer = self.timer.get()[0] if self.timer.exists() else -1
        first = None
        for batch in _named(rows, [*self.columns, "__shard"]):
            batch = batch.loc[batch[self.ts].notna(), self.columns]
            if len(batch):
                low = int(_micros(batch[self.ts]).min())
                first = low if first is None else min(first, low)
                self.waiting.appendList([(_packed(batch),)])
        if first is not None and (timer < 0 or first // 1000 + 1 < timer):
            self._set(timer, first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = _joined([_unpacked(value) for value, in self.waiting.get()])
        times = _micros(rows[self.ts])
        ready, rest = rows[times <= mark], times[times > mark]
        if len(rest):
            self.waiting.put([(_packed(rows[times > mark]),)])
        else:
            self.waiting.clear()
        self._set(-1, int(rest.min()) if len(rest) else None)  # the timer that fired is gone already
        if len(ready):
            yield self._totalled(ready.sort_values(self.order).reset_index(drop=True))

    def _totalled(self, ready: pd.DataFrame) -> pd.DataFrame:
        """Records in order with the totals of their keys, which are kept."""
        held = _unpacked(self.totals.get()[0]) if self.totals.exists() else None
        known = 0 if held is None else len(held)
        named = (ready[self.keys] if held is None else _joined([held[self.keys], ready[self.keys]])).reset_index(drop=True)
        codes = _codes(named, self.keys)
        totals = np.zeros(int(codes.max()) + 1, dtype=object)
        if known:
            totals[codes[:known]] = [int(v) for v in held["total"]]
        units = ready[self.value].to_numpy(dtype="int64")
        if max(map(abs, totals)) + np.abs(units.astype("float64")).sum() < 2**62:
            totals = totals.astype("int64")
        else:  # beyond 64 bits: Python's own numbers
            units = units.astype(object)
        of = codes[known:]
        by_key = np.argsort(of, kind="stable")
        sorted_of, upto = of[by_key], np.cumsum(units[by_key])
        starts = np.flatnonzero(np.r_[True, sorted_of[1:] != sorted_of[:-1]])
        base = totals[sorted_of[starts]] - (upto[starts] - units[by_key][starts])
        running = np.empty_like(upto)
        running[by_key] = upto + np.repeat(base, np.diff(np.r_[starts, len(of)]))
        ends = by_key[np.r_[starts[1:], len(of)] - 1]
        totals[of[ends]] = running[ends]
        first = np.full(len(totals), len(codes))
        np.minimum.at(first, codes, np.arange(len(codes)))
        self.totals.update((_packed(named.iloc[first].reset_index(drop=True).assign(total=[str(v) for v in totals])),))
        return ready.assign(__running=[str(v) for v in running.tolist()])

    def close(self) -> None:
        pass


def running_total_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], value: Column, scale: int = 2, name: str = "running"
) -> DataFrame:
    """One running total per input record, in the order of event time, whatever order the
    records come in.

    Records wait, as Arrow batches, in the state of their key's shard until the watermark of ``ts`` (set before) has
    passed them; an event-time timer then releases them by ``order``, which begins with
    ``ts``. The total is one value per key, exact to ``scale`` digits; nothing is written
    again per batch. Records later than the watermark, or without a time, are left out.
    A null value counts as zero. A shard's waiting records are held together, so their number
    is that of the watermark's delay.
    """
    if order[0] != ts:
        raise ValueError("the order begins with the event time")
    units = (value.cast(f"decimal(18,{scale})") * 10**scale).cast("long")
    fed, flagged = _flagged(stream.withColumn("__units", F.coalesce(units, F.lit(0).cast("long"))), [*order, "__units"])
    by = _by(keys, flagged)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fed.schema.fields)
    out = _sharded(fed, by).groupBy("__shard").transformWithStateInPandas(
        statefulProcessor=_OrderedTotals(by, ts, order, "__units", fed.columns),
        outputStructType=f"{schema}, __running string", outputMode="Append", timeMode="EventTime",
    )
    exact = (F.col("__running").cast("decimal(38,0)") / F.lit(10**scale)).cast(f"decimal(38,{scale})")
    out = _unflagged(out, flagged)
    return out.select(*[c for c in stream.columns if c != name], exact.alias(name))


class _Cache(StatefulProcessor):
    """The newest rows of a shard, written out as a new version whenever rows come."""

    def __init__(self, id_col: str, ts: str, columns: Sequence[str], rows: int | None, period_ms: int | None):
        self.id, self.ts, self.columns, self.rows, self.period = id_col, ts, list(columns), rows, period_ms

    def init(self, handle) -> None:
        self.state = handle.getValueState("kept", "version bigint, held binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        version, best = -1, []
        if self.state.exists():
            version, value = self.state.get()
            best = [_unpacked(value)]
        for batch in _named(rows, [*self.columns, "shard"]):
            best = [self._evicted(_joined([*best, self._evicted(batch[self.columns])]))]
        self.state.update((version + 1, _packed(best[0])))
        out = best[0].copy()
        out.insert(0, "shard", key[0])
        out.insert(1, "version", version + 1)
        yield out

    def _evicted(self, rows: pd.DataFrame) -> pd.DataFrame:
        if self.period is not None and len(rows):
            times = _micros(rows[self.ts])
            rows = rows[times > times.max() - self.period * 1000]
        if self.rows is not None and len(rows) > self.rows:
            rows = rows.sort_values(self.id, ascending=False, kind="stable").head(self.rows)
        return rows

    def close(self) -> None:
        pass


def cache_stream(
    stream: DataFrame, id_col: str, ts: str, rows: int | None = None, period_ms: int | None = None, shards: int | None = None
) -> DataFrame:
    """A cache fed by a stream: the newest ``rows`` rows by id, those of the last
    ``period_ms`` before the newest time, or both; older ones are evicted as new ones come.

    The stream is spread over ``shards`` by its id, and each holds that many rows or that
    period itself, so what the whole cache must hold is among them. By default there are 8
    for a number of rows, of which each holds all, and 64 for a period alone. After each batch the
    shards with new rows put out their content as a new ``version``; ``cached`` reads the
    newest. Ids must not be null.
    """
    if rows is None and period_ms is None:
        raise ValueError("a cache is bounded by rows or by a period")
    shards = shards or (64 if rows is None else 8)
    fed, flagged = _flagged(stream, [id_col, ts])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fed.schema.fields)
    shard = F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int")
    out = fed.withColumn("shard", shard).groupBy("shard").transformWithStateInPandas(
        statefulProcessor=_Cache(id_col, ts, fed.columns, rows, period_ms),
        outputStructType=f"shard int, version bigint, {schema}", outputMode="Update", timeMode="None",
    )
    return _unflagged(out, flagged)


def cached(versions: DataFrame) -> DataFrame:
    """Content of a cache: the newest version of every shard."""
    newest = versions.groupBy("shard").agg(F.max("version").alias("version"))
    return versions.join(F.broadcast(newest), ["shard", "version"]).drop("shard", "version")  # one row a shard
