"""Events, validity intervals, ledgers and daily snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from olapflow.operators.window import next_value, previous_value


def to_intervals(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    attrs: Sequence[str],
    as_of: Column | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Half-open validity intervals [valid_from, valid_to) of each event.

    ``order[0]`` is the event time, the rest breaks ties. The last interval of a key
    ends at ``as_of``, or stays open (null).
    """
    out = next_value(events, [key], order, {"valid_to": order[0]}, chunk)
    end = F.col("valid_to") if as_of is None else F.coalesce("valid_to", as_of)
    return out.select(
        key,
        *[a for a in attrs if a not in (key, order[0])],
        F.col(order[0]).alias("valid_from"),
        end.alias("valid_to"),
    )


def explode_snapshot(intervals: DataFrame, lo: str, hi: str, day: str = "day") -> DataFrame:
    """One row per day of [lo, hi) with quantity 1; an empty interval gives none."""
    return (
        intervals.where(F.col(lo) < F.col(hi))
        .withColumn(day, F.explode(F.sequence(F.col(lo), F.date_sub(F.col(hi), 1))))
        .withColumn("quantity", F.lit(1))
    )


def _cumulate_days(changes: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Running total of daily ``delta`` per ``by`` on every day up to the last change.

    Input holds one row per (by, day), so a window group is no longer than the calendar.
    """
    upto = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    nxt = Window.partitionBy(*by).orderBy(day)
    return (
        changes.withColumn("n", F.sum("delta").over(upto))
        .withColumn("__next", F.lead(day).over(nxt))
        .where((F.col("n") != 0) & F.col("__next").isNotNull())
        .withColumn(day, F.explode(F.sequence(F.col(day), F.date_sub("__next", 1))))
        .select(*by, day, F.col("n").cast("bigint").alias("n"))
    )


def snapshot_counts(events: DataFrame, key: str, day: str, as_of: Column) -> DataFrame:
    """Keys on hand per day, where a key is on hand from its first event to ``as_of``.

    The gap rows of one key join up end to end, so their count per day needs the
    first and last date of each key only: one hash aggregate, then +1/-1 day changes
    and a running total over the calendar. No per-event row is ever multiplied.
    """
    spans = events.groupBy(key).agg(F.min(day).alias("lo"), F.greatest(F.max(day), as_of).alias("hi"))
    return interval_counts(spans, "lo", "hi", [], day)


def interval_counts(
    intervals: DataFrame, lo: str, hi: str, by: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Intervals covering each day, per ``by``; days with none are left out.

    Same result as exploding and counting, at the cost of two rows per interval.
    """
    change = F.explode(
        F.array(
            F.struct(F.col(lo).alias(day), F.lit(1).alias("delta")),
            F.struct(F.col(hi).alias(day), F.lit(-1).alias("delta")),
        )
    )
    changes = (
        intervals.where(F.col(lo) < F.col(hi))
        .select(*by, change.alias("c"))
        .groupBy(*by, F.col(f"c.{day}").alias(day))
        .agg(F.sum("c.delta").alias("delta"))
    )
    return _cumulate_days(changes, list(by), day)


def to_ledger(
    events: DataFrame, key: str, state: str, order: Sequence[str], chunk: Column | None = None
) -> DataFrame:
    """Entering rows (+1) and, for each later event, a row (-1) closing the old state.

    ``age_days`` counts whole calendar days spent in the state that is closed.
    """
    ts = order[0]
    seen = previous_value(events, [key], order, {"__old": state, "__since": ts}, chunk)
    enter = F.struct(F.col(state).alias("state"), F.lit(1).alias("quantity"), F.lit(0).alias("age_days"))
    leave = F.struct(
        F.col("__old").alias("state"),
        F.lit(-1).alias("quantity"),
        F.datediff(ts, "__since").alias("age_days"),
    )
    rows = F.when(F.col("__since").isNull(), F.array(enter)).otherwise(F.array(leave, enter))
    return seen.select(*dict.fromkeys([key, *order]), F.inline(rows))


def flow_counts(ledger: DataFrame, day: Column, state: str = "state") -> DataFrame:
    """Entries and exits per day and state."""
    qty = F.col("quantity")
    return ledger.groupBy(day.alias("day"), state).agg(
        F.coalesce(F.sum(F.when(qty > 0, qty)), F.lit(0)).cast("bigint").alias("entered"),
        F.coalesce(F.sum(F.when(qty < 0, -qty)), F.lit(0)).cast("bigint").alias("left_state"),
    )


def advance_snapshot(
    prev: DataFrame, new_day: DataFrame, dims: Sequence[str], day: str = "day", qty: str = "quantity"
) -> DataFrame:
    """Yesterday's balance carried one day on, plus the new day's changes; zeros dropped."""
    moved = prev.select(F.date_add(day, 1).alias(day), *dims, qty)
    both = moved.unionByName(new_day.select(day, *dims, qty))
    return both.groupBy(day, *dims).agg(F.sum(qty).alias(qty)).where(F.col(qty) != 0)


def accumulate(
    ledger: DataFrame, dims: Sequence[str], until: Column, day: str = "day", qty: str = "quantity"
) -> DataFrame:
    """Balance per dims on every day to ``until``.

    Filler days repeat the balance and carry 0 for the period measure; a balance of
    zero gets no fillers. Changes are summed per (dims, day) first.
    """
    dims = list(dims)
    daily = ledger.groupBy(*dims, day).agg(F.sum(qty).cast("bigint").alias("change"))
    by_day = Window.partitionBy(*dims).orderBy(day)
    balance = F.sum("change").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    known = daily.withColumn("balance", balance).withColumn("__next", F.lead(day).over(by_day))
    last = F.coalesce(F.date_sub("__next", 1), until)
    span = F.when(
        (F.col("balance") != 0) & (last > F.col(day)), F.sequence(F.col(day), last)
    ).otherwise(F.array(day))
    return (
        known.select(*dims, "change", "balance", F.posexplode(span).alias("__i", day))
        .withColumn("change", F.when(F.col("__i") == 0, F.col("change")).otherwise(F.lit(0)).cast("bigint"))
        .select(*dims, day, "change", "balance")
    )


def state_age_snapshot(
    events: DataFrame, key: str, state: str, order: Sequence[str], until: Column, day: str = "day"
) -> DataFrame:
    """State of each key at the end of every day up to ``until``, with its age.

    Only the last event of a day counts, so changes within a day leave no trace.
    ``age_in_state`` counts days since that event, ``age_of_key`` since the key's
    first day.
    """
    end_of_day = events.groupBy(key, F.to_date(order[0]).alias("__from")).agg(
        F.max(F.struct(*order, F.col(state).alias("__state"))).alias("__last")
    )
    per_key = Window.partitionBy(key)
    known = end_of_day.select(
        key,
        "__from",
        F.col("__last.__state").alias(state),
        F.lead("__from").over(per_key.orderBy("__from")).alias("__next"),
        F.min("__from").over(per_key).alias("__first"),
    )
    last = F.coalesce(F.date_sub("__next", 1), until)
    return (
        known.where(last >= F.col("__from"))
        .select(
            key, state, "__first", F.posexplode(F.sequence("__from", last)).alias("age_in_state", day)
        )
        .select(
            key,
            day,
            state,
            "age_in_state",
            F.datediff(day, "__first").alias("age_of_key"),
            F.lit(1).alias("on_hand"),
        )
    )


def aggregate_snapshot(snapshot: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Quantity on hand at a coarser grain; call it after filling, never before."""
    return snapshot.groupBy(*dims).agg(F.sum("on_hand").cast("bigint").alias("on_hand"))


def late_corrections(late: DataFrame, day: str, last_day: Column, qty: str = "quantity") -> DataFrame:
    """Correcting rows from each late event's day to the last snapshot day."""
    return late.where(F.col(day) <= last_day).withColumn(
        day, F.explode(F.sequence(F.col(day), last_day))
    )


def milestones(events: DataFrame, key: str, step: str, ts: str, steps: Sequence[str]) -> DataFrame:
    """One row per key: first time and count of each step, as fixed columns."""
    aggs = []
    for s in steps:
        hit = F.col(step) == s
        aggs += [
            F.min(F.when(hit, F.col(ts))).alias(f"{s}_first"),
            F.count(F.when(hit, True)).alias(f"{s}_count"),
        ]
    return events.groupBy(key).agg(*aggs)


def merge_intervals(
    open_rows: DataFrame, new_events: DataFrame, key: str, order: Sequence[str], attrs: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows to append to the closed partition, and the new open partition.

    ``open_rows`` holds one unfinished interval per key. Closed history is never read.
    """
    carry = [*dict.fromkeys([key, *order, *attrs])]
    rows = open_rows.withColumn(order[0], F.col("valid_from")).select(*carry)
    rows = rows.unionByName(new_events.select(*carry))
    spans = to_intervals(rows, key, order, [*order[1:], *attrs])
    done = spans.where(F.col("valid_to").isNotNull())
    still = spans.where(F.col("valid_to").isNull())
    return done, still


def write_intervals(done: DataFrame, still: DataFrame, path: str, batch: int) -> None:
    """Store a maintenance step: closed rows are added, open rows are replaced.

    Both go to folders of this batch with overwrite, so a step that is repeated after a
    failure leaves the same rows, and nothing that is being read is overwritten.
    """
    done.write.mode("overwrite").parquet(f"{path}/closed/batch={batch}")
    still.write.mode("overwrite").parquet(f"{path}/open/batch={batch}")


def read_intervals(spark: SparkSession, path: str, batch: int) -> tuple[DataFrame, DataFrame]:
    """Closed rows up to a batch, and its open rows; other open folders are not read."""
    closed = spark.read.parquet(f"{path}/closed").where(F.col("batch") <= batch).drop("batch")
    return closed, spark.read.parquet(f"{path}/open/batch={batch}")
