"""Snapshots, ledgers, intervals and gap filling over the events table."""

from pyspark.sql import functions as F

from olapflow.catalog.base import iso_day, iso_time, query
from olapflow.plans import gapfill, snapshot
from olapflow.session import scratch_path

ORDER = ["ts", "event_id"]
AS_OF_DAY = "2024-01-31"


def _as_of():
    return F.lit(f"{AS_OF_DAY} 00:00:00").cast("timestamp_ntz")


def _intervals(t):
    return snapshot.to_intervals(t.events, "user_id", ORDER, ["event_id", "event_type"], _as_of())


def _day_intervals(t):
    return _intervals(t).select(
        "user_id",
        "event_id",
        "event_type",
        F.to_date("valid_from").alias("lo"),
        F.to_date("valid_to").alias("hi"),
    )


def _ledger(t):
    return snapshot.to_ledger(t.events, "user_id", "event_type", ORDER)


SQL_INTERVALS = """iv AS (
  SELECT user_id, event_id, event_type, ts AS valid_from,
         lead(ts, 1, TIMESTAMP '2024-01-31') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events)"""

SQL_LEDGER = """seen AS (
  SELECT user_id, ts, event_id, event_type,
         lag(event_type) OVER w AS old, lag(ts) OVER w AS since
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
ledger AS (
  SELECT user_id, ts, event_id, event_type AS state, 1 AS quantity, 0 AS age_days FROM seen
  UNION ALL
  SELECT user_id, ts, event_id, old, -1, date_diff('day', CAST(since AS DATE), CAST(ts AS DATE))
  FROM seen WHERE since IS NOT NULL)"""


@query("g01_scd2_intervals", f"""WITH {SQL_INTERVALS}
SELECT user_id, event_id, event_type,
       strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to FROM iv""")
def g01(t):
    return _intervals(t).withColumns(
        {"valid_from": iso_time("valid_from"), "valid_to": iso_time("valid_to")}
    )


@query("g02_explode_snapshot", f"""WITH {SQL_INTERVALS},
d AS (SELECT user_id, event_id, event_type, CAST(valid_from AS DATE) AS lo, CAST(valid_to AS DATE) AS hi FROM iv)
SELECT user_id, event_id, event_type, strftime(day, '%Y-%m-%d') AS day, CAST(1 AS INTEGER) AS quantity
FROM (SELECT *, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
      FROM d WHERE lo < hi)""")
def g02(t):
    rows = snapshot.explode_snapshot(_day_intervals(t), "lo", "hi")
    return rows.select("user_id", "event_id", "event_type", iso_day("day").alias("day"), "quantity")


@query("g03_snapshot_counts", f"""WITH {SQL_INTERVALS},
d AS (SELECT CAST(valid_from AS DATE) AS lo, CAST(valid_to AS DATE) AS hi FROM iv)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n
FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
      FROM d WHERE lo < hi) GROUP BY 1""")
def g03(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day"))
    out = snapshot.snapshot_counts(days, "user_id", "day", F.lit(AS_OF_DAY).cast("date"))
    return out.select(iso_day("day").alias("day"), "n")


@query("g03_snapshot_counts_by_state", f"""WITH {SQL_INTERVALS},
d AS (SELECT event_type, CAST(valid_from AS DATE) AS lo, CAST(valid_to AS DATE) AS hi FROM iv)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, count(*) AS n
FROM (SELECT event_type, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
      FROM d WHERE lo < hi) GROUP BY 1, 2""")
def g03_by_state(t):
    out = snapshot.interval_counts(_day_intervals(t), "lo", "hi", ["event_type"])
    return out.select("event_type", iso_day("day").alias("day"), "n")


@query("g04_event_ledger", f"""WITH {SQL_LEDGER}
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, state,
       CAST(quantity AS INTEGER) AS quantity, CAST(age_days AS INTEGER) AS age_days FROM ledger""")
def g04(t):
    return _ledger(t).withColumn("ts", iso_time("ts"))


@query("g05_flow_counts", f"""WITH {SQL_LEDGER}
SELECT strftime(ts, '%Y-%m-%d') AS day, state,
       CAST(coalesce(sum(quantity) FILTER (quantity > 0), 0) AS BIGINT) AS entered,
       CAST(coalesce(-sum(quantity) FILTER (quantity < 0), 0) AS BIGINT) AS left_state
FROM ledger GROUP BY 1, 2""")
def g05(t):
    return snapshot.flow_counts(_ledger(t), F.to_date("ts")).withColumn("day", iso_day("day"))


@query("g06_advance_snapshot", f"""WITH {SQL_LEDGER}
SELECT '2024-01-16' AS day, state, CAST(sum(quantity) AS BIGINT) AS quantity
FROM ledger WHERE ts < TIMESTAMP '2024-01-17' GROUP BY state HAVING sum(quantity) <> 0""")
def g06(t):
    ledger = _ledger(t).withColumn("day", F.to_date("ts"))
    first, second = F.lit("2024-01-15").cast("date"), F.lit("2024-01-16").cast("date")
    prev = (
        ledger.where(F.col("day") <= first)
        .groupBy("state")
        .agg(F.sum("quantity").alias("quantity"))
        .withColumn("day", first)
    )
    new_day = ledger.where(F.col("day") == second).select("day", "state", "quantity")
    return snapshot.advance_snapshot(prev, new_day, ["state"]).withColumn("day", iso_day("day"))


@query("g07_accumulating_snapshot", f"""WITH {SQL_LEDGER},
daily AS (SELECT user_id, state, CAST(ts AS DATE) AS d, sum(quantity) AS change FROM ledger GROUP BY ALL),
known AS (SELECT *, sum(change) OVER (PARTITION BY user_id, state ORDER BY d) AS balance,
                 lead(d) OVER (PARTITION BY user_id, state ORDER BY d) AS nxt FROM daily),
spans AS (SELECT *, CASE WHEN balance <> 0 THEN greatest(d, coalesce(nxt - 1, DATE '2024-01-31')) ELSE d END AS upto FROM known),
filled AS (SELECT *, unnest(generate_series(CAST(d AS TIMESTAMP), CAST(upto AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM spans)
SELECT user_id, state, strftime(day, '%Y-%m-%d') AS day,
       CAST(CASE WHEN CAST(day AS DATE) = d THEN change ELSE 0 END AS BIGINT) AS change,
       CAST(balance AS BIGINT) AS balance FROM filled""")
def g07(t):
    ledger = _ledger(t).withColumn("day", F.to_date("ts"))
    out = snapshot.accumulate(ledger, ["user_id", "state"], F.lit(AS_OF_DAY).cast("date"))
    return out.withColumn("day", iso_day("day"))


SQL_STATE_AGE = """last_of_day AS (
  SELECT user_id, CAST(ts AS DATE) AS lo, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY 1, 2),
known AS (SELECT *, lead(lo) OVER (PARTITION BY user_id ORDER BY lo) AS nxt,
                 min(lo) OVER (PARTITION BY user_id) AS first_day FROM last_of_day),
filled AS (SELECT *, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(coalesce(nxt - 1, DATE '2024-01-31') AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM known)"""


def _state_age(t):
    until = F.lit(AS_OF_DAY).cast("date")
    return snapshot.state_age_snapshot(t.events, "user_id", "event_type", ORDER, until)


@query("g08_state_age_snapshot", f"""WITH {SQL_STATE_AGE}
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, state AS event_type,
       CAST(date_diff('day', lo, CAST(day AS DATE)) AS INTEGER) AS age_in_state,
       CAST(date_diff('day', first_day, CAST(day AS DATE)) AS INTEGER) AS age_of_key,
       CAST(1 AS INTEGER) AS on_hand FROM filled""")
def g08(t):
    return _state_age(t).withColumn("day", iso_day("day"))


@query("g09_aggregate_snapshot", f"""WITH {SQL_STATE_AGE}
SELECT strftime(day, '%Y-%m-%d') AS day, state AS event_type, count(*) AS on_hand FROM filled GROUP BY 1, 2""")
def g09(t):
    out = snapshot.aggregate_snapshot(_state_age(t), ["day", "event_type"])
    return out.withColumn("day", iso_day("day"))


@query("g10_late_corrections", """
SELECT user_id, event_id, strftime(day, '%Y-%m-%d') AS day, CAST(1 AS INTEGER) AS quantity
FROM (SELECT user_id, event_id, unnest(generate_series(date_trunc('day', ts), TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS day
      FROM events WHERE event_type = 'error')""")
def g10(t):
    late = t.events.where("event_type = 'error'").select(
        "user_id", "event_id", F.to_date("ts").alias("day"), F.lit(1).alias("quantity")
    )
    out = snapshot.late_corrections(late, "day", F.lit(AS_OF_DAY).cast("date"))
    return out.withColumn("day", iso_day("day"))


STEPS = ["view", "click", "signup", "purchase", "error"]


@query("g11_milestones", "SELECT user_id, " + ", ".join(
    f"strftime(min(ts) FILTER (event_type = '{s}'), '%Y-%m-%d %H:%M:%S.%f') AS {s}_first, "
    f"count(*) FILTER (event_type = '{s}') AS {s}_count" for s in STEPS) + " FROM events GROUP BY user_id")
def g11(t):
    out = snapshot.milestones(t.events, "user_id", "event_type", "ts", STEPS)
    return out.withColumns({f"{s}_first": iso_time(f"{s}_first") for s in STEPS})


@query("g12_merge_open_closed", """WITH iv AS (
  SELECT user_id, event_id, event_type, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events)
SELECT user_id, event_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
       CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_open
FROM iv WHERE valid_to IS NULL OR valid_to >= TIMESTAMP '2024-01-16'""")
def g12(t):
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    before, after = t.events.where(F.col("ts") < cut), t.events.where(F.col("ts") >= cut)
    attrs = ["event_id", "event_type"]
    history = snapshot.to_intervals(before, "user_id", ORDER, attrs)
    open_rows = history.where(F.col("valid_to").isNull())
    done, still = snapshot.merge_intervals(open_rows, after, "user_id", ORDER, ["event_type"])
    both = done.withColumn("is_open", F.lit(0)).unionByName(still.withColumn("is_open", F.lit(1)))
    return both.withColumns({"valid_from": iso_time("valid_from"), "valid_to": iso_time("valid_to")})


@query("g12_stored_intervals", """WITH iv AS (
  SELECT user_id, event_id, event_type, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events)
SELECT user_id, event_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_open
FROM iv""")
def g12_stored(t):
    """Closed and open partitions kept over three batches of events, then read back."""
    path, attrs = scratch_path(t.spark, "intervals"), ["event_id", "event_type"]
    cuts = [F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in ("11", "21")]
    history = snapshot.to_intervals(t.events.where(F.col("ts") < cuts[0]), "user_id", ORDER, attrs)
    still = history.where(F.col("valid_to").isNull())
    snapshot.write_intervals(history.where(F.col("valid_to").isNotNull()), still, path, 0)
    parts = [t.events.where((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])), t.events.where(F.col("ts") >= cuts[1])]
    for batch, events in enumerate(parts, 1):
        _, still = snapshot.read_intervals(t.spark, path, batch - 1)
        done, still = snapshot.merge_intervals(still, events, "user_id", ORDER, ["event_type"])
        snapshot.write_intervals(done, still, path, batch)
    closed, still = snapshot.read_intervals(t.spark, path, 2)
    both = closed.withColumn("is_open", F.lit(0)).unionByName(still.withColumn("is_open", F.lit(1)))
    return both.withColumns({"valid_from": iso_time("valid_from"), "valid_to": iso_time("valid_to")})


SQL_BUCKETS = """known AS (
  SELECT user_id, date_trunc('day', ts) AS bucket, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS v
  FROM events GROUP BY 1, 2),
grid AS (SELECT user_id, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS bucket
         FROM (SELECT DISTINCT user_id FROM events)),
filled AS (SELECT grid.user_id, grid.bucket, known.v FROM grid LEFT JOIN known
           ON grid.user_id = known.user_id AND grid.bucket = known.bucket)"""


def _filled(t, **how):
    lo = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    value = F.sum(F.col("value").cast("decimal(12,2)")).cast("double")
    out = gapfill.fill_buckets(t.events, "ts", "1 day", lo, hi, ["user_id"], value, **how)
    return out.withColumn("bucket", iso_day("bucket"))


@query("g13_fill_buckets", f"""WITH {SQL_BUCKETS}
SELECT user_id, strftime(bucket, '%Y-%m-%d') AS bucket, v AS value FROM filled""")
def g13(t):
    return _filled(t)


@query("g14_fill_previous", f"""WITH {SQL_BUCKETS}
SELECT user_id, strftime(bucket, '%Y-%m-%d') AS bucket,
       last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bucket) AS value FROM filled""")
def g14(t):
    return _filled(t, fill="previous")


@query("g15_fill_linear", f"""WITH {SQL_BUCKETS},
pts AS (SELECT user_id, bucket, v,
  last_value(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER b AS pt,
  last_value(v IGNORE NULLS) OVER b AS pv,
  first_value(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER a AS nt,
  first_value(v IGNORE NULLS) OVER a AS nv
  FROM filled WINDOW b AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     a AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, strftime(bucket, '%Y-%m-%d') AS bucket,
       round(coalesce(v, pv + (nv - pv) * date_diff('day', pt, bucket) / date_diff('day', pt, nt)), 6) AS value
FROM pts""")
def g15(t):
    return _filled(t, fill="linear").withColumn("value", F.round("value", 6))


@query("g16_fill_cumulative", f"""WITH {SQL_BUCKETS}
SELECT user_id, strftime(bucket, '%Y-%m-%d') AS bucket, v AS value,
       round(sum(coalesce(v, 0)) OVER (PARTITION BY user_id ORDER BY bucket), 2) AS cumulative FROM filled""")
def g16(t):
    return _filled(t, cumulative=True).withColumn("cumulative", F.round("cumulative", 2))
