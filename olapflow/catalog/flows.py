"""Windows and streams over the events table, as batch and as stream."""

from pyspark.sql import functions as F

from olapflow.catalog.base import iso_time, money, query, total
from olapflow.operators import runlog, window
from olapflow.session import scratch_path
from olapflow.streaming import batches, stateful, windows

EV = ["ts", "event_id"]
AGGS = "count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total"


def _aggs():
    return [F.count("*").alias("n"), total("value").alias("total")]


def _bounds(df):
    return df.withColumns({"window_start": iso_time("window_start"), "window_end": iso_time("window_end")})


PARTS, FILES = 4, 4
SQL_PART = f"""parts AS (SELECT *, CAST((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {PARTS}
  // ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1) AS INTEGER) AS part FROM events)"""
#: What a stream with an hour's watermark has closed in the end.
SQL_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)"


def _arriving(t, late=None, slip=None):
    """Events as a stream of four batches in time order; rows that ``late`` picks from the
    first quarter come with the last. Rows that ``slip`` picks from the last day of a
    quarter come with the next one."""
    events, path = t.events, scratch_path(t.spark, "arrivals")
    lo, hi = events.agg(F.min("ts")).scalar(), events.agg(F.max("ts")).scalar()
    span = F.timestamp_diff("MICROSECOND", lo, hi) + 1
    part = F.expr("since * {} div span".format(PARTS)).cast("int")
    dealt = events.withColumns({"since": F.timestamp_diff("MICROSECOND", lo, F.col("ts")), "span": span}).withColumn("part", part)
    if late is not None:
        dealt = dealt.withColumn("part", F.when(late & (F.col("part") == 0), PARTS - 1).otherwise(F.col("part")))
    if slip is not None:
        soon = F.least(F.expr(f"(since + 86400000000) * {PARTS} div span").cast("int"), F.lit(PARTS - 1))
        dealt = dealt.withColumn("part", F.when(slip, F.greatest("part", soon)).otherwise(F.col("part")))
    for i in range(PARTS):
        dealt.where(F.col("part") == i).select(*events.columns).repartition(FILES).write.mode("append").parquet(path)
    return batches.read_stream(t.spark, path, events.schema, files_per_batch=FILES)


def _timed_stream(t, late=None):
    return windows.with_event_time(_arriving(t, late), "ts", "1 hour")


SQL_TUMBLING = f"""SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(s + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  event_type, {AGGS} FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS s FROM events) GROUP BY s, event_type"""


@query("t01_tumbling_window", SQL_TUMBLING)
def t01(t):
    return _bounds(windows.tumbling(t.events, "ts", "30 minutes", ["event_type"], _aggs()))


@query("t01_tumbling_window_stream", SQL_TUMBLING.replace("AS s FROM events)", "AS s FROM events)" + f" WHERE s + INTERVAL 30 MINUTE <= {SQL_CLOSED}"))
def t01_stream(t):
    out = windows.tumbling(_timed_stream(t), "event_time", "30 minutes", ["event_type"], _aggs())
    return _bounds(batches.drain(out, "append", "tumbling"))


SQL_SLIDING = f"""SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(s + INTERVAL 45 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  event_type, {AGGS} FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE AS s FROM events, range(3) r(i)) GROUP BY s, event_type"""


@query("t02_sliding_window", SQL_SLIDING)
def t02(t):
    return _bounds(windows.sliding(t.events, "ts", "45 minutes", "15 minutes", ["event_type"], _aggs()))


@query("t02_sliding_window_stream", SQL_SLIDING.replace("range(3) r(i))", "range(3) r(i))" + f" WHERE s + INTERVAL 45 MINUTE <= {SQL_CLOSED}"))
def t02_stream(t):
    out = windows.sliding(_timed_stream(t), "event_time", "45 minutes", "15 minutes", ["event_type"], _aggs())
    return _bounds(batches.drain(out, "append", "sliding"))


@query("t03_count_window", """
SELECT user_id, w AS window_no, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM (
  SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 5 AS w FROM events)
GROUP BY 1, 2 HAVING count(*) = 5""")
def t03(t):
    return window.count_window(t.events, ["user_id"], EV, 5, [total("value").alias("total")])


SQL_COUNTED = """
SELECT user, w AS window_no, CAST(5 AS BIGINT) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM (
  SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user, value,
    (row_number() OVER (PARTITION BY CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END ORDER BY ts, event_id) - 1) // 5 AS w FROM events)
GROUP BY 1, 2 HAVING count(*) = 5"""


def _with_hot_user(events):
    """One user has a third of the records."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    return events.withColumn("user", user)


@query("t03_count_window_stream", SQL_COUNTED)
def t03_stream(t):
    """Windows over four batches, in the state of each user."""
    out = stateful.count_window_stream(_with_hot_user(_arriving(t)), ["user"], "value", 5, EV)
    out = batches.drain(out, "append", "count-window")
    return out.withColumn("total", F.round("total", 2))


@query("t03_count_window_stream_hot_key", SQL_COUNTED)
def t03_hot(t):
    """The same windows in two steps, the large user's records numbered by many tasks."""
    path = scratch_path(t.spark, "count-windows")
    write = stateful.count_window_writer(["user"], EV, money("value"), "decimal(28,2)", 5, path)
    batches.for_each_batch(_with_hot_user(_arriving(t)), write, f"{path}/checkpoint").awaitTermination()
    return stateful.count_windows(t.spark, path, 5).withColumn("total", F.col("total").cast("double"))


SQL_SESSION = f"""SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  user_id, {AGGS} FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
      SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s"""


@query("t04_session_window", SQL_SESSION)
def t04(t):
    return _bounds(windows.session(t.events, "ts", "6 hours", ["user_id"], _aggs()))


@query("t04_session_window_stream", SQL_SESSION + f" HAVING max(ts) + INTERVAL 6 HOUR <= {SQL_CLOSED}")
def t04_stream(t):
    out = windows.session(_timed_stream(t), "event_time", "6 hours", ["user_id"], _aggs())
    return _bounds(batches.drain(out, "append", "session"))


@query("t05_global_window", f"SELECT event_type, {AGGS} FROM events GROUP BY 1")
def t05(t):
    return windows.global_window(t.events, ["event_type"], _aggs())


@query("t05_global_window_stream", f"SELECT event_type, {AGGS} FROM events GROUP BY 1")
def t05_stream(t):
    out = windows.global_window(_arriving(t), ["event_type"], _aggs())
    return batches.drain(out, "complete", "global")


@query("t06_event_time_stream", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM events")
def t06(t):
    out = _timed_stream(t).select("event_id", "event_time")
    return batches.drain(out, "append", "event-time").withColumn("event_time", iso_time("event_time"))


@query("t07_watermark_closed_windows", f"""WITH w AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts) AS s, event_type, {AGGS} FROM events GROUP BY 1, 2)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type, n, total FROM w
WHERE s + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM events)""")
def t07(t):
    stream = windows.with_event_time(_arriving(t), "ts", "0 seconds")
    out = windows.tumbling(stream, "event_time", "1 day", ["event_type"], _aggs())
    closed = batches.drain(out, "append", "closed-windows").drop("window_end")
    return closed.withColumn("window_start", iso_time("window_start"))


@query("t07_late_rows_dropped", f"""WITH {SQL_PART}
SELECT strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type, {AGGS}
FROM parts WHERE NOT (part = 0 AND event_id % 5 = 0) AND time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE <= {SQL_CLOSED} GROUP BY 1, 2""")
def t07_late(t):
    """Rows that come after their windows are closed change nothing."""
    out = windows.tumbling(_timed_stream(t, F.col("event_id") % 5 == 0), "event_time", "30 minutes", ["event_type"], _aggs())
    return batches.drain(out, "append", "late-rows").drop("window_end").withColumn("window_start", iso_time("window_start"))


@query("t08_late_rows", """
WITH d AS (SELECT event_id, ts - to_seconds(CAST(round(value * 60) AS BIGINT)) AS made_at FROM events)
SELECT event_id, strftime(made_at, '%Y-%m-%d %H:%M:%S.%f') AS made_at FROM (
  SELECT *, max(made_at) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM d)
WHERE made_at < seen - INTERVAL 2 HOUR""")
def t08(t):
    """Events made some time before they arrive; the event id is the arrival order."""
    behind = -F.round(F.col("value") * 60).cast("int")
    arrivals = t.events.select("event_id", F.timestamp_add("SECOND", behind, F.col("ts")).alias("made_at"))
    out = window.late_rows(arrivals, "event_id", "made_at", "2 HOURS")
    return out.select("event_id", iso_time("made_at").alias("made_at"))


@query("t08_late_rows_stream", f"""WITH {SQL_PART},
d AS (SELECT *, ts - to_seconds(CAST(round(value * 3600) AS BIGINT)) AS made_at FROM parts),
m AS (SELECT user_id, part, max(made_at) AS high FROM d GROUP BY 1, 2),
s AS (SELECT d.event_id, d.made_at, max(m.high) AS seen FROM d JOIN m ON m.user_id = d.user_id AND m.part < d.part GROUP BY 1, 2)
SELECT event_id, strftime(made_at, '%Y-%m-%d %H:%M:%S.%f') AS made_at, epoch_us(seen - made_at) // 1000 AS behind_ms
FROM s WHERE made_at < seen - INTERVAL 24 HOUR""")
def t08_stream(t):
    """Late records of each user as an output of their own, over four batches."""
    behind = -F.round(F.col("value") * 3600).cast("int")
    arrivals = _timed_stream(t).withColumn("made_at", F.timestamp_add("SECOND", behind, F.col("ts")))
    out = stateful.late_rows_stream(
        arrivals.select("event_id", "user_id", "event_time", "made_at"), ["user_id"], "made_at", 24 * 3_600_000, keep_ms=90 * 86_400_000
    )
    late = batches.drain(out, "append", "late-rows").where("late")
    return late.select("event_id", iso_time("made_at").alias("made_at"), "behind_ms")


@query("t09_ingest_time_window_stream", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t09(t):
    stream = windows.with_ingest_time(_arriving(t)).withWatermark("ingest_time", "0 seconds")
    out = windows.tumbling(stream, "ingest_time", "1 hour", ["event_type"], [F.count("*").alias("n")])
    return batches.drain(out, "complete", "ingest-time").groupBy("event_type").agg(F.sum("n").alias("n"))


@query("t10_window_bounds_in_millis", """
SELECT epoch_ms(s) AS window_start, epoch_ms(s) + 30000 AS window_end, event_type, count(*) AS n
FROM (SELECT event_type, time_bucket(INTERVAL 30 SECOND, ts) AS s FROM events) GROUP BY s, event_type""")
def t10(t):
    return windows.tumbling(t.events, "ts", "30 seconds", ["event_type"], [F.count("*").alias("n")], bounds="millis")


SQL_RUNNING = """SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS running FROM events"""


@query("t11_running_total", SQL_RUNNING)
def t11(t):
    out = window.running_sum(t.events, ["user_id"], EV, money("value"))
    return out.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query("t11_running_total_writer", SQL_RUNNING)
def t11_writer(t):
    path = scratch_path(t.spark, "running-total")
    write = stateful.running_total_writer(["user_id"], EV, money("value"), "decimal(28,2)", path)
    batches.for_each_batch(_arriving(t), write, f"{path}/checkpoint").awaitTermination()
    rows = t.spark.read.parquet(f"{path}/rows")
    return rows.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query("t11_running_total_stream", f"""SELECT * FROM ({SQL_RUNNING}) WHERE event_id IN (
  SELECT event_id FROM events WHERE ts <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events))""")
def t11_stream(t):
    """Totals in time order though one record in five of a quarter's last day comes a batch late."""
    fed = windows.with_event_time(_arriving(t, slip=F.col("event_id") % 5 == 0), "ts", "2 days")
    fed = fed.select("event_id", "user_id", "event_time", "value")
    out = stateful.running_total_stream(fed, ["user_id"], "event_time", ["event_time", "event_id"], money("value"))
    out = batches.drain(out, "append", "running-total")
    return out.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query("t12_parse_events", """
SELECT event_id, k FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events) WHERE k IS NOT NULL""")
def t12(t):
    gaps = F.when(F.col("event_type") == "error", F.lit('{"delete": 1}')).otherwise(F.col("props"))
    return windows.parse_events(t.events.withColumn("doc", gaps), "doc", "k bigint", ["k"], keep=["event_id"])


@query("t13_micro_batches", f"WITH {SQL_PART} SELECT count(*) AS n, count(DISTINCT part) AS batches FROM parts")
def t13(t):
    path = scratch_path(t.spark, "micro-batches")
    write = batches.batch_summary_writer(f"{path}/out", [F.count("*").alias("n")])
    batches.for_each_batch(_arriving(t), write, f"{path}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{path}/out").agg(F.sum("n").alias("n"), F.count_distinct("batch_id").alias("batches"))


@query("t14_aggregate_per_batch", f"WITH {SQL_PART} SELECT count(*) AS n, max(value) AS highest, part AS batch_id FROM parts GROUP BY part")
def t14(t):
    path = scratch_path(t.spark, "batch-aggregates")
    write = batches.batch_summary_writer(f"{path}/out", [F.count("*").alias("n"), F.max("value").alias("highest")])
    batches.for_each_batch(_arriving(t), write, f"{path}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{path}/out").select("n", "highest", "batch_id")


@query("t15_topic_wildcards", """
SELECT event_id, topic FROM (SELECT event_id, 'site/' || user_id % 7 || '/' || event_type || '/raw' AS topic FROM events)
WHERE regexp_matches(topic, '^site/[^/]*/click(/.*)?$')""")
def t15(t):
    parts = [F.lit("site"), (F.col("user_id") % 7).cast("string"), F.col("event_type"), F.lit("raw")]
    topics = t.events.select("event_id", F.concat_ws("/", *parts).alias("topic"))
    return windows.topic_match(topics, "site/+/click/#")


def _cached(t, **bounds):
    """What a cache holds after four batches of the stream."""
    fed = _arriving(t).select("event_id", "user_id", "ts")
    return stateful.cached(batches.drain(stateful.cache_stream(fed, "event_id", "ts", **bounds), "update", "cache"))


@query("t16_cache_last_rows", "SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 50")
def t16(t):
    return batches.cache_query(_cached(t, rows=200), "event_id", "ts", last=50).select("event_id", "user_id")


@query("t16_cache_last_period", """
SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 36 HOUR""")
def t16_period(t):
    out = batches.cache_query(_cached(t, period_ms=48 * 3_600_000), "event_id", "ts", last_period_ms=36 * 3_600_000)
    return out.select("event_id", "user_id")


@query("t16_cache_id_range_max_new", """
SELECT event_id, user_id FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 9000)
WHERE event_id >= 900 AND event_id <= 1900 ORDER BY event_id LIMIT 200""")
def t16_range(t):
    """Ids that are still in the cache, from 900 on, at most 200 of them."""
    kept = batches.cache_query(_cached(t, rows=9_000), "event_id", "ts", last=9_000)
    return batches.cache_query(kept, "event_id", "ts", from_id=900, to_id=1_900, max_new=200).select("event_id", "user_id")


@query("t17_sql_over_stream", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS day, event_type, count(*) AS n, max(value) AS highest
FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {SQL_CLOSED} GROUP BY 1, 2""")
def t17(t):
    batches.stream_view(_timed_stream(t), "live_events")
    out = t.spark.sql(
        "SELECT window.start AS day, event_type, count(*) AS n, max(value) AS highest FROM live_events "
        "GROUP BY window(event_time, '1 day'), event_type"
    )
    return batches.drain(out, "append", "sql").withColumn("day", iso_time("day"))


@query("t18_windowed_files", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d-%H-%M-%S') AS window_start, count(*) AS n FROM events GROUP BY 1""")
def t18(t):
    path = scratch_path(t.spark, "windowed-files")
    batches.write_windowed(_arriving(t), "ts", "1 day", f"{path}/out", f"{path}/checkpoint").awaitTermination()
    files = t.spark.read.schema("event_id bigint, window_start string").parquet(f"{path}/out")
    return files.groupBy("window_start").agg(F.count("*").alias("n"))


def _one_definition(df):
    """A pipeline that does not know whether its input ends."""
    timed = windows.with_event_time(df, "ts", "1 hour")
    parsed = timed.withColumn("k", F.from_json("props", "k int").getField("k")).where("k >= 50")
    return windows.tumbling(parsed, "event_time", "6 hours", ["event_type"], [F.count("*").alias("n"), F.max("k").alias("k")])


SQL_BOTH = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(s + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  event_type, count(*) AS n, max(k) AS k FROM (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS s, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
WHERE k >= 50 GROUP BY s, event_type"""


@query("t19_one_definition_bounded", SQL_BOTH)
def t19(t):
    return _bounds(_one_definition(t.events))


@query("t19_one_definition_unbounded", SQL_BOTH.replace("GROUP BY s, event_type", f"AND s + INTERVAL 6 HOUR <= {SQL_CLOSED} GROUP BY s, event_type"))
def t19_stream(t):
    """The same definition on four batches, each window put out once it is closed."""
    return _bounds(batches.drain(_one_definition(_arriving(t)), "append", "one-definition"))


# ---------------------------------------------------------------- run logs

SQL_RUNS = """runs AS (SELECT user_id, event_id, CASE WHEN value > 50 THEN 'large load' ELSE 'small load' END AS process_name, CASE WHEN event_type = 'signup' THEN 'running' ELSE event_type END AS status, ts,
  lead(CASE WHEN event_type = 'signup' THEN 'running' ELSE event_type END) OVER w AS nxt, lead(ts) OVER w AS ended
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def _runs(t):
    status = F.when(F.col("event_type") == "signup", F.lit("running")).otherwise(F.col("event_type"))
    name = F.when(F.col("value") > 50, "large load").otherwise("small load")
    log = t.events.select("user_id", "event_id", "ts", name.alias("process_name"), status.alias("status"))
    return runlog.run_log_view(log, "user_id", EV)


@query("w05_run_log_view", f"""WITH {SQL_RUNS}
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start_time, coalesce(nxt, 'running') AS status,
       strftime(ended, '%Y-%m-%d %H:%M:%S.%f') AS end_time, (epoch_us(ended) - epoch_us(ts)) // 1000000 AS duration
FROM runs WHERE status = 'running'""")
def w05(t):
    out = _runs(t).drop("process_name")
    return out.withColumns({"start_time": iso_time("start_time"), "end_time": iso_time("end_time")})


@query("w06_count_running", f"""WITH {SQL_RUNS}
SELECT count(*) AS running FROM runs WHERE status = 'running' AND coalesce(nxt, 'running') = 'running' AND process_name = 'large load'""")
def w06(t):
    return runlog.count_running(_runs(t), "large load")


@query("u10_run_log_write", """
SELECT 'load ' || r_name AS process_name, CASE WHEN r_regionkey = 4 THEN 'running' ELSE 'finished' END AS status FROM region""")
def u10(t):
    """One run per region: written status by status, then read back as current state."""
    path = scratch_path(t.spark, "run-log")
    for status in ("running", "finished"):
        for region in t.region.orderBy("r_regionkey").toLocalIterator():  # one run each
            if status == "running" or region.r_regionkey != 4:
                runlog.log_event(t.spark, path, str(region.r_regionkey), f"load {region.r_name}", status)
    return runlog.run_log_view(runlog.read_log(t.spark, path)).select("process_name", "status")
