"""The same functions on bounded and unbounded input, and restartable sinks."""

import pytest
from pyspark.sql import functions as F

from olapflow.operators import window
from olapflow.sources import messages
from olapflow.streaming import batches, stateful, windows
from tests.helpers import rows

EVENTS = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in four files that arrive in time order."""
    folder = str(tmp_path_factory.mktemp("parts") / "events")
    events = spark.read.parquet(f"{EVENTS}/events.parquet")
    quarter = F.expr("ntile(4) over (order by ts, event_id)")
    for i in range(1, 5):
        events.withColumn("q", quarter).where(F.col("q") == i).drop("q").coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return batches.read_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet")


def test_tumbling_parity(spark, parts):
    def plan(df):
        timed = windows.with_event_time(df, "ts", "1 hour")
        return windows.tumbling(timed, "event_time", "1 hour", ["event_type"], [F.count("*").alias("n")], bounds="millis")

    batch = plan(spark.read.parquet(parts))
    assert rows(plan_drained(plan, spark, parts), *batch.columns) == rows(batch)


def plan_drained(plan, spark, parts):
    return batches.drain(plan(stream(spark, parts)), "complete", "parity")


def test_session_parity(spark, parts):
    def plan(df):
        timed = windows.with_event_time(df, "ts", "1 hour")
        return windows.session(timed, "event_time", "8 hours", ["user_id"], [F.count("*").alias("n")])

    assert rows(plan_drained(plan, spark, parts)) == rows(plan(spark.read.parquet(parts)))


def test_running_total_over_batches(spark, parts, tmp_path):
    value = F.col("value").cast("decimal(12,2)")
    write = stateful.running_total_writer(["user_id"], ["ts", "event_id"], value, "decimal(28,2)", str(tmp_path))
    batches.for_each_batch(stream(spark, parts), write, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "rows"))
    want = window.running_sum(spark.read.parquet(parts), ["user_id"], ["ts", "event_id"], value)
    assert got.select("batch").distinct().count() == 4
    assert rows(got, "event_id", "running") == rows(want, "event_id", "running")


def test_count_windows_span_batches(spark, parts):
    out = batches.drain(stateful.count_window_stream(stream(spark, parts), ["user_id"], "value", 5), "append", "cw")
    per_user = spark.read.parquet(parts).groupBy("user_id").agg(F.expr("count(*) div 5").alias("w")).where("w > 0")
    assert rows(out.groupBy("user_id").agg(F.count("*"))) == rows(per_user)
    assert out.where("n <> 5").isEmpty()


def test_micro_batch_summaries(spark, parts, tmp_path):
    write = batches.batch_summary_writer(str(tmp_path / "out"), [F.count("*").alias("n")])
    batches.for_each_batch(stream(spark, parts), write, str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 4 and out.agg(F.sum("n")).first()[0] == spark.read.parquet(parts).count()


def test_files_are_ingested_once(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "id int, name string"

    def run():
        batches.ingest_new_files(spark, folder, schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")), "id", "name")

    spark.createDataFrame([(1, "a")], schema).coalesce(1).write.option("header", True).csv(folder)
    assert run() == [(1, "a")]
    spark.createDataFrame([(2, "b")], schema).coalesce(1).write.mode("append").option("header", True).csv(folder)
    assert run() == [(1, "a"), (2, "b")]
    assert run() == [(1, "a"), (2, "b")]


def test_late_rows_compare_with_earlier_arrivals_only(spark):
    data = [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 12:00:00"), (3, "2024-01-01 11:30:00"), (4, "2024-01-01 10:30:00")]
    df = spark.createDataFrame(data, "seq int, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    out = window.late_rows(df, "seq", "ts", "1 HOUR", F.expr("seq div 2"))
    assert rows(out, "seq") == [(4,)]


def test_topic_patterns(spark):
    df = spark.createDataFrame([("a/b/c",), ("a/b",), ("a",), ("a/x/c/d",), ("b.c",)], "topic string")
    assert rows(windows.topic_match(df, "a/#")) == [("a",), ("a/b",), ("a/b/c",), ("a/x/c/d",)]
    assert rows(windows.topic_match(df, "a/+/c")) == [("a/b/c",)]
    assert windows.topic_match(df, "#").count() == 5 and windows.topic_match(df, "b+c").count() == 0


def test_tweets_without_a_time_are_dropped(spark):
    docs = [('{"id": 1, "created_at": "Sun Sep 18 10:09:34 +0000 2016", "user": {"name": "x"}}',), ('{"delete": {"id": 2}}',)]
    df = spark.createDataFrame(docs, "value string")
    out = windows.parse_events(df, "value", "id bigint, created_at string, user struct<name:string>", ["created_at"])
    assert rows(out.select("id", "user.name")) == [(1, "x")]


def test_documents_and_rejects(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, s string")
    messages.document_writer(str(tmp_path), "idx", "id")(df, 0)
    assert rows(spark.read.parquet(str(tmp_path / "documents")), "index", "id", "document") == [("idx", "1", '{"id":1,"s":"a"}')]
    assert rows(spark.read.parquet(str(tmp_path / "rejected")), "s", "reason") == [("b", "no id")]


def test_cache_limits(spark):
    df = spark.range(10).select("id", F.timestamp_seconds(F.col("id")).alias("ts"))
    assert rows(batches.cache_query(df, "id", "ts", last=2), "id") == [(8,), (9,)]
    assert rows(batches.cache_query(df, "id", "ts", last_period_ms=1500), "id") == [(8,), (9,)]
    assert rows(batches.cache_query(df, "id", "ts", from_id=3, to_id=8, max_new=2), "id") == [(3,), (4,)]


# ---------------------------------------------------------------- state over several batches

def fed(spark, tmp_path, batches_of_rows, schema):
    """A stream of one batch per list of rows."""
    folder = str(tmp_path / "fed")
    for part in batches_of_rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    df = batches.read_stream(spark, folder, schema)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c in ("at", "made")})


def test_late_rows_are_an_output(spark, tmp_path):
    parts = [
        [("a", 1, "2024-01-01 10:00:00", "2024-01-01 10:00:00"), ("b", 2, "2024-01-01 10:00:00", "2024-01-01 05:00:00")],
        [("a", 3, "2024-01-01 11:00:00", "2024-01-01 08:59:59"), ("a", 4, "2024-01-01 11:00:00", "2024-01-01 09:00:00"),
         ("a", 5, "2024-01-01 11:00:00", "2024-01-01 12:00:00"), ("b", 6, "2024-01-01 11:00:00", "2024-01-01 04:30:00"), ("b", 7, "2024-01-01 11:00:00", None)],
        [("a", 8, "2024-01-01 12:00:00", "2024-01-01 10:59:00"), ("c", 9, "2024-01-01 12:00:00", "2023-01-01 00:00:00")],
    ]
    stream = fed(spark, tmp_path, parts, "k string, id int, at string, made string")
    out = batches.drain(stateful.late_rows_stream(stream, ["k"], "made", 3_600_000), "append", "late")
    assert out.count() == 9
    assert rows(out.where("late"), "id", "behind_ms") == [(3, 3_601_000), (8, 3_660_000)]


def test_silent_keys_are_forgotten(spark, tmp_path):
    parts = [
        [("a", 1, "2024-01-01 00:00:00", "2024-01-01 00:00:00")],
        [("b", 2, "2024-01-03 00:00:00", "2024-01-03 00:00:00")],
        [("b", 3, "2024-01-04 00:00:00", "2024-01-04 00:00:00")],
        [("a", 4, "2024-01-04 00:00:01", "2023-12-30 00:00:00"), ("b", 5, "2024-01-04 00:00:01", "2024-01-01 00:00:00")],
    ]
    stream = fed(spark, tmp_path, parts, "k string, id int, at string, made string").withWatermark("at", "1 minute")
    out = batches.drain(stateful.late_rows_stream(stream, ["k"], "made", 1000, keep_ms=3_600_000), "append", "late")
    assert rows(out.where("late"), "id") == [(5,)]


def test_totals_follow_event_time(spark, tmp_path):
    t = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    parts = [
        [("a", 1, t(10), 1.5), ("a", 2, t(5), 2.0), ("b", 3, t(7), None)],
        [("a", 4, t(30), 4.0), ("a", 5, t(8), 8.25), ("b", 6, t(30), 1.0)],  # 5 comes after 1, but before it in time
        [("a", 7, t(60), 16.0), ("a", 8, t(29), 32.0)],
        [("a", 10, t(300), 1.0), ("a", 9, t(2), 64.0)],  # 9 is beyond the watermark of the batch before
    ]
    stream = fed(spark, tmp_path, parts, "k string, id int, at string, v double").withWatermark("at", "20 minutes")
    out = batches.drain(stateful.running_total_stream(stream, ["k"], "at", ["at", "id"], F.col("v")), "append", "totals")
    got = {r.id: float(r.running) for r in out.collect()}
    assert got == {2: 2.0, 5: 10.25, 1: 11.75, 8: 43.75, 4: 47.75, 7: 63.75, 3: 0.0, 6: 1.0}
    assert out.columns == ["k", "id", "at", "v", "running"]


def test_caches_hold_the_newest_rows(spark, parts):
    events = spark.read.parquet(parts)
    for bounds, want in (
        ({"rows": 30}, events.orderBy(F.col("event_id").desc()).limit(30)),
        ({"period_ms": 5 * 86_400_000}, events.where(F.col("ts") > events.agg(F.max("ts")).scalar() - F.expr("INTERVAL 5 DAYS"))),
    ):
        versions = batches.drain(stateful.cache_stream(stream(spark, parts), "event_id", "ts", **bounds), "update", "cache")
        kept = stateful.cached(versions)
        assert versions.agg(F.max("version")).first()[0] == 3 and kept.columns == events.columns
        held = {r.event_id for r in kept.collect()}
        assert {r.event_id for r in want.collect()} <= held and len(held) < events.count()
        if "rows" in bounds:
            assert rows(batches.cache_query(kept, "event_id", "ts", last=30), "event_id") == rows(want, "event_id") and len(held) <= 240


def test_count_windows_take_batches_in_order(spark, parts):
    out = batches.drain(stateful.count_window_stream(stream(spark, parts), ["user_id"], "value", 5, ["ts", "event_id"]), "append", "cw")
    events = spark.read.parquet(parts).withColumn("value", F.col("value").cast("decimal(12,2)"))
    want = window.count_window(events, ["user_id"], ["ts", "event_id"], 5, [F.sum("value").cast("double").alias("total")])
    assert rows(out.select("user_id", "window_no", F.round("total", 2))) == rows(want, "user_id", "window_no", "total")


def test_count_windows_of_a_hot_key(spark, parts, tmp_path, monkeypatch):
    """Numbered in ranges, over batches whose sums are folded, also when a batch is repeated."""
    monkeypatch.setattr(window, "CHUNK_ROWS", 60)
    monkeypatch.setattr(stateful._KeySums, "COMPACT", 2)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id"))
    events = spark.read.parquet(parts).select("ts", "event_id", hot.alias("user"), F.col("value").cast("decimal(12,2)").alias("v"))
    write = stateful.count_window_writer(["user"], ["ts", "event_id"], F.col("v"), "decimal(28,2)", 7, str(tmp_path))
    bounds = [0, 150, 151, 400, 640, 10_000]
    ranked = window.row_index(events, [], ["ts", "event_id"], "__r")
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        for _ in range(2 if i in (1, 4) else 1):
            write(ranked.where((F.col("__r") >= lo) & (F.col("__r") < hi)).drop("__r"), i)
    want = window.count_window(events, ["user"], ["ts", "event_id"], 7, [F.sum("v").alias("total")])
    assert rows(stateful.count_windows(spark, str(tmp_path), 7), "user", "window_no", "total") == rows(want, "user", "window_no", "total")


# ---------------------------------------------------------------- many keys in one state

BIG = (1 << 53) + 1  # beyond what a float holds


def test_count_windows_of_many_keys_share_a_state(spark, tmp_path):
    keys = [("a", BIG), ("a", BIG + 1), ("a", None), (None, BIG), (None, None), ("b", 1)]
    parts = [[(*keys[i * 5 % 6], b * 40 + i, float(i % 4)) for i in range(n)] for b, n in enumerate((40, 1, 33))]
    stream = fed(spark, tmp_path, parts, "a string, b bigint, i int, v double")
    out = stateful.count_window_stream(stream, ["a", "b"], "v", 3, ["i"])
    assert "__shard" in out._jdf.queryExecution().analyzed().toString()
    want, seen = [], {}
    for a, b, i, v in sum(parts, []):
        seen.setdefault((a, b), []).append(v)
    for (a, b), vs in seen.items():
        want += [(a, b, w, 3, sum(vs[w * 3 : w * 3 + 3])) for w in range(len(vs) // 3)]
    got = rows(batches.drain(out, "append", "cw"), "a", "b", "window_no", "n", "total")
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_late_rows_of_many_keys_share_a_state(spark, tmp_path):
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    key = lambda i: None if i % 5 == 0 else BIG + i % 5
    parts = [[(key(i), 100 * b + i, at(7 * i % 60 + 60 * (b % 2))) for i in range(20)] for b in range(3)]
    out = stateful.late_rows_stream(fed(spark, tmp_path, parts, "k bigint, id int, made string"), ["k"], "made", 600_000)
    assert "__shard" in out._jdf.queryExecution().analyzed().toString() and out.columns == ["k", "id", "made", "late", "behind_ms"]
    want, high = [], {}
    for part in parts:
        mark = dict(high)
        for k, i, made in part:
            m = int(made[11:13]) * 60 + int(made[14:16])
            behind = max(mark.get(k, m) - m, 0)
            want.append((k, i, behind > 10, behind * 60_000))
            high[k] = max(high.get(k, m), m)
    got = batches.drain(out, "append", "late")
    assert rows(got, "k", "id", "late", "behind_ms") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_totals_of_many_keys_share_a_state(spark, tmp_path):
    """Null and large keys, and totals beyond 64 bits."""
    t = lambda b, i: f"2024-01-0{b + 1} 00:{i:02d}:00"
    key = lambda i: None if i % 3 == 0 else BIG + i % 3
    parts = [[(key(i), 50 * b + i, t(b, (i * 7) % 30), 9e15 if i % 3 == 1 else 1.25) for i in range(30)] for b in range(4)]
    stream = fed(spark, tmp_path, parts, "k bigint, id int, at string, v double").withWatermark("at", "1 minute")
    out = stateful.running_total_stream(stream, ["k"], "at", ["at", "id"], F.col("v"))
    assert "__shard" in out._jdf.queryExecution().analyzed().toString()
    want, total = {}, {}
    for part in parts:
        for k, i, at, v in sorted(part, key=lambda r: (r[2], r[1])):
            total[k] = total.get(k, 0) + round(v * 100)
            want[i] = (k, total[k])
    got = {r.id: (r.k, int(r.running * 100)) for r in batches.drain(out, "append", "totals").collect()}
    assert len(got) >= 110 and all(want[i] == v for i, v in got.items())
    assert max(v for _, v in got.values()) > 1 << 64


def test_a_cache_keeps_batches_and_not_rows(spark, tmp_path):
    """A period is spread over many shards; what is older goes before rows are made."""
    at = lambda b, i: f"2024-01-0{b + 1} {i % 24:02d}:00:00"
    parts = [[(BIG + 100 * b + i, None if i % 4 == 0 else BIG + i, at(b, i)) for i in range(96)] for b in range(3)]
    out = stateful.cache_stream(fed(spark, tmp_path, parts, "id bigint, n bigint, at string"), "id", "at", period_ms=36 * 3_600_000)
    versions = batches.drain(out, "update", "cache")
    assert versions.select("shard").distinct().count() > 8
    kept = batches.cache_query(stateful.cached(versions), "id", "at", last_period_ms=18 * 3_600_000)
    assert rows(kept, "id", "n") == sorted(((i, n) for i, n, when in parts[2] if when > "2024-01-03 05:00:00"), key=lambda t: tuple((v is None, str(v)) for v in t))
