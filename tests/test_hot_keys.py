"""Chunked operators against plain Python, with one key that owns most rows."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from olapflow.operators import agg, join, shape, udf, window
from olapflow.plans import bridge, gapfill, snapshot
from tests.helpers import day, days, rows


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    out = []
    for i in range(900):
        key = 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, None])
        out.append((key, rng.randrange(60), i, rng.choice("abc"), rng.randrange(-5, 6)))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "k int, t int, i int, s string, v int").repartition(6)


def by_key(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in groups.items()}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours(frame, data, width):
    chunk = F.expr(f"t div {width}")
    want_next, want_prev = {}, {}
    for group in by_key(data).values():
        for a, b in zip(group, group[1:]):
            want_next[a[2]], want_prev[b[2]] = b[3], a[3]
    ahead = window.next_value(frame, ["k"], ["t", "i"], {"n": "s"}, chunk)
    back = window.previous_value(frame, ["k"], ["t", "i"], {"p": "s"}, chunk)
    assert {r.i: r.n for r in ahead.collect()} == {r[2]: want_next.get(r[2]) for r in data}
    assert {r.i: r.p for r in back.collect()} == {r[2]: want_prev.get(r[2]) for r in data}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours_of_the_order_column_itself(frame, data, width):
    chunk = F.expr(f"t div {width}")
    want_next, want_prev = {}, {}
    for group in by_key(data).values():
        for a, b in zip(group, group[1:]):
            want_next[a[2]], want_prev[b[2]] = b[1], a[1]
    ahead = window.next_value(frame, ["k"], ["t", "i"], {"n": "t"}, chunk)
    back = window.previous_value(frame, ["k"], ["t", "i"], {"p": "t"}, chunk)
    assert {r.i: r.n for r in ahead.collect()} == {r[2]: want_next.get(r[2]) for r in data}
    assert {r.i: r.p for r in back.collect()} == {r[2]: want_prev.get(r[2]) for r in data}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_values(frame, data, width):
    chunk = F.expr(f"t div {width}")
    sums, highs, index = {}, {}, {}
    for group in by_key(data).values():
        total, high = 0, None
        for n, r in enumerate(group):
            index[r[2]], highs[r[2]] = n, high
            total += r[4]
            high = r[4] if high is None else max(high, r[4])
            sums[r[2]] = total
    out = window.running_sum(frame, ["k"], ["t", "i"], "v", chunk=chunk)
    assert {r.i: r.running for r in out.collect()} == sums
    out = window.running(frame, ["k"], ["t", "i"], F.col("v"), "m", "max", chunk, before=True)
    assert {r.i: r.m for r in out.collect()} == highs
    out = window.row_index(frame, ["k"], ["t", "i"], chunk=chunk)
    assert {r.i: r.row_index for r in out.collect()} == index


def test_count_windows_and_latest(frame, data):
    out = window.count_window(frame, ["k"], ["t", "i"], 7, [F.sum("v").alias("v")], F.expr("t div 5"))
    want = []
    for k, group in by_key(data).items():
        for w in range(len(group) // 7):
            want.append((k, w, sum(r[4] for r in group[w * 7 : w * 7 + 7])))
    assert rows(out, "k", "window_no", "v") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    latest = window.latest_per_key(frame, ["k"], ["t", "i"])
    assert {r.k: r.i for r in latest.collect()} == {k: g[-1][2] for k, g in by_key(data).items()}


def test_per_group_blocks_cover_every_row_once(frame, data):
    def ids(pdf):
        assert len(pdf) <= 50 and pdf[["t", "i"]].apply(tuple, axis=1).is_monotonic_increasing
        return pdf[["i", "block_no"]]

    out = udf.per_group(frame, ["k"], ["t", "i"], ids, "i int, block_no bigint", block=50, chunk=F.expr("t div 5"))
    assert sorted(r.i for r in out.collect()) == list(range(900))


def test_counts_without_multiplying_rows(frame, data):
    start = F.lit("2024-01-01").cast("date")
    events = frame.where("k is not null").select("k", F.date_add(start, F.col("t")).alias("day"))
    got = snapshot.snapshot_counts(events, "k", "day", day("2024-03-15"))
    spans = snapshot.to_intervals(frame.where("k is not null").withColumn("day", F.date_add(start, F.col("t"))), "k", ["day", "i"], [], day("2024-03-15"))
    want = snapshot.explode_snapshot(spans, "valid_from", "valid_to").groupBy("day").agg(F.count("*").alias("n"))
    assert rows(days(got, "day"), "day", "n") == rows(days(want, "day"), "day", "n")


def test_one_popular_set(spark):
    """A third of all records share one item set; another record holds a superset."""
    records = [(r, i) for r in range(60) for i in ((1, 2, 3) if r % 3 == 0 else (r, r + 100))]
    records += [(999, i) for i in (1, 2, 3, 4)]
    pairs = spark.createDataFrame(records, "r bigint, item bigint")
    out = bridge.match_groups(pairs.withColumnRenamed("r", "g"), "g", "item", pairs, "r")
    want = {r: 0 if r % 3 == 0 else r for r in range(60)} | {999: 999}
    assert {x.r: x.matched_group for x in out.collect()} == want


def test_one_parent_with_most_children(spark):
    child = spark.createDataFrame([(1, i) for i in range(95)] + [(2, 7)], "p int, c int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    out = join.nest_children(parent, child, "p", ["c"], ["c"], "kids", block=10, chunk=F.expr("c div 8"))
    parts = out.where("p = 1").orderBy("part").collect()
    assert len(parts) == 10 and max(len(r.kids) for r in parts) == 10
    assert [k.c for r in parts for k in r.kids] == list(range(95))


def test_all_tied_winners_are_kept(spark):
    df = spark.createDataFrame([(1, i, 5) for i in range(50)] + [(1, 99, 4), (2, 1, 1)], "g int, i int, m int")
    assert join.winners(df, ["g"], "m").count() == 51
    assert agg.top_per_group(df, ["g"], "m", 3, ["i"]).count() == 4


@pytest.mark.parametrize("kind", ["url", "hash", "time", "day"])
def test_chunks_come_from_the_data(spark, monkeypatch, kind):
    monkeypatch.setattr(window, "CHUNK_ROWS", 40)
    value = {
        "url": "concat('https://example.org/', lpad(cast(id * 7919 % 1000 as string), 4, '0'))",
        "hash": "xxhash64(id)",
        "time": "cast('2024-01-01 00:00:00' as timestamp_ntz) + make_dt_interval(0, 0, 0, id * 7919 % 1000)",
        "day": "date_add(date'2024-01-01', cast(id * 7919 % 1000 as int))",
    }[kind]
    # a third of the rows under one key, the rest under many small ones and null
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 50 = 1 THEN NULL ELSE id % 100 END AS k", f"{value} AS o", "id AS v")
    for keys in (["k"], []):
        chunked = window._chunked(df, keys, ["o"], None)
        sizes = [r["count"] for r in chunked.groupBy(*keys, window._CHUNK).count().collect()]
        assert max(sizes) <= 80 and (len(sizes) < 160)
        got = {r.v: (r.running, r.row_index) for r in window.row_index(window.running_sum(df, keys, ["o"], "v"), keys, ["o"]).collect()}
        want, groups = {}, {}
        for r in sorted(df.collect(), key=lambda r: r.o):
            groups.setdefault(r.k if keys else 0, []).append(r)
        for group in groups.values():
            total = 0
            for n, r in enumerate(group):
                total += r.v
                want[r.v] = (total, n)
        assert got == want
        after = {a.v: b.v for group in groups.values() for a, b in zip(group, group[1:])}
        assert {r.v: r.n for r in window.next_value(df, keys, ["o"], {"n": "v"}).collect()} == {v: after.get(v) for v in want}


def test_small_keys_are_plain_windows(frame):
    out = window.next_value(frame, ["k"], ["t", "i"], {"n": "s"})
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_are_called_from_arrow_batches(spark):
    """Blocks across batches, null keys, large numbers beside nulls; no exchange of Python per block."""
    import pandas as pd

    big = (1 << 53) + 1
    df = spark.range(2_500).selectExpr(
        "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS k", "id AS i", f"CASE WHEN id = 11 THEN NULL ELSE {big} + id END AS v", "CASE WHEN id <> 11 THEN id > 5 END AS b"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        def ends(g):
            kinds = f"{g.v.dtype},{g.b.dtype}"
            return pd.DataFrame({"n": [len(g)], "first": [g.i.iloc[0]], "last": [g.i.iloc[-1]], "v": [None if g.v.hasnans else g.v.iloc[-1]], "kinds": [kinds]})

        out = udf.per_group(df, ["k"], ["i"], ends, "n long, first long, last long, v long, kinds string", block=30)
        got = sorted(tuple(r) for r in out.select("n", "first", "last", "v", "kinds").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for k in (None, 0, 1, 2):
        ids = [i for i in range(2_500) if (None if i % 7 == 0 else i % 3) == k]
        for a in range(0, len(ids), 30):
            own = ids[a : a + 30]
            want.append((len(own), own[0], own[-1], None if 11 in own else big + own[-1], "float64,object" if 11 in own else "int64,bool"))
    assert got == sorted(want)
    assert "MapInPandas" in out._jdf.queryExecution().executedPlan().toString()


def test_functions_see_whole_groups(spark):
    import pandas as pd

    df = spark.range(25_000).selectExpr("0 AS k", "25000 - id AS i")
    out = udf.per_group(df, ["k"], ["i"], lambda g: pd.DataFrame({"n": [len(g)], "first": [g.i.iloc[0]]}), "n long, first long")
    assert tuple(out.first()) == (25_000, 1)


def test_a_parent_of_many_children_is_one_document(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    child = spark.range(25_003).selectExpr("CASE WHEN id < 25000 THEN 1 ELSE 2 END AS p", "id AS c")
    nested = join.nest_children(parent, child, "p", ["c"], ["c"], "kids")
    parts = sorted((r.p, r.part, len(r.kids), r.is_last) for r in nested.collect())
    assert parts == [(1, 0, 10_000, False), (1, 1, 10_000, False), (1, 2, 5_000, True), (2, 0, 3, True), (3, 0, 0, True)]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_plans_do_not_grow_with_the_rows(spark, monkeypatch, keys):
    """No border value of a range is in a plan: ten times the ranges, the same plan."""
    monkeypatch.setattr(window, "CHUNK_ROWS", 40)
    shape = lambda df: re.sub(r"\d+|[0-9a-f]{32}", "#", df._jdf.queryExecution().analyzed().toString())
    made = []
    for n in (400, 4_000):
        df = spark.range(n).selectExpr("id % 2 AS k", "xxhash64(id) AS o", "id AS v")
        made.append([shape(f) for f in (
            window.row_index(df, keys, ["o"]), window.next_value(df, keys, ["o"], {"n": "v"}), window.running_sum(df, keys, ["o"], "v"),
        )])
    assert [len(x) for x in made[0]] == [len(x) for x in made[1]]


def test_numbers_without_keys(spark, monkeypatch):
    monkeypatch.setattr(window, "CHUNK_ROWS", 30)
    df = spark.range(500).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE id * 7919 % 100 END AS o", "id AS v", "'old' AS n")
    got = {r.v: r.n for r in window.row_index(df, [], ["o", "v"], "n", start=5).collect()}
    want = sorted(df.collect(), key=lambda r: (r.o is not None, r.o or 0, r.v))
    assert got == {r.v: i + 5 for i, r in enumerate(want)}
    assert window.row_index(df.limit(0), [], ["o"], "n").count() == 0


# ---------------------------------------------------------------- spans, spines and outputs

def test_spans_of_all_lengths(spark):
    rng = random.Random(4)
    spans = [(i, lo, lo + rng.choice([0, 1, 2, 3, 50, 1_000, 1 << 20, 1 << 33])) for i, lo in enumerate(rng.randrange(-5_000, 5_000) for _ in range(80))]
    points = [(i, rng.randrange(-6_000, 70_000)) for i in range(120)] + [(200, 1 << 32), (201, None)]
    a = spark.createDataFrame(points, "p int, at bigint")
    b = spark.createDataFrame(spans + [(900, None, 5), (901, 5, None)], "s int, lo bigint, hi bigint")
    want = sorted((p, s) for p, at in points if at is not None for s, lo, hi in spans if lo <= at < hi)
    for finest in (1, 16):
        out = join.range_join_any(a, b, "at", "lo", "hi", finest)
        assert sorted((r.p, r.s) for r in out.collect()) == want
    pieces = b.where("lo < hi").select((F.col("hi") - F.col("lo")).alias("n"), F.size(join._aligned_pieces(F.col("lo"), F.col("hi"))).alias("c"))
    assert all(r.c <= 2 * (r.n + 1).bit_length() for r in pieces.collect())
    assert join.range_join_any(a, b.limit(0), "at", "lo", "hi").count() == 0
    timed = spark.sql("SELECT 1 AS s, timestamp_ntz'2020-01-01 00:00:00' AS lo, timestamp_ntz'2024-01-01 00:00:00' AS hi UNION ALL "
                      "SELECT 2, timestamp_ntz'2021-01-01 00:00:00.25', timestamp_ntz'2021-01-01 00:00:00.75'")
    at = spark.sql("SELECT timestamp_ntz'2021-01-01 00:00:00.5' AS at UNION ALL SELECT timestamp_ntz'2021-01-01 00:00:00.75'")
    assert sorted((r.at.microsecond, r.s) for r in join.range_join_any(at, timed, "at", "lo", "hi").collect()) == [(500_000, 1), (500_000, 2), (750_000, 1)]


def test_spans_of_all_lengths_are_not_broadcast(spark, monkeypatch):
    """A point is a row of one bin, however many lengths of spans there are; hot keys, ties, nulls."""
    monkeypatch.setattr(window, "CHUNK_ROWS", 50)
    rng = random.Random(5)
    points = [(rng.choice([0, 0, 0, 1, 2, None]), i, rng.randrange(300)) for i in range(400)]
    spans = [(rng.choice([0, 0, 1, 3, None]), i, lo, lo + 2 ** rng.randrange(0, 40, 3)) for i, lo in enumerate(rng.randrange(300) for _ in range(120))]
    a = spark.createDataFrame(points, "k int, p int, at bigint")
    b = spark.createDataFrame(spans, "k int, s int, lo bigint, hi bigint")
    out = join.range_join_any(a, b, "at", "lo", "hi", on=["k"])
    want = sorted((p, s) for k, p, at in points for j, s, lo, hi in spans if k is not None and k == j and lo <= at < hi)
    assert out.columns == ["k", "p", "at", "s", "lo", "hi"]
    assert sorted((r.p, r.s) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "inline" not in plan


def test_a_spine_is_made_by_many_tasks(spark):
    """Thirty million buckets without keys: blocks of them are dealt to tasks before they are made."""
    one = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t, 1 AS v")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    grid = gapfill.bucket_numbers(one, [], F.lit(30_000_000 - 1))
    assert grid.rdd.getNumPartitions() > 1 and grid.count() == 30_000_000
    keyed = gapfill.bucket_numbers(spark.range(3).selectExpr("id AS k"), ["k"], F.lit(10_000))
    assert keyed.groupBy("k").agg(F.count("*").alias("n"), F.max("__i").alias("m")).where("n = 10001 and m = 10000").count() == 3
    assert keyed.where("k = 1").select(F.spark_partition_id()).distinct().count() > 1
    out = gapfill.fill_buckets(one, "t", "1 HOUR", at("2024-01-01 00:00:00"), at("2025-01-01 00:00:00"), [], F.sum("v"))
    assert out.count() == 366 * 24 + 1


def test_routing_reads_the_source_once(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).selectExpr("id", "id % 4 AS kind").write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        seen.add(1)
        return i

    source = spark.read.parquet(path).withColumn("id", counted.asNondeterministic()("id"))
    outputs = shape.route(source, "kind", {0: "even", 2: "even", 1: "1"}, "rest")
    assert {n: sorted(r.id for r in df.collect()) for n, df in outputs.items()} == {
        "even": list(range(0, 100, 2)), "1": list(range(1, 100, 4)), "rest": list(range(3, 100, 4))
    }
    assert seen.value == 100 and outputs["1"].columns == ["id", "kind"]
    plan = outputs["1"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__to" in plan
