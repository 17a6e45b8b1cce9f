"""Snapshots, ledgers and gap filling on small data with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from olapflow.plans import dims, gapfill, snapshot
from tests.helpers import day, days, rows, ts


def case_events(spark):
    data = [
        (13, "2015-01-02"), (13, "2015-01-09"),
        (12, "2015-01-01"), (12, "2015-01-03"), (12, "2015-01-07"), (12, "2015-01-11"),
        (15, "2015-01-03"), (15, "2015-01-04"), (15, "2015-01-07"),
    ]
    return spark.createDataFrame(data, "case_id int, d string").select("case_id", F.to_date("d").alias("day"))


def test_case_counts_per_day(spark):
    out = snapshot.snapshot_counts(case_events(spark), "case_id", "day", day("2015-01-13"))
    want = {f"2015-01-{d:02d}": 3 for d in range(3, 13)} | {"2015-01-01": 1, "2015-01-02": 2}
    got = dict(rows(days(out, "day"), "day", "n"))
    assert got == want and sum(got.values()) == 33


def test_case_counts_equal_exploded_intervals(spark):
    spans = snapshot.to_intervals(case_events(spark), "case_id", ["day"], [], day("2015-01-13"))
    exploded = snapshot.explode_snapshot(spans, "valid_from", "valid_to")
    by_rows = exploded.groupBy("day").agg(F.count("*").alias("n"))
    by_changes = snapshot.interval_counts(spans, "valid_from", "valid_to")
    assert exploded.count() == 33
    assert rows(by_rows, "day", "n") == rows(by_changes, "day", "n")


def test_event_after_as_of_ends_at_the_event(spark):
    out = snapshot.snapshot_counts(case_events(spark), "case_id", "day", day("2015-01-08"))
    got = dict(rows(days(out, "day"), "day", "n"))
    assert got["2015-01-08"] == 2 and got["2015-01-10"] == 1 and "2015-01-11" not in got


def status_intervals(spark):
    data = [
        (1, 2321, 20160201, 20160205, "open"), (2, 2321, 20160205, 20160207, "assigned"),
        (3, 2321, 20160207, 20160208, "closed"), (4, 2322, 20160202, 20160204, "open"),
        (5, 2322, 20160204, 20160207, "assigned"), (6, 2322, 20160208, 20160208, "closed"),
    ]
    df = spark.createDataFrame(data, "event_tk bigint, case_id bigint, f int, t int, event_status string")
    return df.withColumns({c: F.to_date(F.col(c).cast("string"), "yyyyMMdd") for c in ("f", "t")})


def test_status_intervals_explode(spark):
    out = snapshot.explode_snapshot(status_intervals(spark), "f", "t")
    counts = dict(rows(out.groupBy("event_tk").count()))
    assert counts == {1: 4, 2: 2, 3: 1, 4: 2, 5: 3}


def test_issue_ages(spark):
    data = [(377, "Created", "2015-09-02 08:00:00"), (377, "Assigned", "2015-09-02 12:00:00"), (377, "Resolved", "2015-09-08 09:00:00")]
    events = spark.createDataFrame(data, "issue_id int, status string, t string")
    events = events.select("issue_id", "status", F.col("t").cast("timestamp_ntz").alias("ts"))
    out = snapshot.state_age_snapshot(events, "issue_id", "status", ["ts"], day("2015-09-09"))
    got = rows(days(out, "day"), "day", "status", "age_in_state", "age_of_key")
    want = [(f"2015-09-0{d}", "Assigned", d - 2, d - 2) for d in range(2, 8)]
    want += [("2015-09-08", "Resolved", 0, 6), ("2015-09-09", "Resolved", 1, 7)]
    assert got == want


def test_intraday_ledger_and_aggregate(spark):
    data = [(1, "Opened", "2015-09-01 08:00:00"), (1, "Assigned", "2015-09-01 09:00:00"), (2, "Opened", "2015-09-02 10:00:00")]
    events = spark.createDataFrame(data, "id int, status string, t string")
    events = events.select("id", "status", F.col("t").cast("timestamp_ntz").alias("ts"))
    ledger = snapshot.to_ledger(events, "id", "status", ["ts"])
    assert rows(ledger, "id", "state", "quantity", "age_days") == [
        (1, "Assigned", 1, 0), (1, "Opened", -1, 0), (1, "Opened", 1, 0), (2, "Opened", 1, 0)
    ]
    filled = snapshot.state_age_snapshot(events, "id", "status", ["ts"], day("2015-09-03"))
    out = snapshot.aggregate_snapshot(filled, ["day", "status"])
    assert rows(days(out, "day"), "day", "status", "on_hand") == [
        ("2015-09-01", "Assigned", 1), ("2015-09-02", "Assigned", 1), ("2015-09-02", "Opened", 1),
        ("2015-09-03", "Assigned", 1), ("2015-09-03", "Opened", 1),
    ]


def test_accumulate_stops_at_zero(spark):
    data = [("a", "2015-01-01", 2), ("a", "2015-01-03", -2), ("a", "2015-01-06", 1)]
    ledger = spark.createDataFrame(data, "s string, d string, quantity int").withColumn("day", F.to_date("d"))
    out = snapshot.accumulate(ledger, ["s"], day("2015-01-07"))
    assert rows(days(out, "day"), "day", "change", "balance") == [
        ("2015-01-01", 2, 2), ("2015-01-02", 0, 2), ("2015-01-03", -2, 0), ("2015-01-06", 1, 1), ("2015-01-07", 0, 1)
    ]


def test_daily_advance_reaches_the_same_balance(spark):
    data = [("a", "2015-01-01", 2), ("b", "2015-01-01", 1), ("a", "2015-01-02", -2), ("b", "2015-01-03", 4)]
    ledger = spark.createDataFrame(data, "s string, d string, quantity int").withColumn("day", F.to_date("d")).drop("d")
    state = ledger.where("day = '2015-01-01'")
    for d in ("2015-01-02", "2015-01-03"):
        state = snapshot.advance_snapshot(state, ledger.where(F.col("day") == d), ["s"])
    assert rows(state.select("s", "quantity")) == [("b", 5)]


def test_merged_intervals_match_a_full_rebuild(spark):
    events = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "a"), (1, 5, "c"), (3, 6, "a")], "k int, t int, s string")
    first = snapshot.to_intervals(events.where("t <= 3"), "k", ["t"], ["s"])
    open_rows = first.where("valid_to is null")
    done, still = snapshot.merge_intervals(open_rows, events.where("t > 3"), "k", ["t"], ["s"])
    full = snapshot.to_intervals(events, "k", ["t"], ["s"])
    rebuilt = first.where("valid_to is not null").unionByName(done).unionByName(still)
    assert rows(full, "k", "s", "valid_from", "valid_to") == rows(rebuilt, "k", "s", "valid_from", "valid_to")


def test_stored_intervals_survive_a_repeated_step(spark, tmp_path):
    events = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "a"), (1, 5, "c"), (3, 6, "a")], "k int, t int, s string")
    path = str(tmp_path)
    first = snapshot.to_intervals(events.where("t <= 3"), "k", ["t"], ["s"])
    snapshot.write_intervals(first.where("valid_to is not null"), first.where("valid_to is null"), path, 0)
    for _ in range(2):
        _, open_rows = snapshot.read_intervals(spark, path, 0)
        done, still = snapshot.merge_intervals(open_rows, events.where("t > 3"), "k", ["t"], ["s"])
        snapshot.write_intervals(done, still, path, 1)
    closed, open_rows = snapshot.read_intervals(spark, path, 1)
    full = snapshot.to_intervals(events, "k", ["t"], ["s"])
    columns = ["k", "s", "valid_from", "valid_to"]
    assert rows(closed.unionByName(open_rows), *columns) == rows(full, *columns)


def test_buckets_count_from_any_start(spark):
    df = spark.sql("select timestamp_ntz'2017-01-01 00:20:00' ts, 1 v union all select timestamp_ntz'2017-01-01 00:05:00', 2")
    out = gapfill.fill_buckets(df, "ts", "10 minutes", ts("2017-01-01 00:05:00"), ts("2017-01-01 00:25:00"), [], F.sum("v"))
    assert [r.value for r in out.orderBy("bucket").collect()] == [2, 1, None]


def test_gap_fill(spark):
    data = [("2017-01-01 00:00:00", 70.0), ("2017-01-05 00:00:00", -20.0), ("2017-01-08 00:00:00", -80.0)]
    df = spark.createDataFrame(data, "t string, amount double").select(F.col("t").cast("timestamp_ntz").alias("ts"), F.lit("joe").alias("user"), "amount")

    def column(name="value", **how):
        out = gapfill.fill_buckets(
            df, "ts", "1 day", ts("2017-01-01 00:00:00"), ts("2017-01-10 00:00:00"), ["user"], F.sum("amount"), **how
        )
        return [r[0] for r in out.orderBy("bucket").select(name).collect()]

    assert column() == [70, None, None, None, -20, None, None, -80, None, None]
    assert column(fill="previous") == [70, 70, 70, 70, -20, -20, -20, -80, -80, -80]
    assert column(fill="linear") == [70, 47.5, 25, 2.5, -20, -40, -60, -80, None, None]
    assert column("cumulative", cumulative=True) == [70, 70, 70, 70, 50, 50, 50, -30, -30, -30]


def test_date_dimension(spark):
    dim = dims.date_dim(spark, "2015-01-01", "2015-12-31")
    first = dim.where("date_key = 20150101").first()
    assert dim.count() == 365
    assert (first.iso_year, first.iso_week, first.iso_day, first.iso_week_key) == (2015, 1, 4, 201501)
    last = dim.where("the_date = '2015-01-18'").first()
    assert last.iso_week_key == 201503 and last.is_working_day == 0 and last.the_date == dt.date(2015, 1, 18)


def test_working_days(spark):
    calendar = dims.add_working_days(dims.date_dim(spark, "2015-01-01", "2015-01-31"))
    spans = spark.sql("select date'2015-01-02' a, date'2015-01-05' b union all select date'2015-01-05', date'2015-01-12'")
    assert rows(dims.working_days_between(spans, "a", "b", calendar), "working_days") == [(1,), (5,)]


def test_known_keys_stay(spark):
    dim = spark.createDataFrame([(1, "fishing"), (7, "cooking")], "tk bigint, name string")
    incoming = spark.createDataFrame([("cooking",), ("sports",), ("sports",), ("art",)], "name string")
    out = dims.assign_keys(dim, incoming, ["name"], "tk", ["name"], F.substring("name", 1, 1))
    assert rows(out, "tk", "name") == [(1, "fishing"), (7, "cooking"), (8, "art"), (9, "sports")]
    hashed = dims.assign_keys(dim, incoming, ["name"], "tk")
    assert sorted(r.tk for r in hashed.collect()) == [1, 7, 8, 9]


def test_one_second_buckets_over_a_month(spark):
    rows_ = [("2024-01-01 00:00:00", 1.0), ("2024-01-31 23:59:50", 11.0)]
    df = spark.createDataFrame(rows_, "t string, v double").select(F.col("t").cast("timestamp_ntz").alias("t"), "v")
    out = gapfill.fill_buckets(
        df, "t", "1 second", ts("2024-01-01 00:00:00"), ts("2024-01-31 23:59:59"), [], F.sum("v"), fill="linear", cumulative=True
    )
    n = 31 * 86_400
    half = (n - 10) // 2
    got = out.agg(
        F.count("*"), F.count("value"), F.max("cumulative"),
        F.max(F.when(F.col("bucket") == ts("2024-01-01 00:00:00") + F.expr(f"make_dt_interval(0, 0, 0, {half})"), F.col("value"))),
    ).first()
    assert tuple(got)[:3] == (n, n - 9, 12.0)
    assert got[3] == pytest.approx(1 + 10 * half / (n - 10))
