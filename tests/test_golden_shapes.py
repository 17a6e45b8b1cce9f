"""Row operators, joins, aggregates and sets on small data with known results."""

import json

import pytest
from pyspark.sql import functions as F

from olapflow.functions import dates
from olapflow.operators import agg, join, quality, runlog, sets, shape, udf, window
from tests.helpers import rows


@pytest.fixture(scope="module")
def fruit(spark):
    return spark.createDataFrame([("apples", 2), ("oranges", 4), ("grapes", 3)], "fruit string, sales int")


def test_adjust_oranges(fruit):
    out = shape.adjust_when(fruit, F.col("fruit") == "oranges", "sales", F.col("sales") + 2)
    assert rows(out) == [("apples", 2), ("grapes", 3), ("oranges", 6)]


def test_clones(fruit):
    assert shape.clone_rows(fruit, 2).count() == 6
    conditional = shape.clone_rows(fruit, F.when(F.col("fruit") == "apples", 1).otherwise(2))
    assert conditional.count() == 5
    adjusted = shape.adjust_when(fruit, F.col("fruit") == "oranges", "sales", F.col("sales") + 2)
    assert shape.clone_rows(adjusted, "sales").count() == 11


def test_no_clones_for_zero_negative_or_null(spark):
    df = spark.createDataFrame([(1, 0), (2, -3), (3, None), (4, 2)], "id int, n int")
    assert rows(shape.clone_rows(df, "n", "i"), "id", "i") == [(4, 0), (4, 1)]


def test_offices(spark):
    dim = spark.createDataFrame([(1, 234, "New York"), (2, 333, "London"), (3, 231, "Milan")], "officeTk int, officeId int, officeName string")
    sales = spark.createDataFrame([("2016-01-01", 333, 432245), ("2016-01-01", 234, 55432), ("2016-01-01", 231, 41123)], "date string, officeId int, sales int")
    out = join.lookup_key(sales, dim, "officeId", "officeTk").withColumn("date", dates.date_key(F.col("date")))
    assert rows(out, "date", "officeTk", "sales") == [(20160101, 1, 55432), (20160101, 2, 432245), (20160101, 3, 41123)]
    assert out.agg(F.sum("sales")).first()[0] == 528800


def test_department_sums(spark):
    data = [("apples", 1000), ("apples", 2000), ("grapes", 1127), ("apples", 709), ("bananas", 736)]
    df = spark.createDataFrame(data, "fruit string, quantity int")
    out = udf.repartition_by(df, 5, "fruit").groupBy("fruit").agg(F.sum("quantity"))
    assert rows(out) == [("apples", 3709), ("bananas", 736), ("grapes", 1127)]


def test_running_totals_in_order(spark):
    data = [("apples", 2), ("oranges", 3), ("apples", 5), ("grapes", 5), ("apples", 9), ("oranges", 7)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, fruit string, qty int")
    out = window.running_sum(df, ["fruit"], ["i"], "qty", chunk=F.expr("i div 2"))
    assert [r.running for r in out.orderBy("i").collect()] == [2, 3, 7, 5, 16, 10]


def test_averages_roll_up(spark):
    table = spark.createDataFrame([("a", 2000.0, 100), ("a", 3000.0, 150)], "k string, sales_avg double, sales_count int")
    table = table.withColumn("sales_sum", F.col("sales_avg") * F.col("sales_count"))
    for how in ("AvgFromAvg", "AvgFromSum"):
        assert rows(agg.rollup_avg(table, ["k"], "sales", how)) == [("a", 2600.0)]
    assert rows(agg.rollup_avg(table, ["k"], "sales", "SumFromAvg")) == [("a", 650000.0)]


def test_average_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("a", 3.0), ("a", 4.0)], "k string, v double")
    table = agg.build_aggregate(df, ["k"], {"v": F.col("v")})
    assert table.first().row_count == 5 and table.first().v_count == 4
    assert rows(agg.rollup_avg(table, ["k"], "v")) == [("a", 2.5)]


def test_durations(spark):
    df = spark.createDataFrame([(0,), (59,), (3600,), (788645,), (604800,)], "s bigint")
    out = [r[0] for r in df.select(dates.format_duration(F.col("s"))).collect()]
    assert out == ["0sec", "59sec", "1h", "1w 2d 3h 4min 5sec", "1w"]


def test_long_timestamp(spark):
    df = spark.createDataFrame([("Sun Sep 18 10:09:34 +0000 2016",), ("rubbish",)], "t string")
    assert [r[0] for r in df.select(dates.parse_long_ts(F.col("t"))).collect()] == [1474193374000, None]


def test_spring_gap_in_london(spark):
    df = spark.createDataFrame([("2015-03-29 00:30:00",), ("2015-03-29 02:30:00",)], "t string")
    out = df.select(dates.parse_ts(F.col("t"), "yyyy-MM-dd HH:mm:ss", "Europe/London").cast("string"))
    assert [r[0] for r in out.collect()] == ["2015-03-29 00:30:00", "2015-03-29 01:30:00"]


def test_null_condition_is_a_miss(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    hit, miss = shape.split_rows(df, F.col("s") == "x")
    assert rows(hit, "id") == [(2,)] and rows(miss, "id") == [(1,)]


def test_variables_both_ways(spark):
    texts = spark.createDataFrame([(1, "a ${X} b ${Y} $ ${Z}"), (2, "plain"), (3, "${X}${X}")], "id int, t string")
    names = spark.createDataFrame([("X", "1"), ("Y", "${X}")], "name string, value string")
    want = [(1, "a 1 b ${X} $ ${Z}"), (2, "plain"), (3, "11")]
    assert rows(shape.substitute_vars(texts, "t", names)) == want


def test_stream_lookup_takes_first_match_once(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    ref = spark.createDataFrame([(1, 2, "late"), (1, 1, "early")], "rid int, o int, v string")
    out = join.stream_lookup(df, ref, {"id": "rid"}, {"v": "v"}, ["o"], {"v": "none"})
    assert rows(out) == [(1, "early"), (2, "none")]


def test_lenses_nest_under_their_category(spark):
    parent = spark.createDataFrame([("prime",), ("zoom",), ("macro",)], "cat string")
    child = spark.createDataFrame([("prime", 50, 3), ("prime", 35, 2), ("zoom", 70, 1)], "cat string, focal int, qty int")
    out = join.nest_children(parent, child, "cat", ["focal", "qty"], ["focal"], "items", block=1)
    parts = [(r.cat, r.part, [x.focal for x in r["items"]]) for r in out.collect()]
    assert sorted(parts) == [("macro", 0, []), ("prime", 0, [35]), ("prime", 1, [50]), ("zoom", 0, [70])]


def test_range_join_equals_nested_loop(spark):
    spans = spark.createDataFrame([(1, 0, 10), (2, 5, 7), (3, 9, 40), (4, 12, 12)], "sid int, lo int, hi int")
    points = spark.createDataFrame([(i, i) for i in range(45)], "pid int, p int")
    got = join.range_join(points, spans, "p", "lo", "hi", 8).select("pid", "sid")
    want = [(p, s) for p in range(45) for s, lo, hi in [(1, 0, 10), (2, 5, 7), (3, 9, 40)] if lo <= p < hi]
    assert rows(got) == sorted(want, key=lambda t: tuple((False, str(v)) for v in t))


def test_detect_empty(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    assert rows(join.detect_empty(df, {"id": F.lit(0)})) == [(1, "a")]
    assert rows(join.detect_empty(df.where("id > 1"), {"id": F.lit(0)})) == [(0, None)]


def test_group_concat_across_chunks(spark):
    df = spark.createDataFrame([("a", i) for i in (12, 3, 25, 7)], "k string, v int")
    out = agg.concat_string(df, ["k"], "v", "-", ["v"], F.expr("v div 10"), "all")
    assert rows(out) == [("a", "3-7-12-25")]


def test_quantize_clamps_the_maximum(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 24, 25, 99, 100)], "v double")
    assert rows(agg.quantize(df, "v", 4), "v", "class") == [(0.0, 1), (100.0, 4), (24.0, 1), (25.0, 2), (99.0, 4)]


def test_generate_all_keeps_repeats(spark):
    picked = spark.createDataFrame([("AU",), ("AU",)], "country string")
    first_child = spark.createDataFrame([("AU", "NSW", 305567)], "country string, state string, sales int")
    expand = lambda m: m.join(first_child, "country").select("state", "sales")
    assert rows(sets.generate(picked, expand, keep_all=True)) == [("NSW", 305567)] * 2
    assert rows(sets.generate(picked, expand)) == [("NSW", 305567)]


def test_golden_pipeline(spark):
    inventory = spark.createDataFrame([("headphones", 20), ("microphones", 17)], "item_name string, item_count int")
    golden = spark.createDataFrame([("headphones", 21), ("microphones", 18)], "item string, n int")
    out = inventory.withColumn("item_count", F.col("item_count") + 1)
    mapping = {"item_name": "item", "item_count": "n"}
    assert quality.golden_diff(out, golden, mapping).isEmpty()
    assert rows(quality.golden_diff(inventory, golden, mapping)) == [
        ("headphones", 20, 1), ("headphones", 21, -1), ("microphones", 17, 1), ("microphones", 18, -1)
    ]


def test_golden_diff_counts_repeats(spark):
    one = spark.createDataFrame([(1,)], "a int")
    assert rows(quality.golden_diff(one.union(one), one)) == [(1, 1)]


def test_error_routing_aborts(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    good, bad = quality.with_errors(df, {"v": F.col("v") > 0})
    assert rows(good) == [(1, 5)] and rows(bad, "id", "error_codes") == [(2, "v")]
    with pytest.raises(ValueError, match="1 rows"):
        quality.abort_if(bad)
    quality.abort_if(bad.where("id < 0"))


def test_run_log(spark):
    data = [("p1", "load", "running", "2016-02-04 10:00:00"), ("p1", "load", "error", "2016-02-04 10:00:04"), ("p2", "load", "running", "2016-02-04 11:00:00")]
    log = spark.createDataFrame(data, "process_id string, process_name string, status string, t string")
    log = log.withColumn("created_at", F.col("t").cast("timestamp")).drop("t")
    view = runlog.run_log_view(log)
    assert rows(view, "process_id", "status", "duration") == [("p1", "error", 4), ("p2", "running", None)]
    assert rows(runlog.count_running(view, "load")) == [(1,)]


def test_log_write_and_read(spark, tmp_path):
    runlog.log_event(spark, str(tmp_path / "log"), "p", "load", "running")
    runlog.log_event(spark, str(tmp_path / "log"), "p", "load", "finished")
    view = runlog.run_log_view(runlog.read_log(spark, str(tmp_path / "log")))
    assert rows(view, "process_name", "status") == [("load", "finished")]


def test_nested_json_from_lists(spark):
    df = spark.createDataFrame([("a,b", "1,2", "b")], "names string, sizes string, mine string")
    out = shape.zip_lists_to_structs(df, "x", {"n": "names", "s": "sizes"}, members={"own": "mine"})
    assert json.loads(out.select(F.to_json("x")).first()[0]) == [
        {"n": "a", "s": "1", "own": False}, {"n": "b", "s": "2", "own": True}
    ]
