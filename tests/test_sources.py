"""Readers, writers, profiles and generators."""

import json
import os

import pytest
from pyspark.sql import functions as F

from olapflow.sources import files, metadata, tables
from tests.helpers import rows


def test_delimited_with_spaces_dates_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("day;name\n 02-01-2015 ;'x;y'\n")
    out = files.read_delimited(spark, str(tmp_path / "*.csv"), "day date, name string", sep=";", date_format="dd-MM-yyyy", enclosure="'")
    assert [str(v) for v in out.first()] == ["2015-01-02", "x;y"]


def test_missing_trailing_field(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1,Ann,Lee,toys,2.5,Mae\n2,Bob,Ray,food,bad\n")
    schema = "id int, first string, last string, dep string, value double, middle string"
    out = files.read_lines(spark, str(tmp_path / "p.txt")).transform(files.split_typed(schema))
    assert rows(out) == [(1, "Ann", "Lee", "toys", 2.5, "Mae"), (2, "Bob", "Ray", "food", None, None)]


def test_described_files(spark, tmp_path):
    (tmp_path / "sales.txt").write_text("day,amount\n2015-01-01 , 20\n2015-01-02,n/a\n")
    (tmp_path / "stock.txt").write_text("'a|b'|3\n")
    described = spark.createDataFrame(
        [("sales", str(tmp_path / "sales.txt"), ",", '"', True), ("stock", str(tmp_path / "stock.txt"), "|", "'", False)],
        "file_id string, path string, delimiter string, enclosure string, has_header boolean",
    )
    fields = spark.createDataFrame(
        [
            ("sales", 2, "amount", "Integer", None, "n/a"), ("sales", 1, "day", "Date", "yyyy-MM-dd", None),
            ("stock", 1, "item", "String", None, None), ("stock", 2, "n", "Integer", None, None),
        ],
        "file_id string, position int, field_name string, field_type string, field_format string, null_representation string",
    )
    out = metadata.read_by_metadata(spark, described, fields)
    assert [(str(r.day), r.amount) for r in out["sales"].orderBy("day").collect()] == [("2015-01-01", 20), ("2015-01-02", None)]
    assert rows(out["stock"]) == [("a|b", 3)]


def test_json_document_joins_to_one_array(spark):
    df = spark.range(25).select("id", F.concat(F.lit("n"), "id").alias("name"))
    lines = files.to_json_document(df, ["id"], F.expr("id div 4")).orderBy("line_no").collect()
    assert json.loads("".join(r.line for r in lines)) == [{"id": i, "name": f"n{i}"} for i in range(25)]
    blocks = files.to_json_blocks(df, ["id"], 10).orderBy("block_no").collect()
    assert [len(json.loads(b.json)) for b in blocks] == [10, 10, 5]


def test_empty_json_document(spark):
    lines = files.to_json_document(spark.range(0).select("id"), ["id"]).orderBy("line_no").collect()
    assert json.loads("".join(r.line for r in lines)) == []


def test_xml_loop(spark):
    doc = "<r><g><i k='1'><n>a</n></i><i k='2'><n>b</n></i></g><g><i k='3'/></g></r>"
    df = spark.createDataFrame([(7, doc)], "id int, xml string")
    out = files.read_xml_loop(df, "xml", "/r/g/i", {"k": ("@k", "int"), "n": ("n", "string")}, keep=["id"])
    assert rows(out) == [(7, 1, "a"), (7, 2, "b"), (7, 3, None)]


def test_failed_rows_commit_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1,), (2,)], "v int")
    tables.write_atomic(good, path, {"positive": F.col("v") > 0})
    with pytest.raises(Exception, match="positive"):
        tables.write_atomic(good.union(spark.createDataFrame([(None,)], "v int")), path, {"positive": F.col("v") > 0})
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_table_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    tables.write_table(df, path, "fail_if_not_empty")
    with pytest.raises(ValueError, match="not empty"):
        tables.write_table(df, path, "fail_if_not_empty")
    tables.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    tables.write_table(df, path, "truncate")
    assert spark.read.parquet(path).count() == 3


def test_single_file_sink(spark, tmp_path):
    path = str(tmp_path / "one")
    files.write_delimited(spark.range(10).repartition(4), path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_pending_files(spark):
    listing = spark.createDataFrame([("10_b.sql",), ("2_a.sql",), ("1_x.sql",), ("readme.md",)], "filename string")
    done = spark.createDataFrame([("1_x.sql",)], "filename string")
    out = tables.pending_files(listing, done, r"^([0-9]+)_.+").collect()
    assert [(r.filename, r.version) for r in out] == [("2_a.sql", 2), ("10_b.sql", 10)]


def test_generated_tables_do_not_depend_on_partitions(spark):
    model = {
        "users": (20, {"user_id": ("id",), "level": ("enum", ["gold", "silver"])}),
        "orders": (200, {"order_id": ("id",), "user_id": ("ref", "users"), "amount": ("range", 5, 9)}),
    }
    out = tables.generate_tables(spark, model)
    again = tables.generate_tables(spark, model)["orders"].repartition(7)
    assert rows(out["orders"]) == rows(again)
    assert out["orders"].join(out["users"], "user_id").count() == 200
    assert out["orders"].agg(F.min("amount"), F.max("amount")).first() == (5, 9)


def test_generated_constant_rows(spark):
    assert rows(tables.generate_rows(spark, 2, kind="x")) == [(0, "x"), (1, "x")]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (10, "a")], "n int, s string")
    want = [("n", 0, "int", 3, 0, 3, "1", "10"), ("s", 1, "string", 3, 1, 1, "a", "a")]
    assert rows(tables.profile(df)) == want and rows(tables.profile(df, approx=True)) == want


def test_profiles_merge_and_count_exactly(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS a", "CASE WHEN id % 3 > 0 THEN concat('v', id % 50) END AS b", "id % 7 AS part")
    whole = rows(tables.profile(df.drop("part")))
    merged = tables.profile_of(tables.merge_sketches(tables.sketches(df, ["part"])), df.drop("part").schema)
    assert rows(merged) == whole
    exact = {r.column: r.distinct_values for r in tables.profile(df, exact=["a", "b"]).collect()}
    assert (exact["a"], exact["b"]) == (20_000, 50) and exact == {r.column: r.distinct_values for r in tables.profile(df, approx=False).collect()}
    near = {r.column: r.distinct_values for r in merged.collect()}
    assert abs(near["a"] - 20_000) <= tables.SKETCH_ERROR * 20_000
    nothing = {r.column: r.distinct_values for r in tables.profile(df.where("id < 0") if "id" in df.columns else df.limit(0), exact=["a"]).collect()}
    assert nothing == {"a": 0, "b": 0, "part": 0}


def test_service_filters_reach_the_scan(spark, capsys):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    tables.register_service(orders.selectExpr("o_orderkey", "o_orderstatus"), "order_service_plan")
    spark.sql("select o_orderkey from order_service_plan where o_orderstatus = 'F'").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan


def test_inline_rows_have_a_known_size(spark):
    """A join with them moves no row of the other side."""
    import datetime
    from decimal import Decimal

    made = [(1, "a", Decimal("1.50"), datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1, 2, 3, 4, 5), [1, None]), (None, None, None, None, None, None)]
    grid = tables.inline(spark, made, "k bigint, s string, d decimal(9,2), day date, at timestamp_ntz, xs array<int>")
    assert [tuple(r) for r in grid.collect()] == made and grid.schema.simpleString().startswith("struct<k:bigint,s:string,d:decimal(9,2)")
    out = spark.range(3_000_000).selectExpr("id % 3 AS k", "id").join(grid, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and out.count() == 1_000_000
    assert tables.inline(spark, [], "k int").count() == 0
