"""The registry itself, and a sample of its queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as driver
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "a16_pending_files", "b13_word_count", "b21_working_days", "c01_weighted_allocation", "c04_rollup_tree",
    "c12_semi_additive_closing", "c20_drill_down", "d03_clone_by_column", "e09_range_join", "e15_nested_xml",
    "f10_rollup_levels", "g03_snapshot_counts", "g07_accumulating_snapshot", "g15_fill_linear", "h05_top_per_group",
    "k05_covering_join", "s05_generate_text", "t04_session_window", "u07_rows_with_errors", "w05_run_log_view",
]


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    out = driver.entry(spark)
    assert out.columns == ["day", "n"] and out.count() > 0


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, con, name):
    good, text = compare(spark, FOLDER, name, driver.queries()[name], driver.oracle_sql()[name], con)
    assert good, text
