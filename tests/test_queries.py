"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, canon
from helpers import plan

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.QUERIES, contract.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert canon(rows, frame.columns) == canon(result.fetchall(), columns)


def test_entry(spark):
    rows = {r.st: r.n for r in contract.entry(spark).collect()}
    assert set(rows) == {"C", "F", "O", "P", "U"}


def test_known_answers_at_hundredth_scale(spark):
    from tidewell.plans.rows import state_by_status
    assert {r.st: r.n for r in state_by_status(spark, "/root/testdata/sf0.01").collect()} == {
        "C": 715, "F": 2847, "O": 2826, "P": 2899, "U": 4285}


@pytest.mark.parametrize("name,exchanges", [
    ("expand_changelog", 0), ("start_at_position", 0), ("conv_decimal", 0), ("kafka_rows", 0),
    ("expand_flat_json", 0), ("current_state", 1), ("source_offsets", 1)])
def test_shuffles(spark, name, exchanges):
    assert plan(QUERIES[name](spark, SF)).count("Exchange hashpartitioning") == exchanges


def test_no_cross_joins_or_python_rows(spark):
    for name in ("start_after_gtid", "bucket_lookup", "expand_tables", "reset_offsets", "current_state"):
        text = plan(QUERIES[name](spark, SF))
        assert "NestedLoop" not in text and "CartesianProduct" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["row_filter"](spark, SF))
    assert "GreaterThanOrEqual(value,18.0)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text
    text = plan(QUERIES["partitioned_write"](spark, SF).filter("order_month >= '1998-01'"))
    assert "PartitionFilters: [isnotnull(order_month" in text
