"""Queries that have SQL, against it."""

import duckdb
import pytest

from check import TABLES, canon
from tidewell.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows and canon(rows, frame.columns) == canon(result.fetchall(), columns)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
