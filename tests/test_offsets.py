"""Positions, servers and sets of transactions over their edges."""

import pytest
from pyspark.sql import functions as F

from helpers import plan
from tidewell.operators import offsets as O
from tidewell.operators import routing
from tidewell.plans.scans import feed_of

SF = "/root/testdata/sf0.001"
SOURCE = "source struct<file: string, pos: bigint, gtid: string, lsn: bigint>"


def frame(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], SOURCE)


def test_log_files_compare_by_number(spark):
    rows = frame(spark, [("mysql-bin.999998", 9, None, 0), ("mysql-bin.999999", 4, None, 1), ("mysql-bin.999999", 5, None, 2),
                         ("mysql-bin.1000000", 1, None, 3), ("odd", 1, None, 4)])
    kept = O.at_or_after(rows, "mysql-bin.999999", 5)
    assert sorted(r.source.lsn for r in kept.collect()) == [2, 3, 4]
    assert sorted(r.source.lsn for r in O.at_or_after(rows, "odd", 0).collect()) == [4]


def test_order_survives_a_change_of_server(spark):
    rows = frame(spark, [("bin.7", 50, "a:900", 0), ("bin.1", 10, "b:3", 1), ("bin.1", 20, "b:3", 2)])
    ordered = rows.select("source.lsn", *[c.alias(n) for n, c in O.gtid_order(["a", "b"]).items()]).orderBy("seq", "log_seq")
    assert [r.lsn for r in ordered.collect()] == [0, 1, 2]
    with pytest.raises(Exception, match="without a rank"):
        rows.select(O.source_sequence("gtid", servers=["a"])).collect()


def test_seen_transactions_as_a_set(spark):
    edge = O.intervals.CHUNK
    seen = [*range(1, 6), 8, *range(edge - 2, edge + 3), 2 * edge + 7]
    rows = [(0, (None, 0, f"u:{n}", 0)) for n in seen + seen[:3]] + [(0, (None, 0, "v:4", 0)), (1, (None, 0, "u:2", 0)), (1, (None, 0, None, 0))]
    feed = spark.createDataFrame(rows, f"task int, {SOURCE}").repartition(5)
    got = {r.task: r.gtid_set for r in O.source_gtid_set(feed, ["task"]).collect()}
    assert got == {0: f"u:1-5:8:{edge - 2}-{edge + 2}:{2 * edge + 7},v:4", 1: "u:2"}
    left = O.after_gtid_set(feed, got[0]).collect()
    assert [r.source.gtid for r in left] == [None]


def test_small_lists_cost_no_shuffle_and_one_scan(spark):
    feed = feed_of(spark, SF)
    known = spark.createDataFrame([("order.orders",)], "tag string")
    tagged = feed.withColumn("_tag", F.concat_ws(".", F.lit("order"), F.split("topic", r"\.")[2]))
    for made in (O.after_gtid_set(feed, "uuid-0:1-5:7,uuid-3:1-9"), routing.with_bucket_count(tagged, {"a": 1}),
                 routing.resolve_tag_from(tagged, known), routing.keep_routed(tagged, ["a", "b"])):
        text = plan(made)
        assert "Exchange" not in text and "Join" not in text and text.count("FileScan") == 1


def test_unlisted_tables_stay(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "_tag string")
    assert [r.buckets for r in routing.with_bucket_count(rows, {"a": 4}).collect()] == [4, None, None]
    assert routing.with_bucket_count(rows, {}).count() == 3


def test_types_too_wide_for_a_decimal_are_text_in_both_forms(spark):
    from tidewell.functions.types import mysql_type, mysql_type_column
    names = ["decimal(65,30)", "decimal(38,2)", "numeric"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "t string").select(mysql_type_column(F.col("t"))).collect()]
    assert got == [mysql_type(n).simpleString() for n in names]
