"""Offsets, commits, phases and schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.keys import key_text, portable_bucket
from tidewell.operators import commits as commit_rules
from tidewell.operators import offsets as offset_rules
from tidewell.plans.feed import CH, change_feed
from tidewell.plans.registry import query, table
from tidewell.plans.rows import MONTHLY, monthly
from tidewell.plans.scans import feed_of
from tidewell.spec import TableSpec, conform

# Every order stands for one task's report on two servers.
REPORTS = """
r AS (SELECT o_orderkey AS task, o_orderkey % 8 AS a, (o_orderkey + 3) % 8 AS b,
             500 + o_custkey * 7 AS x, 900 + o_orderkey * 3 % 100000 AS y FROM orders),
members AS (SELECT concat('uuid-', a) AS uuid, concat('1-20:30-', x) AS intervals, x AS top FROM r
            UNION ALL SELECT concat('uuid-', b), concat('1-', y), y FROM r),
low AS (SELECT uuid, min((top, intervals)) AS v FROM members GROUP BY uuid)"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS task",
        "concat('uuid-', o_orderkey % 8, ':1-20:30-', 500 + o_custkey * 7,"
        " ',uuid-', (o_orderkey + 3) % 8, ':1-', 900 + o_orderkey * 3 % 100000) AS gtid_set")


@query("gtid_low_water", "WITH " + REPORTS + """
SELECT string_agg(concat(uuid, ':', v[2]), ',' ORDER BY uuid) AS gtid_set FROM low""")
def gtid_low_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_rules.gtid_low_water(reports(spark, sf_dir))


@query("reset_offsets", "WITH " + REPORTS + """
SELECT task, (SELECT string_agg(concat(uuid, ':', v[2]), ',' ORDER BY uuid) FROM low) AS gtid_set FROM r""")
def reset_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_rules.reset_offsets(reports(spark, sf_dir))


@query("source_offsets", CH + """
, f AS (SELECT * FROM ch WHERE NOT (shard = 2 AND op <> 'r'))
SELECT shard, uuid, max(txn) AS txn, bool_and(op = 'r') AS snapshot_only FROM f GROUP BY ALL""")
def source_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feed_of(spark, sf_dir).filter("NOT (shard = 2 AND op <> 'r')")
    return offset_rules.source_offsets(feed, ["shard"])


@query("capture_phase", CH + """
, f AS (SELECT * FROM ch WHERE NOT (shard = 0 AND op <> 'r') AND NOT (shard = 1 AND op = 'r'))
SELECT topic, CASE WHEN bool_or(op = 'r') AND bool_or(op <> 'r') THEN 'hybrid'
                   WHEN bool_or(op <> 'r') THEN 'incremental' ELSE 'snapshot' END AS phase FROM f GROUP BY topic""")
def capture_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders")).filter(
        "NOT (shard = 0 AND op <> 'r') AND NOT (shard = 1 AND op = 'r')")
    return offset_rules.capture_phase(feed, "topic")


@query("new_tables", "WITH " + MONTHLY + """
SELECT id, concat(db, '.', tbl) AS "table" FROM m
WHERE concat(db, '.', tbl) NOT IN (SELECT concat(db, '.', tbl) FROM m WHERE seen_at < TIMESTAMP '1996-03-01')""")
def new_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the physical tables that first appear after the last snapshot."""
    rows = monthly(spark, sf_dir).select("id", F.concat_ws(".", "db", "tbl").alias("table"), "seen_at")
    snapshotted = rows.filter("seen_at < timestamp_ntz'1996-03-01 00:00:00'")
    return offset_rules.new_tables(rows, snapshotted).select("id", "table")


COMMITS = """
c AS (SELECT concat('db.t', o_custkey % 40) AS "table", o_orderkey AS "commit", o_orderdate AS ts,
             o_orderkey % 3 <> 0 AS compacted FROM orders)"""


def commit_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('db.t', o_custkey % 40) AS `table`", "o_orderkey AS `commit`", "o_orderdate AS ts",
        "o_orderkey % 3 <> 0 AS compacted")


@query("newest_commit", """
SELECT o_custkey % 8 AS job, max((epoch_us(o_orderdate), concat('chk-', o_orderkey)))[2] AS path
FROM orders GROUP BY ALL""")
def newest_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 8 AS job", "concat('chk-', o_orderkey) AS path", "o_orderdate AS mtime")
    return commit_rules.newest_commit(listing, ["job"])


@query("compaction_due", "WITH " + COMMITS + """
SELECT "table", count(*) AS pending, date_diff('second', min(ts), TIMESTAMP '1992-06-01 00:20:00') AS age_seconds,
       count(*) >= 125 OR date_diff('second', min(ts), TIMESTAMP '1992-06-01 00:20:00') >= 13000000 AS due
FROM c WHERE NOT compacted GROUP BY "table" """)
def compaction_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.expr("timestamp_ntz'1992-06-01 00:20:00'")
    return commit_rules.compaction_due(commit_list(spark, sf_dir), now,
                                       max_commits=125, max_seconds=13000000)


@query("clean_candidates", "WITH " + COMMITS + """
SELECT "table", "commit" FROM (SELECT *, row_number() OVER (PARTITION BY "table" ORDER BY "commit" DESC) AS rn FROM c)
WHERE compacted AND rn > 120""")
def clean_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_rules.clean_candidates(commit_list(spark, sf_dir), keep=120).select("table", "commit")


@query("archive_candidates", "WITH " + COMMITS + """
SELECT "table", "commit" FROM (SELECT *, row_number() OVER (PARTITION BY "table" ORDER BY "commit" DESC) AS rn,
                                      count(*) OVER (PARTITION BY "table") AS n FROM c)
WHERE n > 370 AND rn > 360""")
def archive_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_rules.archive_candidates(commit_list(spark, sf_dir), keep=350).select("table", "commit")


@query("bucket_rows", CH + """
SELECT id, seq, CAST(CAST(concat('0x', substr(md5(concat(topic, '|', id)), 1, 8)) AS BIGINT) % 432 AS INTEGER) AS bucket
FROM ok""")
def bucket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders")).filter("topic <> 'src'")
    key = key_text([F.col("topic"), F.col("id")])
    return feed.select("id", "seq", portable_bucket(key, 432).cast("int").alias("bucket"))


DRIFTED = TableSpec(name="test_db.cdc_order", key=("order_id",), schema=T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("user_id", T.IntegerType()),
    T.StructField("pay_amount", T.DoubleType()), T.StructField("email", T.StringType())]))


@query("schema_drift", """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_custkey AS INTEGER) END AS user_id,
       o_totalprice AS pay_amount, CAST(NULL AS VARCHAR) AS email,
       CASE WHEN o_orderkey % 9 > 0 THEN '' ELSE 'user_id' END AS rejects FROM orders""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_totalprice AS pay_amount", "o_orderstatus AS user_name",
        "CASE WHEN o_orderkey % 9 > 0 THEN '' ELSE 'jk' END || o_custkey AS user_id")
    return conform(old, DRIFTED).withColumn("rejects", F.array_join("_rejects", ",")).drop("_rejects")
