"""Sources: snapshot, change feed, start options, Kafka shape, table lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import keep_changes, with_topic_parts
from tidewell.operators.kafka_rows import keyed_text, kafka_rows
from tidewell.operators.merge import current_state
from tidewell.operators.offsets import snapshot_plus_changes as snapshot_and_later
from tidewell.operators.routing import expand_tables, table_pattern_filter
from tidewell.plans.feed import CH, KEY, ORDERS, ROW, change_feed, envelopes
from tidewell.plans.registry import query, table
from tidewell.session import scratch_dir
from tidewell.sources.readers import as_snapshot, from_offsets, from_time, read_feed_text, value_text
from tidewell.sources.startup import parse_start, start_from, wall_clock_millis


def feed_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes(change_feed(table(spark, sf_dir, "orders")))


@query("snapshot_scan", """
SELECT concat('src.order_0', o_orderkey % 8, '.orders') AS topic, 'r' AS op, CAST(0 AS BIGINT) AS seq,
       o_orderkey AS id, o_orderstatus AS st, o_totalprice AS amt FROM orders""")
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS st", "o_totalprice AS amt")
    topic = F.concat(F.lit("src.order_0"), (F.col("id") % 8).cast("string"), F.lit(".orders"))
    return as_snapshot(rows, topic).select("topic", "op", "seq", "after.*")


@query("change_feed_scan", CH + """
SELECT topic, op, ts_ms, id, b_st, a_st, b_amt, a_amt, file, pos, concat(uuid, ':', txn) AS gtid FROM ch""")
def change_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scratch_dir(spark, "feed")
    feed = feed_of(spark, sf_dir).drop("seq", "shard")
    feed.select(F.to_json(F.struct("*")).alias("value")).write.text(lines)
    return read_feed_text(spark, lines, ROW, KEY).select(
        "topic", "op", "ts_ms", "key.id", F.col("before.st").alias("b_st"),
        F.col("after.st").alias("a_st"), F.col("before.amt").alias("b_amt"),
        F.col("after.amt").alias("a_amt"), "source.file", "source.pos", "source.gtid")


@query("snapshot_plus_changes", CH + "SELECT topic, id, st, amt FROM state")
def snapshot_plus_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS st", "o_totalprice AS amt")
    topic = F.concat(F.lit("src.order_0"), (F.col("id") % 8).cast("string"), F.lit(".orders"))
    snapshot = as_snapshot(rows, topic, position=1).withColumn(
        "before", F.lit(None).cast(ROW)).select("topic", "op", "seq", "before", "after")
    changes = keep_changes(feed_of(spark, sf_dir)).select("topic", "op", "seq", "before", "after")
    both = snapshot_and_later(snapshot, changes, 1)
    return current_state(expand_changelog(both).drop("op"), ORDERS.key).select(
        "topic", "id", "st", "amt")


@query("start_at_position", CH + """
SELECT topic, op, id, file, pos FROM ch WHERE op <> 'r' AND (file, pos) >= ('mysql-bin.000002', 500000)""")
def start_at_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    option = parse_start("pos/mysql-bin.000002:500000")
    return start_from(feed_of(spark, sf_dir), option).select(
        "topic", "op", "key.id", "source.file", "source.pos")


@query("start_after_gtid", CH + """
SELECT topic, op, id, uuid, txn FROM ch WHERE op <> 'r' AND NOT (
  (uuid = 'uuid-0' AND (txn BETWEEN 1 AND 20000 OR txn BETWEEN 40000 AND 60000))
  OR (uuid = 'uuid-3' AND txn BETWEEN 1 AND 70000))""")
def start_after_gtid(spark: SparkSession, sf_dir: str) -> DataFrame:
    option = parse_start("gtid/uuid-0:1-20000:40000-60000,uuid-3:1-70000")
    gtid = F.split("source.gtid", ":")
    return start_from(feed_of(spark, sf_dir), option).select(
        "topic", "op", "key.id", F.get(gtid, F.lit(0)).alias("uuid"),
        F.get(gtid, F.lit(1)).cast("bigint").alias("txn"))


def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a Kafka source would hand it over."""
    feed = with_topic_parts(keep_changes(feed_of(spark, sf_dir))).withColumns({
        "offset": F.col("key.id") * 10 + F.col("seq"), "timestamp": F.timestamp_millis("ts_ms")})
    return kafka_rows(feed, ["id"], 4, produced_ms=F.col("ts_ms") + 500, portable=True,
                      carried=["offset", "timestamp"])


PART = "CAST(CAST(concat('0x', substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 4 AS INTEGER)"


@query("kafka_shape_scan", CH + f"""
, k AS (SELECT concat('t_order_0', shard, '_orders') AS topic, {PART} AS partition,
               id * 10 + seq AS "offset", id, op FROM ok),
committed AS (SELECT topic, partition, max("offset") // 2 AS next_offset FROM k
              WHERE partition < 3 GROUP BY ALL)
SELECT k.topic, k.partition, k."offset", k.id, k.op FROM k
LEFT JOIN committed c ON c.topic = k.topic AND c.partition = k.partition
WHERE k."offset" >= coalesce(c.next_offset, 0)""")
def kafka_shape_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = kafka_frame(spark, sf_dir)
    committed = frame.filter("partition < 3").groupBy("topic", "partition").agg(
        F.expr("max(offset) div 2").alias("next_offset"))
    rows = value_text(from_offsets(frame, committed)).withColumn("_v", F.from_json(
        "value", "before struct<id: bigint>, after struct<id: bigint>, op string"))
    return rows.select("topic", "partition", "offset",
                       F.coalesce("_v.after.id", "_v.before.id").alias("id"), "_v.op")


@query("start_at_timestamp", CH + """
SELECT id * 10 + seq AS "offset", ts_ms FROM ok WHERE ts_ms >= 1700006400000""")
def start_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = wall_clock_millis("2023-11-15_08:00:00")
    return from_time(kafka_frame(spark, sf_dir), start).select(
        "offset", F.unix_millis("timestamp").alias("ts_ms"))


@query("keyed_text", CH + """
SELECT CASE WHEN id % 10 = 0 THEN '' ELSE concat('{"id":', id, '}') END AS key, op, id FROM ok""")
def keyed_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(feed_of(spark, sf_dir)))
    keyless = F.when(F.col("key.id") % 10 != 0, F.col("key")).alias("key")
    value = F.to_json(F.struct("db", "table", keyless, "before", "after", "op"))
    texts = feed.select(value.alias("value")).select(F.split(keyed_text(F.col("value")), "###", 2).alias("t"))
    schema = "before struct<id: bigint>, after struct<id: bigint>, op string"
    rows = texts.select(F.get("t", F.lit(0)).alias("key"), F.from_json(F.get("t", F.lit(1)), schema).alias("v"))
    return rows.select("key", "v.op", F.coalesce("v.after.id", "v.before.id").alias("id"))


@query("expand_tables", """
SELECT concat('db', p_partkey % 10, '.t', p_partkey) AS name, s.postfix,
       concat('db', p_partkey % 10, s.postfix, '.t', p_partkey) AS physical
FROM part, (SELECT unnest(['_00', '_01', '_02', '_03', '_04', '_05', '_06', '_07']) AS postfix) s""")
def expand_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").selectExpr(
        "concat('db', p_partkey % 10, '.t', p_partkey) AS name")
    return expand_tables(names, [f"_0{i}" for i in range(8)])


@query("table_regex_filter", """
WITH t AS (SELECT concat('order_0', o_orderkey % 8) AS db,
                  concat(CASE o_orderkey % 3 WHEN 0 THEN 'orders_' WHEN 1 THEN 'orders_tmp_' ELSE 'refunds_' END,
                         strftime(o_orderdate, '%Y%m')) AS "table" FROM orders)
SELECT db, "table", count(*) AS n FROM t
WHERE regexp_full_match(concat(db, '.', "table"), 'order_0[0-3]\\.orders_[0-9]{6}|order_\\d+\\.refunds_1998[0-9]{2}')
GROUP BY ALL""")
def table_regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "concat('order_0', o_orderkey % 8) AS db",
        "concat(CASE o_orderkey % 3 WHEN 0 THEN 'orders_' WHEN 1 THEN 'orders_tmp_' ELSE 'refunds_' END,"
        " date_format(o_orderdate, 'yyyyMM')) AS `table`")
    patterns = [r"order_0[0-3]\.orders_[0-9]{6}", r"order_\d+\.refunds_1998[0-9]{2}"]
    return table_pattern_filter(rows, patterns).groupBy("db", "table").agg(
        F.count(F.lit(1)).alias("n"))
