"""Projections, filters, routing, lookups and changelog expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.temporal import write_time
from tidewell.operators import routing
from tidewell.operators.typed import expand_flat_records
from tidewell.operators.envelope import (
    REJECT, flat_record, keep_changes, row_by_name, row_by_position, shard_id, topic_parts,
    with_reject_reason, with_topic_parts)
from tidewell.operators.kafka_rows import digit_key, keep_keys, key_partition, kafka_rows, record_key, topic_name
from tidewell.operators.merge import current_state as newest_live
from tidewell.operators.offsets import reset_tables as still_processed
from tidewell.plans.feed import CH, ORDERS, ROW, change_feed, changelog
from tidewell.plans.registry import query, table
from tidewell.plans.scans import PART, feed_of
from tidewell.sources.readers import split_words
from tidewell.spec import TableSpec


@query("topic_parts", CH + """
SELECT topic, len(string_split(topic, '.')) AS parts, string_split(topic, '.')[2] AS db,
       string_split(topic, '.')[3] AS "table", count(*) AS n FROM ch GROUP BY ALL""")
def topic_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders")).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"))
    return with_topic_parts(feed).withColumn("parts", F.size(topic_parts(F.col("topic"))).cast("bigint"))


@query("topic_filter", CH + """
SELECT CASE WHEN topic = 'src' THEN 'topic has one part' END AS reason, topic, count(*) AS n
FROM ch GROUP BY ALL""")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders"))
    return with_reject_reason(feed).groupBy(F.col(REJECT).alias("reason"), "topic").agg(
        F.count(F.lit(1)).alias("n"))


@query("logical_tag", CH + """
SELECT regexp_replace(concat('order_0', shard), '_\\d+$', '') || '.orders' AS tag, id, seq FROM ok""")
def logical_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(change_feed(table(spark, sf_dir, "orders"))))
    return feed.select(routing.logical_tag(F.col("db"), F.col("table")).alias("tag"), "id", "seq")


MONTHLY = """
m AS (SELECT o_orderkey AS id, concat('order_0', o_orderkey % 8) AS db,
             CASE o_orderkey % 4 WHEN 0 THEN 'orders' WHEN 1 THEN 'refunds_' || strftime(o_orderdate, '%Y%m')
                  ELSE 'orders_' || strftime(o_orderdate, '%Y%m') END AS tbl, o_orderdate AS seen_at FROM orders)"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over monthly physical tables, one kind of them unknown."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "concat('order_0', o_orderkey % 8) AS db",
        "CASE o_orderkey % 4 WHEN 0 THEN 'orders' WHEN 1 THEN 'refunds_' || date_format(o_orderdate, 'yyyyMM')"
        " ELSE 'orders_' || date_format(o_orderdate, 'yyyyMM') END AS tbl", "o_orderdate AS seen_at")


@query("logical_tag_two_step", "WITH " + MONTHLY + """
SELECT id, CASE WHEN tbl LIKE 'orders%' THEN 'order.orders' END AS tag FROM m""")
def logical_tag_two_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = routing.logical_tag(F.col("db"), F.col("tbl"))
    return monthly(spark, sf_dir).select(
        "id", routing.resolve_tag(tag, ["order.orders", "order.lines"]).alias("tag"))


@query("shard_column", CH + "SELECT topic, id, seq, concat('0_0', shard) AS shard FROM ok")
def shard_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(change_feed(table(spark, sf_dir, "orders"))))
    return feed.select("topic", "id", "seq", shard_id(0, F.col("db")).alias("shard"))


@query("write_time_column", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS write_time FROM events""")
def write_time_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", write_time(F.col("ts")).alias("write_time"))


@query("op_filter", CH + """
, x AS (SELECT topic, CASE WHEN id % 13 = 0 THEN NULL WHEN id % 11 = 0 THEN 't' ELSE op END AS op FROM ch)
SELECT op, CASE WHEN topic = 'src' THEN 'topic has one part' WHEN op IS NULL THEN 'no op'
                WHEN op NOT IN ('c', 'r', 'u', 'd') THEN 'unknown op' END AS reason, count(*) AS n
FROM x GROUP BY ALL""")
def op_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders"))
    mixed = feed.withColumn("op", F.when(F.col("id") % 13 == 0, F.lit(None)).when(
        F.col("id") % 11 == 0, F.lit("t")).otherwise(F.col("op")))
    return with_reject_reason(mixed).groupBy("op", F.col(REJECT).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


@query("flat_record", CH + """
SELECT concat('order_0', shard) AS db, 'orders' AS "table", id, op, b_st, a_st, b_amt, a_amt,
       CAST(ts_ms AS VARCHAR) AS cdc_ts, CAST(ts_ms + 500 AS VARCHAR) AS prd_ts,
       b_st IS NOT NULL AS has_before FROM ok""")
def flat_record_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(feed_of(spark, sf_dir)))
    image = "struct<st: string, amt: double>"
    schema = (f"db string, `table` string, key struct<id: bigint>, before {image}, after {image},"
              " op string, cdc_ts string, prd_ts string")
    texts = feed.select(flat_record(F.col("ts_ms") + 500).alias("v")).select(
        "v", F.from_json("v", schema).alias("e"))
    return texts.select(
        "e.db", "e.table", "e.key.id", "e.op", F.col("e.before.st").alias("b_st"),
        F.col("e.after.st").alias("a_st"), F.col("e.before.amt").alias("b_amt"),
        F.col("e.after.amt").alias("a_amt"), "e.cdc_ts", "e.prd_ts",
        F.contains("v", F.lit('"before"')).alias("has_before"))


SHAPE = TableSpec(name="order.orders", key=("id",), schema=T.StructType([
    T.StructField("id", T.LongType()), T.StructField("st", T.StringType()),
    T.StructField("amt", T.DoubleType()), T.StructField("cust", T.IntegerType())]))


@query("project_by_position", """
SELECT o_orderkey AS id, o_orderstatus AS st, o_totalprice AS amt,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS INTEGER) END AS cust FROM orders""")
def project_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = [F.col(c).cast("string") for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")]
    values = F.when(F.col("o_orderkey") % 3 == 0, F.array(*text[:3])).otherwise(
        F.array(*text, F.col("o_orderpriority")))
    rows = table(spark, sf_dir, "orders").select(row_by_position(values, SHAPE).alias("row"))
    return rows.select("row.*")


@query("project_by_name", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS st,
       o_totalprice AS amt, CAST(o_custkey AS INTEGER) AS cust FROM orders""")
def project_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = {"id": "o_orderkey", "st": "o_orderstatus", "amt": "o_totalprice", "cust": "o_custkey"}
    as_map = lambda names: F.create_map(
        *[x for n in names for x in (F.lit(n), F.col(pair[n]).cast("string"))])
    pairs = F.when(F.col("o_orderkey") % 3 == 0, as_map(["cust", "amt", "id"])).otherwise(
        as_map(["amt", "st", "id", "cust"]))
    rows = table(spark, sf_dir, "orders").select(pairs.alias("pairs"))
    return rows.select(row_by_name(F.col("pairs"), SHAPE).alias("row")).select("row.*")


@query("target_names", """
SELECT p_partkey, concat('lake_db', p_partkey % 10) AS target_db,
       concat('t', p_partkey % 7, CASE WHEN p_partkey % 2 = 0 THEN '_month' ELSE '' END, '_', p_partkey % 8) AS target_table,
       concat('/lake/lake_db', p_partkey % 10, '/t', p_partkey % 7,
              CASE WHEN p_partkey % 2 = 0 THEN '_month' ELSE '' END, '_', p_partkey % 8) AS target_path
FROM part""")
def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "concat('db', p_partkey % 10) AS db",
        "concat('t', p_partkey % 7, CASE WHEN p_partkey % 2 = 0 THEN '_month_[0-9]{6}' ELSE '' END) AS tbl",
        "p_partkey % 8 AS shard")
    names = routing.target_names(F.col("db"), F.col("tbl"), F.col("shard"), "/lake/")
    return named.select("p_partkey", *[c.alias(n) for n, c in names.items()])


@query("split_words", r"""
WITH p AS (SELECT CASE WHEN regexp_full_match(text, ',+') THEN []
                       ELSE string_split(regexp_replace(text, ',+$', ''), ',') END AS parts FROM documents)
SELECT md5(word) AS word_md5, count(*) AS n FROM (SELECT lower(unnest(parts)) AS word FROM p) GROUP BY ALL""")
def split_words_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = split_words(table(spark, sf_dir, "documents").select("text"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select(
        F.md5("word").alias("word_md5"), "n")


@query("row_filter", "SELECT event_id, user_id, value FROM events WHERE value >= 18")
def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("value") >= 18).select(
        "event_id", "user_id", "value")


@query("key_digits", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 2 THEN c_mktsegment WHEN 3 THEN ''
                  ELSE regexp_extract(c_name, '\\d+', 0) END AS key,
       CASE WHEN c_custkey % 4 = 3 THEN '' ELSE 'row' || c_custkey END AS record FROM customer""")
def key_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("CASE c_custkey % 4 WHEN 2 THEN c_mktsegment || '###row' || c_custkey"
                  " WHEN 3 THEN c_name || '###a###b' ELSE c_name || ' x9###row' || c_custkey END")
    key, record = digit_key(text)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", key.alias("key"), record.alias("record"))


@query("key_list_filter", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def key_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").filter("c_acctbal > 9000").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keep_keys(orders, keys, "o_custkey")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders routed by tag: orders, refunds, and one tag nobody listed."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS st",
        "CASE o_orderkey % 5 WHEN 0 THEN 'order.refunds' WHEN 1 THEN 'order.lost' ELSE 'order.orders' END AS _tag")


TAGGED = """
t AS (SELECT o_orderkey AS id, o_orderstatus AS st,
             CASE o_orderkey % 5 WHEN 0 THEN 'order.refunds' WHEN 1 THEN 'order.lost' ELSE 'order.orders' END AS tag
      FROM orders)"""
TAGS = ["order.orders", "order.refunds"]


@query("route_counts", "WITH " + TAGGED + """
SELECT CASE WHEN tag = 'order.lost' THEN 'unrouted' ELSE tag END AS target, count(*) AS n FROM t GROUP BY ALL""")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = tagged(spark, sf_dir)
    parts = {**routing.route(frame, TAGS), "unrouted": routing.unrouted(frame, TAGS)}
    counts = [part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("target"), "n")
              for name, part in parts.items()]
    return routing.union_routed(counts)


@query("union_routed", "WITH " + TAGGED + "SELECT tag, id, st FROM t WHERE tag <> 'order.lost'")
def union_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.keep_routed(tagged(spark, sf_dir), TAGS).withColumnRenamed("_tag", "tag")


@query("bucket_lookup", "WITH " + TAGGED + """
SELECT id, tag, CASE tag WHEN 'order.orders' THEN 432 WHEN 'order.refunds' THEN 3 END AS buckets FROM t""")
def bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = routing.with_bucket_count(tagged(spark, sf_dir), routing.bucket_counts(TAGS, [432, 3]))
    return counted.select("id", F.col("_tag").alias("tag"), "buckets")


@query("reset_tables", """
SELECT DISTINCT concat(p_brand, '.', p_type, '_', p_size % 10) AS "table" FROM part
WHERE concat(p_brand, '.', p_type, '_', p_size % 10)
  NOT IN (SELECT concat(p_brand, '.', p_type, '_', p_size % 10) FROM part WHERE p_size > 40)""")
def reset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    name = F.expr("concat(p_brand, '.', p_type, '_', p_size % 10) AS `table`")
    return still_processed(part.select(name).distinct(), part.filter("p_size > 40").select(name))


@query("kafka_rows", CH + f"""
SELECT concat('t_order_0', shard, '_orders') AS topic, CAST(id AS VARCHAR) AS key, {PART} AS partition,
       op, coalesce(a_st, b_st) AS st FROM ok""")
def kafka_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(feed_of(spark, sf_dir)))
    rows = kafka_rows(feed, ["id"], 4, produced_ms=F.col("ts_ms"), portable=True)
    rows = rows.withColumn("_v", F.from_json(
        F.col("value").cast("string"), "before struct<st: string>, after struct<st: string>, op string"))
    return rows.select("topic", F.col("key").cast("string").alias("key"), "partition", "_v.op",
                       F.coalesce("_v.after.st", "_v.before.st").alias("st"))


@query("kafka_key", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS key
FROM lineitem""")
def kafka_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.struct(F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("order"),
                   F.col("l_linenumber").alias("line"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", record_key(key, ["order", "line"]).alias("key"))


@query("kafka_partition", """
SELECT o_orderkey, CAST(CAST(concat('0x', substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 24 AS INTEGER)
       AS partition FROM orders""")
def kafka_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", key_partition(key, 24, portable=True).alias("partition"))


@query("topic_name", """
SELECT p_partkey, concat('t_', p_brand, '_', p_type) AS topic,
       concat('t_', lower(p_brand), '_', lower(p_type)) AS lower_topic FROM part""")
def topic_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, name = F.col("p_brand"), F.col("p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey", topic_name(db, name).alias("topic"),
        topic_name(db, name, lowercase=True).alias("lower_topic"))


@query("expand_changelog", CH + "SELECT topic, seq, id, _kind, _sub, st, amt FROM cl")
def expand_changelog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog(table(spark, sf_dir, "orders"))


@query("expand_flat_json", CH + "SELECT seq, id, _kind, _sub, st, amt FROM cl")
def expand_flat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = with_topic_parts(keep_changes(feed_of(spark, sf_dir)))
    texts = feed.select("seq", flat_record(F.col("ts_ms")).alias("value"))
    spec = TableSpec(name="order.orders", schema=ROW, key=("id",))
    return expand_flat_records(texts, spec).drop("op")


@query("current_state", CH + "SELECT topic, id, st, amt, seq FROM state")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_live(changelog(table(spark, sf_dir, "orders")), ORDERS.key).select(
        "topic", "id", "st", "amt", "seq")


def state_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows counted by status."""
    return current_state(spark, sf_dir).groupBy("st").agg(F.count(F.lit(1)).alias("n"))
