"""A change feed over eight shards, derived from ``orders``.

Each order gives a snapshot row, and by its number a redelivered snapshot row,
an update, a delete, a re-insert and a one-part topic. All records of an order
follow from its own row, so one scan makes the feed, in batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import keep_changes
from tidewell.spec import TableSpec

ROW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("st", T.StringType()),
    T.StructField("amt", T.DoubleType()),
])
KEY = T.StructType([T.StructField("id", T.LongType())])

ORDERS = TableSpec(name="order.orders", schema=T.StructType(
    [T.StructField("topic", T.StringType())] + ROW.fields), key=("id", "topic"))

START_MS = 1700000000000


def change_feed(orders: DataFrame) -> DataFrame:
    """Flat feed: topic, op, seq, id, and old and new status and amount."""
    rows = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").alias("amt"), (F.col("o_orderkey") % 8).alias("shard"))
    rows = rows.withColumn("topic", F.concat(F.lit("src.order_0"), F.col("shard").cast("string"),
                                             F.lit(".orders")))
    number, st, amt = F.col("id"), F.col("st"), F.col("amt")
    updated = number % 3 == 0
    last_st = F.when(updated, F.lit("U")).otherwise(st)
    last_amt = F.when(updated, amt + 1).otherwise(amt)
    no_st, no_amt = F.lit(None).cast("string"), F.lit(None).cast("double")

    def record(keep: Column, op: str, seq: int, b_st: Column, a_st: Column, b_amt: Column,
               a_amt: Column, topic: Column = F.col("topic")) -> Column:
        return F.struct(keep.alias("keep"), topic.alias("topic"), F.lit(op).alias("op"),
                        F.lit(seq).cast("bigint").alias("seq"), b_st.alias("b_st"),
                        a_st.alias("a_st"), b_amt.alias("b_amt"), a_amt.alias("a_amt"))

    records = F.array(
        record(F.lit(True), "r", 1, no_st, st, no_amt, amt),
        record(number % 5 == 0, "r", 1, no_st, st, no_amt, amt),
        record(updated, "u", 2, st, F.lit("U"), amt, amt + 1),
        record(number % 7 == 0, "d", 3, last_st, no_st, last_amt, no_amt),
        record(number % 21 == 0, "c", 4, no_st, F.lit("C"), no_amt, amt + 2),
        record(number % 100 == 0, "r", 5, no_st, no_st, no_amt, no_amt, F.lit("src")),
    )
    return (rows.select("id", "shard", F.explode(records).alias("_r")).filter("_r.keep")
            .select("_r.topic", "_r.op", "_r.seq", "id", "_r.b_st", "_r.a_st", "_r.b_amt",
                    "_r.a_amt", "shard"))


def envelopes(feed: DataFrame) -> DataFrame:
    """The feed in envelope form, with ``seq`` and ``shard`` kept beside it."""
    number = F.col("id")
    image = lambda s, a: F.struct(number.alias("id"), F.col(s).alias("st"), F.col(a).alias("amt"))
    return feed.select(
        "topic",
        F.struct(number.alias("id")).alias("key"),
        F.when(F.col("b_st").isNotNull(), image("b_st", "b_amt")).alias("before"),
        F.when(F.col("a_st").isNotNull(), image("a_st", "a_amt")).alias("after"),
        "op",
        (F.lit(START_MS) + number * 1000 + F.col("seq")).alias("ts_ms"),
        F.struct(
            F.concat(F.lit("mysql-bin.00000"), F.col("seq").cast("string")).alias("file"),
            (number * 100).alias("pos"),
            F.concat(F.lit("uuid-"), F.col("shard").cast("string"), F.lit(":"),
                     (number * 10 + F.col("seq")).cast("string")).alias("gtid"),
        ).alias("source"),
        "seq", "shard",
    )


def changelog(orders: DataFrame) -> DataFrame:
    """Accepted records as changelog rows: topic, seq, id, st, amt, _kind, _sub."""
    kept = keep_changes(envelopes(change_feed(orders)))
    return expand_changelog(kept.select("topic", "op", "seq", "before", "after")).drop("op")


# The same feed in SQL, for the query oracles.
CH = """
WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS st, o_totalprice AS amt,
                  o_orderkey % 8 AS shard FROM orders),
u AS (SELECT id, 'U' AS st, amt + 1 AS amt, shard FROM o WHERE id % 3 = 0),
ch0 AS (
 SELECT concat('src.order_0', shard, '.orders') AS topic, 'r' AS op, CAST(1 AS BIGINT) AS seq, id,
        CAST(NULL AS VARCHAR) AS b_st, st AS a_st, CAST(NULL AS DOUBLE) AS b_amt, amt AS a_amt, shard
   FROM o
 UNION ALL SELECT concat('src.order_0', shard, '.orders'), 'r', 1, id, NULL, st, NULL, amt, shard
   FROM o WHERE id % 5 = 0
 UNION ALL SELECT concat('src.order_0', u.shard, '.orders'), 'u', 2, u.id, o.st, u.st, o.amt, u.amt, u.shard
   FROM u JOIN o ON o.id = u.id
 UNION ALL SELECT concat('src.order_0', o.shard, '.orders'), 'd', 3, o.id, coalesce(u.st, o.st), NULL,
        coalesce(u.amt, o.amt), NULL, o.shard
   FROM o LEFT JOIN u ON u.id = o.id WHERE o.id % 7 = 0
 UNION ALL SELECT concat('src.order_0', shard, '.orders'), 'c', 4, id, NULL, 'C', NULL, amt + 2, shard
   FROM o WHERE id % 21 = 0
 UNION ALL SELECT 'src', 'r', 5, id, NULL, NULL, NULL, NULL, shard FROM o WHERE id % 100 = 0),
ch AS (SELECT *, 1700000000000 + id * 1000 + seq AS ts_ms,
              concat('mysql-bin.00000', seq) AS file, id * 100 AS pos,
              concat('uuid-', shard) AS uuid, id * 10 + seq AS txn FROM ch0),
ok AS (SELECT * FROM ch WHERE topic <> 'src'),
cl AS (
 SELECT topic, seq, id, '+I' AS _kind, 0 AS _sub, a_st AS st, a_amt AS amt FROM ok WHERE op IN ('c', 'r')
 UNION ALL SELECT topic, seq, id, '-D', 0, b_st, b_amt FROM ok WHERE op = 'd'
 UNION ALL SELECT topic, seq, id, '-U', 0, b_st, b_amt FROM ok WHERE op = 'u'
 UNION ALL SELECT topic, seq, id, '+U', 1, a_st, a_amt FROM ok WHERE op = 'u'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic, id ORDER BY seq DESC, _sub DESC) AS rn FROM cl),
state AS (SELECT topic, id, st, amt, seq FROM ranked WHERE rn = 1 AND _kind IN ('+I', '+U'))
"""
