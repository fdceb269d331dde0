"""Records as text to typed rows: envelopes, temporal profiles, rejects, shards."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.lake.sizing import buckets_for
from tidewell.lake.table import LakeTable
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import REJECT, accepted
from tidewell.operators.merge import current_state
from tidewell.operators.offsets import source_sequence
from tidewell.operators.typed import typed_envelopes, typed_records
from tidewell.plans.feed import CH, ORDERS, change_feed, envelopes
from tidewell.plans.registry import query, table, table_stream
from tidewell.session import scratch_dir
from tidewell.spec import SUB, TableSpec
from tidewell.streaming.jobs import start_fan_out, typed_target

ZONE = "Asia/Shanghai"

MANY = TableSpec(
    name="order.many", key=("id",), schema=T.StructType([
        T.StructField("id", T.LongType()), T.StructField("st", T.StringType()),
        T.StructField("amt", T.DoubleType()), T.StructField("small", T.ShortType()),
        T.StructField("flag", T.BooleanType()), T.StructField("day", T.DateType()),
        T.StructField("dt", T.TimestampNTZType()), T.StructField("dt6", T.TimestampNTZType()),
        T.StructField("ts", T.TimestampNTZType()), T.StructField("tm", T.IntegerType()),
        T.StructField("price", T.DecimalType(20, 2)), T.StructField("raw", T.BinaryType())]),
    source_types={"day": "date", "dt": "datetime", "dt6": "datetime(6)", "ts": "timestamp", "tm": "time(6)",
                  "price": "decimal(20,2)"})


def many_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An envelope text per order, every column as a connector writes it. Odd orders
    are snapshot rows, even ones are updates."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS st", "o_totalprice AS amt",
        "o_orderkey % 30000 - 15000 AS small", "o_orderkey % 2 AS flag",
        "unix_date(CAST(o_orderdate AS date)) AS n_day",
        "CAST(o_orderdate AS date) AS d", "o_orderkey % 86400 AS second")
    at = F.timestamp_add("SECOND", F.col("second").cast("bigint"), F.col("d").cast("timestamp_ntz"))
    millis = F.col("n_day").cast("bigint") * 86400000 + F.col("second") * 1000
    cents = F.lpad(F.hex(F.col("id") * 7 - 5000), 16, "0")
    image = F.struct(
        "id", "st", "amt", "small", "flag", F.col("n_day").alias("day"), millis.alias("dt"),
        (millis * 1000 + F.col("id") % 1000000).alias("dt6"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        (F.col("second") * 1000000).alias("tm"), F.base64(F.unhex(cents)).alias("price"),
        F.base64(F.col("st").cast("binary")).alias("raw"))
    update = F.col("id") % 2 == 0
    whole = F.struct(F.lit("src.order_00.many").alias("topic"), F.when(update, image).alias("before"),
                     image.alias("after"), F.when(update, "u").otherwise("r").alias("op"),
                     millis.alias("ts_ms"))
    return rows.select(F.to_json(whole).alias("value"), F.col("id").alias("offset"))


SECOND = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400)"


@query("typed_envelope", f"""
SELECT o_orderkey AS id, o_orderstatus AS st, o_totalprice AS amt, CAST(o_orderkey % 30000 - 15000 AS SMALLINT) AS small,
       o_orderkey % 2 = 1 AS flag, CAST(o_orderdate AS DATE) AS day, {SECOND} AS dt,
       {SECOND} + to_microseconds(o_orderkey % 1000000) AS dt6, {SECOND} + INTERVAL 8 HOUR AS ts,
       CAST(o_orderkey % 86400 * 1000 AS INTEGER) AS tm, (o_orderkey * 7 - 5000) / 100.0 AS price,
       o_orderstatus AS raw_text, o_orderkey AS "offset" FROM orders""")
def typed_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(typed_envelopes(many_envelopes(spark, sf_dir), MANY, zone=ZONE))
    newest = expand_changelog(rows).filter("_kind <> '-U'")
    return newest.select(*[c for c in MANY.columns if c not in ("price", "raw")],
                         F.col("price").cast("double").alias("price"),
                         F.col("raw").cast("string").alias("raw_text"), "offset")


TEXTS = TableSpec(name="order.texts", key=("id",), source_types=MANY.source_types, schema=T.StructType(
    [T.StructField("id", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("day", "dt", "ts", "tm")]))


def _stamp(shift: str, form: str, tail: str = "") -> str:
    return f"strftime({SECOND} {shift} INTERVAL 8 HOUR, '{form}') || '{tail}'"


@query("temporal_rules", f"""
WITH t AS (SELECT o_orderkey AS id, o_orderkey % 2 = 1 AS snap, strftime(o_orderdate, '%Y-%m-%d') AS day,
                  strftime({SECOND}, '%H:%M:%S') AS tm, strftime({SECOND}, '%Y-%m-%d %H:%M:%S') AS dt,
                  {_stamp('-', '%Y-%m-%d %H:%M:%S')} AS back, {_stamp('+', '%Y-%m-%d %H:%M:%S')} AS ahead,
                  {_stamp('-', '%Y-%m-%dT%H:%M:%S', 'Z')} AS iso_back,
                  {_stamp('+', '%Y-%m-%dT%H:%M:%S', '+08:00')} AS iso_ahead FROM orders)
SELECT id, 'plain' AS profile, day, dt, CASE WHEN snap THEN back ELSE ahead END AS ts, tm FROM t
UNION ALL SELECT id, 'lake', day || 'Z', iso_back, CASE WHEN snap THEN iso_back ELSE iso_ahead END, tm || 'Z' FROM t""")
def temporal_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both profiles, for snapshot rows and later changes."""
    lines = many_envelopes(spark, sf_dir)

    def written(profile: str) -> DataFrame:
        rows = accepted(typed_envelopes(lines, TEXTS, zone=ZONE, profile=profile))
        return rows.select("after.id", F.lit(profile).alias("profile"), "after.day", "after.dt", "after.ts", "after.tm")

    return written("plain").unionByName(written("lake"))


ORDER_USERS = TableSpec(name="order.users", key=("order_id",), schema=T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("user_id", T.IntegerType()),
    T.StructField("pay", T.DecimalType(12, 2))]))


@query("reject_rows", """
SELECT o_orderkey AS "offset", CASE
  WHEN o_orderkey % 11 = 0 THEN 'malformed text' WHEN o_orderkey % 13 = 0 THEN 'unknown op'
  WHEN o_orderkey % 17 = 0 THEN 'no image' WHEN o_orderkey % 7 = 0 AND o_orderkey % 5 = 0 THEN 'lost value: user_id,pay'
  WHEN o_orderkey % 7 = 0 THEN 'lost value: user_id' WHEN o_orderkey % 5 = 0 THEN 'lost value: pay'
  WHEN o_orderkey % 19 = 0 THEN 'null key' END AS reason FROM orders""")
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record, with the reason why it is not for the table. Users were retyped
    from text to integer; some hold letters."""
    key = F.col("o_orderkey")
    image = F.struct(F.when(key % 19 != 0, key).alias("order_id"),
                     F.concat(F.when(key % 7 == 0, "jk").otherwise(""), "o_custkey").alias("user_id"),
                     F.when(key % 5 == 0, F.lit("1" * 39)).otherwise("12.50").alias("pay"))
    record = F.struct(F.lit("order_01").alias("db"), F.lit("users").alias("table"),
                      F.when(key % 13 == 0, "x").otherwise("c").alias("op"),
                      F.when(key % 17 != 0, image).alias("after"))
    text = F.when(key % 11 == 0, F.lit("{not json")).otherwise(F.to_json(record))
    lines = table(spark, sf_dir, "orders").select(key.alias("offset"), text.alias("value"))
    return typed_records(lines, ORDER_USERS).select("offset", F.col(REJECT).alias("reason"))


SHARDED = TableSpec(name="order.sharded", key=("id",), order=("offset", SUB), schema=T.StructType([
    T.StructField("id", T.LongType()), T.StructField("st", T.StringType())])).with_shard()


@query("sharded_fan_out", """
SELECT concat('0_0', o_orderkey % 8) AS shard, o_orderkey // 8 AS id, o_orderstatus AS st FROM orders""")
def sharded_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight databases with equal ids, one logical table: the shard keeps them apart."""
    root = scratch_dir(spark, "sharded")
    record = F.to_json(F.struct(
        F.concat(F.lit("order_0"), (F.col("o_orderkey") % 8).cast("string")).alias("db"),
        F.lit("sharded").alias("table"), F.lit("c").alias("op"),
        F.struct(F.floor(F.col("o_orderkey") / 8).alias("id"), F.col("o_orderstatus").alias("st")).alias("after")))
    stream = table_stream(spark, sf_dir, "orders").select(
        record.alias("value"), F.col("o_orderkey").alias("offset"), F.lit(SHARDED.name).alias("_tag"))
    spec = replace(SHARDED, buckets=buckets_for(table(spark, sf_dir, "orders")))
    target = LakeTable(spark, f"{root}/lake", spec)
    start_fan_out(stream, {spec.name: typed_target(target, shard=0)}, f"{root}/checkpoint",
                  interval=None).awaitTermination()
    return target.read().select(F.col("_shard").alias("shard"), "id", "st")


@query("write_ahead_feed", CH + "SELECT topic, id, st, amt FROM state")
def write_ahead_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose records carry the number of a write-ahead log instead of a position."""
    feed = envelopes(change_feed(table(spark, sf_dir, "orders"))).filter("topic <> 'src'")
    source = F.struct(F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("pos"),
                      F.lit(None).cast("string").alias("gtid"), (F.col("ts_ms") + F.col("seq")).alias("lsn"))
    logged = feed.withColumn("source", source)
    rows = logged.select("topic", "op", source_sequence("lsn").alias("seq"), "before", "after")
    return current_state(expand_changelog(rows).drop("op"), ORDERS.key).select("topic", "id", "st", "amt")
