"""Lake tables and streams over the change feed."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.lake.catalog import CatalogTable
from tidewell.lake.sizing import buckets_for
from tidewell.lake.table import LakeTable
from tidewell.operators.merge import merge_on_read as merged
from tidewell.operators.merge import newest_versions
from tidewell.operators.envelope import keep_changes
from tidewell.plans.feed import CH, ORDERS, change_feed, changelog
from tidewell.plans.registry import query, table, table_stream
from tidewell.plans.rows import TAGGED, TAGS
from tidewell.session import scratch_dir
from tidewell.spec import KIND, SUB, TableSpec
from tidewell.streaming.inspect import state_changes as changes_of_state
from tidewell.streaming.jobs import Target, start_fan_out, start_upsert
from tidewell.streaming.repeated import repeated_keys_stateful, start_key_counts, start_repeated_keys

STATE = CH + "SELECT topic, id, st, amt FROM state"
COLUMNS = ["topic", "id", "st", "amt"]


def lake_table(spark: SparkSession, sf_dir: str, label: str) -> LakeTable:
    buckets = buckets_for(table(spark, sf_dir, "orders"))
    return LakeTable(spark, scratch_dir(spark, label), replace(ORDERS, buckets=buckets))


@query("merge_on_read", STATE)
def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = changelog(table(spark, sf_dir, "orders"))
    base = newest_versions(changes.filter("seq <= 2"), ORDERS.key)
    return merged(base, changes.filter("seq > 2"), ORDERS.key).select(*COLUMNS)


@query("lake_upsert_stream", STATE)
def lake_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = lake_table(spark, sf_dir, "upsert")
    changes = changelog(table_stream(spark, sf_dir, "orders"))
    start_upsert(changes, target, f"{target.root}/checkpoint", interval=None).awaitTermination()
    return target.read(COLUMNS).select(*COLUMNS)


def catalog_table(spark: SparkSession, sf_dir: str, label: str) -> CatalogTable:
    buckets = buckets_for(table(spark, sf_dir, "orders"))
    return CatalogTable(spark, f"{label}_{uuid.uuid4().hex}", replace(ORDERS, buckets=buckets), scratch_dir(spark, label))


@query("catalog_upsert_stream", STATE)
def catalog_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a table of the catalog, compacted between two runs; another session
    reads the merged rows by the table's name."""
    target = catalog_table(spark, sf_dir, "catalog_stream")
    feed = f"{target.root}/feed"
    changes = changelog(table(spark, sf_dir, "orders"))
    for part in ("seq <= 2", "seq > 2"):
        changes.filter(part).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(changes.schema).parquet(feed)
        start_upsert(stream, target, f"{target.root}/checkpoint", interval=None).awaitTermination()
        if part == "seq <= 2":
            target.compact()
            target.clean()
    return spark.newSession().table(target.name).select(*COLUMNS)


@query("key_lookup", CH + """SELECT topic, id, st, amt FROM state
WHERE id IN (SELECT (SELECT max(o_orderkey) FROM orders) * i // 8 FROM range(1, 9) t(i))""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of single keys, each from one bucket of base and log."""
    target = catalog_table(spark, sf_dir, "catalog_lookup")
    changes = changelog(table(spark, sf_dir, "orders"))
    target.append(changes.filter("seq <= 2"), 0)
    target.compact()
    target.append(changes.filter("seq > 2"), 1)
    most = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    found = None
    for number in sorted({most * i // 8 for i in range(1, 9)}):
        row = target.lookup(id=number, topic=f"src.order_0{number % 8}.orders").select(*COLUMNS)
        found = row if found is None else found.unionByName(row)
    return found


@query("compact_equals_read", STATE)
def compact_equals_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = lake_table(spark, sf_dir, "compact")
    changes = changelog(table(spark, sf_dir, "orders"))
    target.append(changes.filter("seq <= 2"), 0, rebalance=False)
    target.compact()
    target.append(changes.filter("seq > 2"), 1, rebalance=False)
    target.compact()
    return target.read(COLUMNS).select(*COLUMNS)


@query("lake_snapshot", CH + "SELECT st, count(*) AS n, min(id) AS least, max(id) AS most FROM state GROUP BY st")
def lake_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL, in another session, over the table's persisted view."""
    target = catalog_table(spark, sf_dir, "snapshot")
    changes = changelog(table(spark, sf_dir, "orders"))
    target.append(changes.filter("seq <= 2"), 0)
    target.compact()
    target.append(changes.filter("seq > 2"), 1)
    return spark.newSession().sql(
        f"SELECT st, count(*) AS n, min(id) AS least, max(id) AS most FROM {target.name} GROUP BY st")


@query("redelivery_idempotent", STATE)
def redelivery_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = lake_table(spark, sf_dir, "redelivery")
    changes = changelog(table(spark, sf_dir, "orders"))
    target.append(changes, 0, rebalance=False)
    target.append(changes, 0, rebalance=False)  # the same batch again: overwritten
    target.compact()
    target.append(changes.filter("seq <= 3"), 1, rebalance=False)  # older records again: they lose
    return target.read(COLUMNS).select(*COLUMNS)


@query("resume_stream", STATE)
def resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one application over a feed that grows between them."""
    target = lake_table(spark, sf_dir, "resume")
    feed = f"{target.root}/feed"
    changes = changelog(table(spark, sf_dir, "orders"))
    for part in ("seq <= 2", "seq > 2"):
        changes.filter(part).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(changes.schema).parquet(feed)
        start_upsert(stream, target, f"{target.root}/checkpoint", interval=None).awaitTermination()
    return target.read(COLUMNS).select(*COLUMNS)


ROUTED = TableSpec(name="order.routed", key=("id",), order=("id", SUB), schema=T.StructType([
    T.StructField("id", T.LongType()), T.StructField("st", T.StringType())]))


@query("fan_out", "WITH " + TAGGED + "SELECT tag, id, st FROM t WHERE tag <> 'order.lost'")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "fanout")
    buckets = buckets_for(table(spark, sf_dir, "orders"))
    spec = replace(ROUTED, buckets=buckets)
    targets = {tag: Target(LakeTable(spark, f"{root}/{tag}", replace(spec, name=tag))) for tag in TAGS}
    stream = table_stream(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS st", f"'+I' AS {KIND}", f"0 AS {SUB}",
        "CASE o_orderkey % 5 WHEN 0 THEN 'order.refunds' WHEN 1 THEN 'order.lost' ELSE 'order.orders' END AS _tag")
    start_fan_out(stream, targets, f"{root}/checkpoint", interval=None).awaitTermination()
    one, two = (t.table.read().select(F.lit(tag).alias("tag"), "id", "st") for tag, t in targets.items())
    return one.unionByName(two)


REPEATED = CH + "SELECT concat(topic, '|', id) AS key FROM ok GROUP BY ALL HAVING count(*) > 1"


def key_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = keep_changes(change_feed(table_stream(spark, sf_dir, "orders")))
    return feed.select(F.concat_ws("|", "topic", "id").alias("k"))


@query("repeated_keys", REPEATED)
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "repeated")
    start_repeated_keys(key_stream(spark, sf_dir), "k", root, interval=None)
    return spark.read.schema("key string").parquet(f"{root}/keys")


@query("state_changes", """
WITH b AS (SELECT unnest([0, 1, 2]) AS batch_id), e AS (SELECT CAST(user_id AS VARCHAR) AS k, event_id % 3 AS part FROM events),
now AS (SELECT DISTINCT part, k FROM e),
upto AS (SELECT now.part, k, (SELECT count(*) FROM e WHERE e.k = now.k AND e.part <= now.part) AS n FROM now)
SELECT batch_id, count(k) AS changed, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, max(n) AS most
FROM b JOIN upto ON part = batch_id GROUP BY batch_id""")
def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch wrote to the counts of ``start_key_counts``: keys, and their new counts."""
    root = scratch_dir(spark, "state-changes")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id")
    for part in range(3):
        rows.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/feed")
        start_key_counts(stream, "user_id", root, interval=None).awaitTermination()
    return (changes_of_state(spark, f"{root}/checkpoint-count").filter("change_type = 'update'")
            .groupBy("batch_id").agg(F.count(F.lit(1)).alias("changed"), F.sum("value.count").alias("total"),
                                     F.max("value.count").alias("most")))


@query("keyed_state", REPEATED)
def keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stateful")
    keys = repeated_keys_stateful(key_stream(spark, sf_dir), "k")
    (keys.writeStream.format("parquet").option("path", f"{root}/keys")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.schema("key string").parquet(f"{root}/keys")


@query("insert_select", """
SELECT o_orderkey AS order_id, o_orderstatus AS channel, o_totalprice AS pay_amount FROM orders""")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = scratch_dir(spark, "insert"), f"sink_{uuid.uuid4().hex}"
    source = f"source_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(source)
    spark.sql(f"CREATE TABLE {name} (order_id BIGINT, channel STRING, pay_amount DOUBLE) "
              f"USING parquet LOCATION '{path}'")
    spark.sql(f"INSERT INTO {name} SELECT o_orderkey, o_orderstatus, o_totalprice FROM {source}")
    spark.sql(f"DROP TABLE {name}")
    spark.catalog.dropTempView(source)
    return spark.read.parquet(path)


@query("partitioned_write", """
SELECT o_orderkey AS order_id, o_totalprice AS pay_amount, strftime(o_orderdate, '%Y-%m') AS order_month
FROM orders""")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "partitioned")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_totalprice AS pay_amount",
        "date_format(o_orderdate, 'yyyy-MM') AS order_month")
    rows.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(path)
    schema = "order_id bigint, pay_amount double, order_month string"
    return spark.read.schema(schema).parquet(path)
