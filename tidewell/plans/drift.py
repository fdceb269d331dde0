"""Lake tables over time: reopened, reset, partitioned, many at once; offsets in a circle."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.keys import key_hash
from tidewell.lake.maintenance import compact_all
from tidewell.lake.table import LakeTable
from tidewell.operators import offsets as offset_rules
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import keep_changes
from tidewell.plans.feed import CH, ORDERS, ROW, change_feed, changelog, envelopes
from tidewell.plans.registry import query, table
from tidewell.plans.tables import COLUMNS, STATE, lake_table
from tidewell.session import scratch_dir
from tidewell.sources.readers import as_snapshot
from tidewell.sources.startup import parse_start, start_from
from tidewell.streaming.jobs import start_upsert


@query("lake_reopened", STATE)
def lake_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with 8 buckets, opened again as it is stored, given 16, and written on."""
    root = scratch_dir(spark, "reopened")
    changes = changelog(table(spark, sf_dir, "orders"))
    first = LakeTable(spark, root, replace(ORDERS, buckets=8))
    first.append(changes.filter("seq <= 1"), 0, rebalance=False)
    first.compact()
    first.append(changes.filter("seq = 2"), 1, rebalance=False)
    second = LakeTable(spark, root)
    grown = second.evolve(replace(second.spec, buckets=16))
    grown.append(changes.filter("seq > 2"), 2, rebalance=False)
    grown.compact()
    return LakeTable(spark, root).read(COLUMNS).select(*COLUMNS)


@query("reset_and_replay", STATE)
def reset_and_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested in part and compacted; then all tasks go back to the low-water mark, and
    a new checkpoint takes the snapshot and the changes behind the mark into the
    same table."""
    target = lake_table(spark, sf_dir, "replay")
    orders = table(spark, sf_dir, "orders")
    feed = keep_changes(envelopes(change_feed(orders)))
    seen = "seq <= 2 OR CAST(split(source.gtid, ':')[1] AS bigint) <= 20000"

    def ingest(rows: DataFrame, label: str) -> None:
        path = f"{target.root}/feed-{label}"
        expand_changelog(rows.select("topic", "op", "seq", "before", "after")).drop("op").write.parquet(path)
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        start_upsert(stream, target, f"{target.root}/checkpoint-{label}", interval=None).awaitTermination()

    ingest(feed.filter(seen), "first")
    target.compact()
    # Each shard's task reports how far it was; the mark is what all have reached.
    reports = feed.groupBy("shard").agg(F.concat(
        F.lit("uuid-"), F.first("shard").cast("string"), F.lit(":1-20000")).alias("gtid_set"))
    mark = offset_rules.reset_offsets(reports).first().gtid_set
    topic = F.concat(F.lit("src.order_0"), (F.col("id") % 8).cast("string"), F.lit(".orders"))
    rows = orders.selectExpr("o_orderkey AS id", "o_orderstatus AS st", "o_totalprice AS amt")
    snapshot = as_snapshot(rows, topic, position=1).withColumn("before", F.lit(None).cast(ROW))
    later = start_from(feed, parse_start(f"gtid/{mark}"))
    columns = ["topic", "op", "seq", "before", "after"]
    ingest(snapshot.select(*columns).unionByName(later.select(*columns)), "second")
    return target.read(COLUMNS).select(*COLUMNS)


@query("partitioned_upsert", CH + "SELECT topic, id, amt FROM state WHERE st = 'U'")
def partitioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by the status, which updates change; one partition is read."""
    plain = lake_table(spark, sf_dir, "partitioned-lake")
    spec = replace(plain.spec, partitioned_by=("st",))
    target = LakeTable(spark, plain.root, spec)
    changes = changelog(table(spark, sf_dir, "orders"))
    target.append(changes.filter("seq <= 1"), 0, rebalance=False)
    target.compact()
    target.append(changes.filter("seq > 2"), 1, rebalance=False)
    target.compact()
    target.append(changes.filter("seq = 2"), 2, rebalance=False)  # late
    return target.read(where={"st": "U"}).select("topic", "id", "amt")


@query("compact_tables", STATE)
def compact_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables compacted side by side."""
    changes = changelog(table(spark, sf_dir, "orders"))
    targets = [lake_table(spark, sf_dir, f"many-{i}") for i in range(3)]
    for i, target in enumerate(targets):
        target.append(changes.filter((F.col("id") % 3 == i) & (F.col("seq") <= 2)), 0, rebalance=False)
        target.append(changes.filter((F.col("id") % 3 == i) & (F.col("seq") > 2)), 1, rebalance=False)
    errors = compact_all(targets)
    if errors:
        raise next(iter(errors.values()))
    one, two, three = (t.read(COLUMNS).select(*COLUMNS) for t in targets)
    return one.unionByName(two).unionByName(three)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per order; each shard's server numbers its own."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderkey % 8 AS shard",
        "named_struct('gtid', concat('uuid-', o_orderkey % 8, ':', o_orderkey div 8)) AS source")


@query("offsets_round_trip", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey // 8 NOT BETWEEN 10 AND 150")
def offsets_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tasks have seen becomes a set, the set a low-water mark, and the mark
    a start: exactly the records not seen come again."""
    feed = numbered(spark, sf_dir)
    seen = feed.filter("id div 8 BETWEEN 10 AND 150")
    offsets = offset_rules.source_gtid_set(seen, ["shard"])
    mark = offset_rules.gtid_low_water(offsets).first().gtid_set
    return offset_rules.after_gtid_set(feed, mark).select("id")


@query("key_hashes", CH + "SELECT count(*) AS keys, count(*) AS hashes FROM (SELECT DISTINCT topic, id FROM ok)")
def key_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(table(spark, sf_dir, "orders")).filter("topic <> 'src'").select("topic", "id").distinct()
    return feed.select(key_hash([F.col("topic"), F.col("id")]).alias("h")).agg(
        F.count(F.lit(1)).alias("keys"), F.count_distinct("h").alias("hashes"))


@query("incremental_offsets", "SELECT o_orderkey AS task FROM orders WHERE o_orderkey % 3 > 0")
def incremental_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS task", "CASE WHEN o_orderkey % 3 = 0 THEN 'snapshot' ELSE 'incremental' END AS kind")
    return offset_rules.incremental_offsets(offsets).select("task")


@query("declared_source", """
SELECT o_orderkey AS order_id, o_orderstatus AS channel FROM orders WHERE o_totalprice > 100000""")
def declared_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and sink both declared in SQL."""
    path, mark = scratch_dir(spark, "declared"), uuid.uuid4().hex
    spark.sql(f"CREATE TABLE source_{mark} USING parquet LOCATION '{sf_dir}/orders.parquet'")
    spark.sql(f"CREATE TABLE sink_{mark} (order_id BIGINT, channel STRING) USING parquet LOCATION '{path}'")
    spark.sql(f"INSERT INTO sink_{mark} SELECT o_orderkey, o_orderstatus FROM source_{mark} WHERE o_totalprice > 100000")
    for name in (f"source_{mark}", f"sink_{mark}"):
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)
