"""Chunked snapshots, silent keys, bounded redelivery, counted runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import chunks as chunk_rules
from tidewell.operators import intervals as sets
from tidewell.operators.discover import as_variant
from tidewell.operators.discover import discovered_columns as columns_in
from tidewell.operators.envelope import with_reject_reason
from tidewell.operators.merge import current_state
from tidewell.operators.routing import TAG
from tidewell.plans.feed import CH, ORDERS, change_feed, changelog
from tidewell.plans.registry import query, table, table_stream
from tidewell.plans.tables import COLUMNS, STATE
from tidewell.session import scratch_dir
from tidewell.spec import SUB
from tidewell.streaming.observed import Counts, start_routed
from tidewell.streaming.silence import silent_keys as silences
from tidewell.streaming.silence import without_redelivery

CHUNK_TABLE = "table string, chunk int, low bigint, high bigint, mark bigint"


@query("chunked_snapshot", STATE)
def chunked_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve chunks of ``orders``, read at positions 1 to 4, one of them twice and one
    across others; each row is as it was at its chunk's position."""
    changes = changelog(table(spark, sf_dir, "orders"))
    cuts = chunk_rules.even_chunks(table(spark, sf_dir, "orders"), "o_orderkey", 12)
    rows = chunk_rules.columns_of(cuts, "orders", [1 + i % 4 for i in range(len(cuts))])
    _, low, high = cuts[5 % len(cuts)]
    rows += [("orders", 100, low, high, 4), ("orders", 101, low, None if high is None else high + 5, 2)]
    chunks = spark.createDataFrame(rows, CHUNK_TABLE)
    snapshot = None
    for mark in (1, 2, 3, 4):
        # What a reader of these chunks sees: the table at their mark.
        at = current_state(changes.filter(F.col("seq") <= mark), ORDERS.key).withColumn("seq", F.lit(mark).cast("bigint"))
        reads = [F.when(chunk_rules.covering(F.col("id"), F.lit(low), F.lit(high)), F.lit(chunk))
                 for _, chunk, low, high, of in rows if of == mark]
        part = at.withColumn("chunk", F.explode(F.array_compact(F.array(*reads))))
        snapshot = part if snapshot is None else snapshot.unionByName(part)
    named = lambda frame: frame.withColumn("of", F.lit("orders"))
    feed = chunk_rules.chunked_snapshot(named(snapshot.withColumn(SUB, F.lit(9))), named(changes), chunks, "of", "id")
    return current_state(feed.drop("of"), ORDERS.key).select(*COLUMNS)


@query("chunk_offsets", """
WITH c AS (SELECT concat('t', o_custkey % 50) AS "table", o_orderkey AS chunk,
                  CASE WHEN o_custkey % 50 < 25 OR o_orderkey % 7 > 0 THEN o_orderkey % 1000 END AS mark FROM orders)
SELECT "table", count(*) AS n, count(mark) AS finished, min(mark) AS least_mark, max(mark) AS greatest_mark,
       count(*) = count(mark) AND max(mark) <= 995 AS passed FROM c GROUP BY 1""")
def chunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of many tables' snapshots; every order stands for a chunk."""
    chunks = table(spark, sf_dir, "orders").selectExpr(
        "concat('t', o_custkey % 50) AS `table`", "o_orderkey AS chunk",
        "CASE WHEN o_custkey % 50 < 25 OR o_orderkey % 7 > 0 THEN o_orderkey % 1000 END AS mark")
    return chunk_rules.chunk_offsets(chunks, 995)


GAP_MINUTES = 720
GAP = GAP_MINUTES * 60_000_000


@query("silent_keys", f"""
WITH e AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following, max(ts) OVER () AS latest FROM events)
SELECT user_id, epoch_us(ts) AS since FROM e
WHERE (following IS NULL OR epoch_us(following) - epoch_us(ts) > {GAP})
  AND (epoch_us(ts) + {GAP}) // 1000 + 1 <= epoch_us(latest) // 1000""")
def silent_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users without a record for half a day, by event time."""
    root = scratch_dir(spark, "silent")
    found = silences(table_stream(spark, sf_dir, "events"), "user_id", "ts", GAP_MINUTES)
    (found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    rows = spark.read.schema("key string, active_from timestamp, since timestamp").parquet(f"{root}/out")
    return rows.select(F.col("key").cast("bigint").alias("user_id"), F.unix_micros("since").alias("since"))


@query("windowed_dedup", "SELECT event_id, user_id, event_type FROM events")
def windowed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered up to three times, each kept once."""
    root = scratch_dir(spark, "dedup")
    stream = table_stream(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", F.explode(F.sequence(F.lit(0), F.col("event_id") % 3)).alias("copy"))
    kept = without_redelivery(stream, ["event_id"], "ts", "40 days").select("event_id", "user_id", "event_type")
    (kept.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("event_id bigint, user_id bigint, event_type string").parquet(f"{root}/out")


@query("observed_counts", CH + """
, o2 AS (SELECT CASE WHEN array_length(string_split(topic, '.')) = 1 THEN 'topic has one part'
                     WHEN op = 'd' AND id % 2 = 0 THEN 'no op' WHEN op = 'c' THEN 'unknown op'
                     WHEN shard = 7 THEN 'unrouted' ELSE 'accepted' END AS outcome FROM ch)
SELECT outcome, count(*) AS n FROM o2 GROUP BY outcome UNION ALL SELECT 'records', count(*) FROM ch""")
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted, rejected and unrouted records, from the run that writes them."""
    root = scratch_dir(spark, "observed")
    feed = change_feed(table_stream(spark, sf_dir, "orders")).withColumn(
        "op", F.expr("CASE WHEN op = 'c' THEN 'x' WHEN op = 'd' AND id % 2 = 0 THEN NULL ELSE op END"))
    records = with_reject_reason(feed).withColumn(TAG, F.get(F.split("topic", r"\."), F.lit(1)))
    listener = Counts()
    spark.streams.addListener(listener)
    try:
        run = start_routed(records, f"{root}/out", f"{root}/checkpoint", [f"order_0{i}" for i in range(7)], interval=None)
        run.awaitTermination()
        counts = listener.of(run, "routed")
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([(k, n) for k, n in counts.items() if n], "outcome string, n bigint")


@query("gtid_set_algebra", """
WITH n AS (SELECT concat('uuid-', o_custkey % 3) AS uuid, o_orderkey AS id, o_orderkey % 7 < 4 AS a, o_orderkey % 5 < 3 AS b FROM orders),
kinds AS (SELECT 'union' AS kind, uuid, id FROM n WHERE a OR b UNION ALL SELECT 'intersection', uuid, id FROM n WHERE a AND b
          UNION ALL SELECT 'difference', uuid, id FROM n WHERE a AND NOT b),
runs AS (SELECT *, id - row_number() OVER (PARTITION BY kind, uuid ORDER BY id) AS run FROM kinds)
SELECT kind, uuid, min(id) AS low, max(id) AS high FROM runs GROUP BY kind, uuid, run""")
def gtid_set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of sparse numbers on three servers: what both, one or only the first have seen."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "named_struct('gtid', concat('uuid-', o_custkey % 3, ':', o_orderkey)) AS source")
    a, b = sets.seen_intervals(rows.filter("id % 7 < 4")), sets.seen_intervals(rows.filter("id % 5 < 3"))
    kinds = {"union": sets.union, "intersection": sets.intersection, "difference": sets.difference}
    one, two, three = (of(a, b).select(F.lit(kind).alias("kind"), "uuid", "low", "high") for kind, of in kinds.items())
    return one.union(two).union(three)


@query("gtid_set_lookup", """
SELECT o_orderkey AS id, o_orderkey % 7 < 4 AND o_orderkey % 2 = 0 AS covered FROM orders""")
def gtid_set_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set with an interval for every few records, kept as rows and searched."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "named_struct('gtid', concat('uuid-', o_custkey % 3, ':', o_orderkey)) AS source")
    seen = sets.seen_intervals(rows.filter("id % 7 < 4 AND id % 2 = 0"))
    return sets.covered(rows, seen, F.col("source.gtid")).select("id", F.col("_covered").alias("covered"))


@query("discovered_columns", """
WITH e AS (SELECT count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS late, count(*) FILTER (event_id % 3 = 0 AND event_id % 2 = 0) AS nulls FROM events)
SELECT 'user' AS "column", 'BIGINT' AS type, n, 0 AS n_null FROM e UNION ALL SELECT 'kind', 'STRING', n, 0 FROM e
UNION ALL SELECT 'props', 'OBJECT<k: BIGINT>', n, 0 FROM e UNION ALL SELECT 'late', 'STRING', late, nulls FROM e""")
def discovered_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of images whose table is not known yet; one came with a later version of it."""
    late = F.expr("CASE WHEN event_id % 3 > 0 THEN '' WHEN event_id % 2 = 0 THEN ',\"late\":null' ELSE ',\"late\":\"yes\"' END")
    image = F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"),
                     F.lit('","props":'), F.col("props"), late, F.lit("}"))
    images = table(spark, sf_dir, "events").select(as_variant(image).alias("image"))
    return columns_in(images, "image")
