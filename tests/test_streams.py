import json
import os
import subprocess
import sys
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.lake.table import LakeTable
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import keep_changes
from tidewell.operators.routing import logical_tag
from tidewell.operators.offsets import after_gtid_set
from tidewell.plans.feed import KEY, ORDERS, ROW, changelog, envelopes, change_feed
from tidewell.plans.registry import table
from tidewell.session import scratch_dir
from tidewell.sources.readers import (
    KAFKA_SCHEMA, from_offsets, from_time, split_words, stream_feed_text, value_text)
from tidewell.spec import TableSpec
from tidewell.streaming.jobs import Target, checkpoint_for, fan_out, last_progress, start_console, start_fan_out, start_upsert, stored_state, typed_target
from tidewell.streaming.repeated import SecondSighting, repeated_keys, repeated_keys_stateful, start_repeated_keys

SF = "/root/testdata/sf0.001"
IDS = TableSpec(name="t", key=("id",), buckets=2, schema=T.StructType([T.StructField("id", T.LongType())]))


def test_text_feed_to_lake_in_small_batches_and_resumed(spark):
    root = scratch_dir(spark, "stream")
    lines = envelopes(change_feed(table(spark, SF, "orders"))).drop("shard").withColumn("n", F.col("seq"))
    target = LakeTable(spark, f"{root}/lake", ORDERS)
    check = checkpoint_for(f"{root}/checkpoints", "orders")
    assert last_progress(spark, f"{root}/checkpoints", "orders") is None
    for low, high in ((1, 2), (3, 9)):
        part = lines.filter(F.col("n").between(low, high)).drop("n", "seq")
        part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(f"{root}/feed")
        stream = keep_changes(stream_feed_text(spark, f"{root}/feed", ROW, KEY, files_per_trigger=1))
        # The log file number and the transaction give the order.
        seq = F.substring("source.file", -1, 1).cast("bigint")
        changes = expand_changelog(stream.select("topic", "op", seq.alias("seq"), "before", "after")).drop("op")
        start_upsert(changes, target, check, interval=None).awaitTermination()
    assert target.commits().count() >= 2
    assert last_progress(spark, f"{root}/checkpoints", "orders") is not None
    from tidewell.operators.merge import current_state
    expected = {tuple(r) for r in current_state(changelog(table(spark, SF, "orders")), ORDERS.key)
                .select("topic", "id", "st", "amt").collect()}
    assert {tuple(r) for r in target.read().select("topic", "id", "st", "amt").collect()} == expected


def number_stream(spark, root, ids, append=True):
    spark.createDataFrame([(i,) for i in ids], "id bigint").write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema("id bigint").parquet(f"{root}/in")


def test_fan_out_writes_each_table_and_replays_in_place(spark):
    root = scratch_dir(spark, "fan")
    targets = {tag: Target(LakeTable(spark, f"{root}/{tag}", IDS),
                           lambda rows: rows.withColumns({"seq": F.lit(1), "_sub": F.lit(0), "_kind": F.lit("+I")}))
               for tag in ("even", "odd")}
    stream = number_stream(spark, root, range(10)).withColumn(
        "_tag", F.when(F.col("id") == 9, "lost").when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    start_fan_out(stream, targets, f"{root}/c", interval=None).awaitTermination()
    got = {tag: sorted(r.id for r in t.table.read().collect()) for tag, t in targets.items()}
    assert got == {"even": [0, 2, 4, 6, 8], "odd": [1, 3, 5, 7]}
    lost = spark.read.parquet(f"{root}/c/rejects")
    assert [(r.reason, json.loads(r.record)["id"], r.target) for r in lost.collect()] == [("unknown table", 9, "_unrouted")]
    # Another checkpoint is another writer; the same rows again change nothing.
    start_fan_out(stream, targets, f"{root}/c2", interval=None).awaitTermination()
    assert targets["even"].table.log().count() == 10 and targets["even"].table.read().count() == 5


def test_two_streams_and_a_new_checkpoint_keep_all_rows(spark):
    root = scratch_dir(spark, "two")
    table = LakeTable(spark, f"{root}/lake", IDS)
    row = {"seq": F.lit(1), "_sub": F.lit(0), "_kind": F.lit("+I")}
    for part in range(2):
        stream = number_stream(spark, f"{root}/{part}", range(5 * part, 5 * part + 5)).withColumns(row)
        start_upsert(stream, table, f"{root}/c{part}", interval=None).awaitTermination()
    assert table.read().count() == 10
    table.compact()
    again = number_stream(spark, f"{root}/3", range(8, 14)).withColumns({**row, "seq": F.lit(99)})
    start_upsert(again, table, f"{root}/c3", interval=None).awaitTermination()
    assert table.read().count() == 14 and table.read().filter("seq = 99").count() == 6


def test_processing_time_trigger(spark):
    root = scratch_dir(spark, "interval")
    table = LakeTable(spark, f"{root}/lake", IDS)
    stream = number_stream(spark, root, range(3)).withColumns({"seq": F.lit(1), "_sub": F.lit(0), "_kind": F.lit("+I")})
    query = start_upsert(stream, table, f"{root}/c", interval="1 second")
    try:
        query.processAllAvailable()
        assert table.read().count() == 3
    finally:
        query.stop()


def test_flat_records_to_tables_of_different_schema(spark):
    """Kafka-shaped flat JSON, routed by tag, each table typed by its own spec."""
    root = scratch_dir(spark, "typed")
    users = TableSpec(name="db.users", key=("user_id",), order=("offset", "_sub"), buckets=2,
                      source_types={"created_at": "timestamp"}, schema=T.StructType([
                          T.StructField("user_id", T.IntegerType()), T.StructField("locked", T.BooleanType()),
                          T.StructField("created_at", T.TimestampNTZType())]))
    orders = TableSpec(name="db.orders", key=("order_id",), order=("offset", "_sub"), buckets=2,
                       schema=T.StructType([T.StructField("order_id", T.StringType()),
                                            T.StructField("pay_amount", T.DoubleType())]))
    user = {"user_id": 1, "locked": 0, "created_at": "2023-07-01 12:00:00"}
    lines = [
        {"db": "db_01", "table": "users", "op": "c", "after": user},
        {"db": "db_02", "table": "orders", "op": "r", "after": {"order_id": "ab1", "pay_amount": 30}},
        {"db": "db_01", "table": "users", "op": "u", "before": user, "after": {**user, "locked": 1}},
        {"db": "db_02", "table": "orders", "op": "d", "before": {"order_id": "ab1", "pay_amount": 30}},
        {"db": "db_02", "table": "orders", "op": "c", "after": {"order_id": "ab2", "pay_amount": 1.5, "new": 1}},
        {"db": "db_02", "table": "ghosts", "op": "c", "after": {"x": 1}},
        {"db": "db_01", "table": "users", "op": "c", "after": {"user_id": "3000000000"}},
        {"db": "db_01", "table": "users", "op": "c", "after": {"user_id": "x1"}},
        {"db": "db_01", "table": "users", "op": "x", "after": user},
        {"db": "db_01", "table": "users", "op": "u", "after": user},
        {"db": "db_01", "table": "users", "op": "c", "after": {"user_id": None}}]
    rows = [(i, json.dumps(line)) for i, line in enumerate(lines)]
    spark.createDataFrame(rows, "offset bigint, value string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("offset bigint, value string").parquet(f"{root}/in")
    at = F.from_json("value", "db string, `table` string")
    tagged = stream.withColumn("_tag", logical_tag(at["db"], at["table"]))
    targets = {s.name: typed_target(LakeTable(spark, f"{root}/{s.name}", s)) for s in (users, orders)}
    start_fan_out(tagged, targets, f"{root}/c", interval=None).awaitTermination()
    row = targets["db.users"].table.read().first()
    assert (row.user_id, row.locked, str(row.created_at)) == (1, True, "2023-07-01 12:00:00")
    assert [(r.order_id, r.pay_amount) for r in targets["db.orders"].table.read().collect()] == [("ab2", 1.5)]
    lost = spark.read.parquet(f"{root}/c/rejects").collect()
    assert sorted((r.target, r.reason) for r in lost) == [
        ("_unrouted", "unknown table"), ("db.users", "lost value: user_id"), ("db.users", "lost value: user_id"),
        ("db.users", "no image"), ("db.users", "null key"), ("db.users", "unknown op")]
    # Accepted and rejected records add up, and a reject has its raw text and offset.
    assert targets["db.users"].table.log().count() + targets["db.orders"].table.log().count() + len(lost) == len(lines)
    kept = {json.loads(r.record)["offset"]: json.loads(r.record) for r in lost}
    assert json.loads(kept[6]["_raw"]) == lines[6] and json.loads(kept[5]["value"]) == lines[5]


def test_shards_of_one_table_stay_apart(spark):
    root = scratch_dir(spark, "shards")
    spec = TableSpec(name="db.t", key=("id",), order=("offset", "_sub"), buckets=2, schema=T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])).with_shard()
    lines = [{"db": f"db_0{s}", "table": "t", "op": "c", "after": {"id": 1, "v": str(s)}} for s in range(3)]
    lines.append({"db": "db_01", "table": "t", "op": "d", "before": {"id": 1, "v": "1"}})
    (spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)], "offset bigint, value string")
     .write.parquet(f"{root}/in"))
    stream = spark.readStream.schema("offset bigint, value string").parquet(f"{root}/in").withColumn("_tag", F.lit("db.t"))
    table = LakeTable(spark, f"{root}/t", spec)
    start_fan_out(stream, {"db.t": typed_target(table, shard=0)}, f"{root}/c", interval=None).awaitTermination()
    assert sorted((r._shard, r.id, r.v, len(r._write_time)) for r in table.read().collect()) == [
        ("0_00", 1, "0", 19), ("0_02", 1, "2", 19)]


@pytest.mark.parametrize("stateful", [False, True])
def test_repeated_keys_are_reported_once_over_restarts(spark, stateful):
    root = scratch_dir(spark, "rep")
    rounds = [[1, 2, 2, 3], [1, 2, 4], [1, 4, 4, 5]]
    for ids in rounds:
        stream = number_stream(spark, root, ids)
        if stateful:
            keys = repeated_keys_stateful(stream, "id")
            (keys.writeStream.format("parquet").option("path", f"{root}/keys")
             .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination())
        else:
            start_repeated_keys(stream, "id", root, interval=None)
    got = sorted(r.key for r in spark.read.schema("key string").parquet(f"{root}/keys").collect())
    assert got == ["1", "2", "4"]
    if not stateful:
        counts = {r.key[0]: r.value[0] for r in stored_state(spark, f"{root}/checkpoint-count").collect()}
        assert counts == {"1": 3, "2": 3, "3": 1, "4": 3, "5": 1}
    flat = spark.createDataFrame([(i,) for ids in rounds for i in ids], "id bigint")
    assert sorted(r.key for r in repeated_keys(flat, "id").collect()) == got


def test_keyed_state_is_held_by_groups_of_keys(spark):
    """Calls and state rows follow the groups, however many keys there are."""
    root, seen = scratch_dir(spark, "groups"), Counter()
    for ids in ([*range(200)], [*range(150, 300), 7, 7], [*range(290, 310)] * 2):
        keys = repeated_keys_stateful(number_stream(spark, root, ids), "id", groups=4)
        query = (keys.writeStream.format("parquet").option("path", f"{root}/keys")
                 .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start())
        query.awaitTermination()
        seen.update(ids)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    got = [int(r.key) for r in spark.read.parquet(f"{root}/keys").collect()]
    assert sorted(got) == sorted(k for k, n in seen.items() if n > 1)


def test_a_key_is_forgotten_while_its_group_lives_on():
    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    value, sighting = Value(), SecondSighting(100)
    sighting.init(SimpleNamespace(getValueState=lambda *_: value))

    def at(now, *names):
        rows = [pd.DataFrame({"key": [k], "n": [1]}) for k in names]
        times = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        return [k for frame in sighting.handleInputRows((0,), iter(rows), times) for k in frame["key"]]

    assert at(0, "a", "b") == [] and at(99, "a", "c") == ["a"]
    assert at(100, "b") == []            # first seen at 0, forgotten at 100
    assert at(150, "a", "b") == ["b"]    # a was reported at 99
    assert at(198, "c", "a") == ["c"] and at(199, "a") == [] and at(200, "a") == ["a"]


def test_gtid_filter_on_a_stream(spark):
    root = scratch_dir(spark, "gtid")
    stream = number_stream(spark, root, range(20)).select(
        "id", F.concat(F.lit("u:"), F.col("id").cast("string")).alias("g"))
    kept = after_gtid_set(stream, "u:0-4:10-12", "g")
    (kept.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c")
     .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == [
        *range(5, 10), *range(13, 20)]


def test_word_stream_to_console(spark):
    root = scratch_dir(spark, "words")
    spark.createDataFrame([("Aa,bB,,",), (",,",), ("",)], "value string").write.text(f"{root}/in")
    words = split_words(spark.read.text(f"{root}/in"))
    assert sorted(r.word for r in words.collect()) == ["", "aa", "bb"]
    stream = split_words(spark.readStream.text(f"{root}/in"))
    query = start_console(stream, f"{root}/c")
    query.awaitTermination()
    assert query.lastProgress["sink"]["numOutputRows"] == 3


def test_kafka_shape(spark):
    rows = [(b"k", b"v", "t", p, o, None) for p in (0, 1) for o in range(5)]
    frame = spark.createDataFrame(rows, KAFKA_SCHEMA).withColumn("timestamp", F.timestamp_millis(F.col("offset") * 1000))
    committed = spark.createDataFrame([("t", 0, 3)], "topic string, partition int, next_offset bigint")
    assert sorted((r.partition, r.offset) for r in from_offsets(frame, committed).collect()) == [
        (0, 3), (0, 4)] + [(1, o) for o in range(5)]
    assert from_time(frame, 3000).count() == 4
    assert value_text(frame).first().value == "v"


@pytest.mark.parametrize("bad", [False, True])
def test_fan_out_reads_and_converts_each_record_once(spark, bad):
    """However many tables there are, and whether or not some records are rejected."""
    root, count = scratch_dir(spark, "once"), spark.sparkContext.accumulator
    read, converted = count(0), count(0)

    def seen(counter):
        def touch(x):
            counter.add(1)
            return x
        return F.udf(touch, "bigint").asNondeterministic()

    def project(rows):
        reason = F.when((F.col("id") % 10 == 0) & F.lit(bad), F.lit("tenth"))
        return rows.withColumn("id", seen(converted)("id")).withColumns(
            {"seq": F.lit(1), "_sub": F.lit(0), "_kind": F.lit("+I"), "_reject": reason})

    targets = {f"t{i}": Target(LakeTable(spark, f"{root}/t{i}", IDS), project) for i in range(7)}
    batch = spark.range(0, 700, 1, 4).select(seen(read)("id").alias("id")).withColumn("_tag", F.concat(F.lit("t"), F.col("id") % 7))
    fan_out(targets, rejects=f"{root}/rejects", staging=f"{root}/staging")(batch, 0)
    assert (read.value, converted.value) == (700, 700)
    kept = {name: sorted(r.id for r in t.table.read().collect()) for name, t in targets.items()}
    assert kept == {f"t{i}": [x for x in range(i, 700, 7) if not bad or x % 10] for i in range(7)}
    if bad:
        assert spark.read.parquet(f"{root}/rejects").count() == 70


FAN_OUT_LOGGED = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tidewell.lake.table import LakeTable
from tidewell.spec import TableSpec
from tidewell.streaming.jobs import OPEN_FILES, Target, fan_out
root = sys.argv[1]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", f"file://{root}/events").config("spark.sql.warehouse.dir", f"{root}/tables").getOrCreate())
spec = TableSpec(name="t", key=("id",), buckets=2, schema=T.StructType([T.StructField("id", T.LongType())]))
row = {"seq": F.lit(1), "_sub": F.lit(0), "_kind": F.lit("+I")}
targets = {f"t{i}": Target(LakeTable(spark, f"{root}/t{i}", spec), lambda rows: rows.withColumns(row)) for i in range(3)}
tag = F.when(F.col("id") % 10 < 8, "t0").when(F.col("id") % 10 == 8, "t1").otherwise("t2")
batch = spark.range(200000).withColumn("_tag", tag)
fan_out(targets, staging=f"{root}/staging")(batch, 0)
assert spark.conf.get(OPEN_FILES) == "0"
assert [spark.read.parquet(f"{root}/t{i}/log").count() for i in range(3)] == [160000, 20000, 20000]
spark.stop()
"""


def test_fan_out_sorts_no_records(tmp_path):
    """The memory of a task does not grow with a tag's records: the event log tells."""
    (tmp_path / "events").mkdir()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", FAN_OUT_LOGGED, str(tmp_path)], check=True, timeout=300,
                   cwd=repo, env={**os.environ, "PYTHONPATH": repo})
    lines = [line for path in (tmp_path / "events").rglob("*") if path.is_file() and path.name[0] != "."
             for line in path.read_text().splitlines()]
    ends = [event for event in map(json.loads, lines) if event["Event"] == "SparkListenerTaskEnd"]
    assert ends and max(event["Task Metrics"]["Peak Execution Memory"] for event in ends) == 0


def test_state_and_its_changes(spark):
    from tidewell.streaming.inspect import state_changes, state_operators, state_rows
    from tidewell.streaming.repeated import start_key_counts
    root = scratch_dir(spark, "state-test")
    for keys in (["a", "a", "b"], ["b", "c"], ["a"]):
        spark.createDataFrame([(k,) for k in keys], "k string").write.mode("append").parquet(f"{root}/feed")
        start_key_counts(spark.readStream.schema("k string").parquet(f"{root}/feed"), "k", root, interval=None).awaitTermination()
    point = f"{root}/checkpoint-count"
    assert [r.operatorName for r in state_operators(spark, point).collect()] == ["stateStoreSave"]
    pick = lambda frame: sorted(tuple(r) for r in frame.collect())
    assert pick(state_rows(spark, point).select("key.key", "value.count")) == [("a", 3), ("b", 2), ("c", 1)]
    assert pick(state_rows(spark, point, batch_id=0).select("key.key", "value.count")) == [("a", 2), ("b", 1)]
    changes = state_changes(spark, point).select("batch_id", "key.key", "value.count")
    assert pick(changes) == [(0, "a", 2), (0, "b", 1), (1, "b", 2), (1, "c", 1), (2, "a", 3)]
    assert pick(state_changes(spark, point, first=2).select("key.key")) == [("a",)]
