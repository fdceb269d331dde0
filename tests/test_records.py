import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.keys import bucket_of, key_hash
from tidewell.operators import kafka_rows as kafka
from tidewell.operators import routing
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.typed import expand_flat_records, flat_rejects
from tidewell.operators.envelope import (
    accepted, flat_record, keep_changes, parse_envelope, parse_flat_records, rejected,
    row_by_name, row_by_position, with_reject_reason, with_shard_columns, with_topic_parts)
from tidewell.spec import TableSpec, conform, diff, spec_from_describe

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("st", T.StringType())])
KEY = T.StructType([T.StructField("id", T.LongType())])


def envelope(op, before=None, after=None, topic="src.order_03.orders", key=1, **more):
    return json.dumps({"topic": topic, "key": {"id": key}, "before": before, "after": after, "op": op,
                       "ts_ms": 7, "source": {"lsn": 11}, **more})


def parsed(spark, lines):
    return parse_envelope(spark.createDataFrame([(x,) for x in lines], "value string"), ROW, KEY)


def test_rejects_have_reasons_and_nothing_is_lost(spark):
    frame = parsed(spark, [
        envelope("c", after={"id": 1, "st": "a"}),
        envelope("c", topic="src"), envelope("c", topic="src.db"), envelope("c", topic="a.b.c.d"),
        envelope(None, after={"id": 1, "st": "a"}), envelope(None), envelope("t"),
    ])
    judged = with_reject_reason(frame, payload=["before", "after"])
    assert accepted(judged).count() == 1
    reasons = sorted(r["_reject"] for r in rejected(judged).collect())
    assert reasons == sorted(["topic has one part", "topic has not three parts", "topic has not three parts",
                              "no op", "tombstone", "unknown op"])


def test_postgres_envelope_gives_its_sequence(spark):
    row = parsed(spark, [envelope("u", {"id": 1, "st": "a"}, {"id": 1, "st": "b"})]).first()
    assert (row.source.lsn, row.before.st, row.after.st, row.ts_ms) == (11, "a", "b", 7)


def test_update_expands_in_order(spark):
    frame = parsed(spark, [envelope("u", {"id": 1, "st": "a"}, {"id": 1, "st": "b"}),
                           envelope("d", {"id": 2, "st": "x"}), envelope("r", None, {"id": 3, "st": "y"})])
    rows = expand_changelog(keep_changes(frame).select("op", "before", "after")).collect()
    assert sorted((r.id, r._sub, r._kind, r.st) for r in rows) == [
        (1, 0, "-U", "a"), (1, 1, "+U", "b"), (2, 0, "-D", "x"), (3, 0, "+I", "y")]


def test_strict_expansion_fails_on_unknown_op(spark):
    frame = parsed(spark, [envelope("t")]).select("op", "before", "after")
    assert expand_changelog(frame).count() == 0
    with pytest.raises(Exception, match="unsupported op t"):
        expand_changelog(frame, strict=True).collect()


def test_flat_record_leaves_absent_parts_out(spark):
    frame = with_topic_parts(parsed(spark, [envelope("d", {"id": 1, "st": "a"})]))
    record = json.loads(frame.select(flat_record(F.lit(9))).first()[0])
    assert record == {"db": "order_03", "table": "orders", "key": {"id": 1}, "before": {"id": 1, "st": "a"},
                      "op": "d", "cdc_ts": "7", "prd_ts": "9"}


SAMPLE = json.dumps({
    "db": "order_03", "table": "inner", "key": {"UID": 58936099},
    "after": {"ROW_ID": "d58c", "VER_NUM": 0, "UID": 58936099, "STATUS_DATE": "2020-09-07T21:10:15"},
    "op": "r", "cdc_ts": "1695633595982", "prd_ts": "1695633598220"})


def test_sample_record(spark):
    spec = TableSpec(name="order.inner", key=("UID",), schema=T.StructType([
        T.StructField("UID", T.LongType()), T.StructField("VER_NUM", T.IntegerType()),
        T.StructField("MISSING", T.StringType()), T.StructField("ROW_ID", T.StringType())]))
    frame = spark.createDataFrame([(SAMPLE,)], "value string")
    row = expand_flat_records(frame, spec).first()
    assert (row.UID, row.VER_NUM, row.MISSING, row.ROW_ID, row._kind) == (58936099, 0, None, "d58c", "+I")
    untyped = parse_flat_records(frame).first()
    assert untyped.after["STATUS_DATE"] == "2020-09-07T21:10:15" and untyped.before is None
    rows = parse_flat_records(frame).select(row_by_name(F.col("after"), spec).alias("r")).select("r.*")
    assert rows.first().VER_NUM == 0
    key, record = kafka.digit_key(kafka.keyed_text(F.col("value")))
    got = frame.select(key.alias("k"), record.alias("r")).first()
    assert got.k == "58936099" and json.loads(got.r) == json.loads(SAMPLE)


def test_keyed_text_shapes(spark):
    frame = spark.createDataFrame([("a9b###x",), ("abc###x",), ("###x",), ("a###b###c",), ("a###",), ("z",)], "v string")
    key, record = kafka.digit_key(F.col("v"))
    assert [tuple(r) for r in frame.select(key, record).collect()] == [
        ("9", "x"), ("abc", "x"), ("", "x"), ("", ""), ("", ""), ("", "")]


def test_position_cuts_and_fills(spark):
    spec = TableSpec(name="t", key=("id",), schema=ROW)
    frame = spark.createDataFrame([(["1", "a", "extra"],), (["2"],), (None,)], "v array<string>")
    rows = frame.select(row_by_position(F.col("v"), spec).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None), (None, None)]


def test_shard_columns(spark):
    frame = spark.createDataFrame([("order_03",), ("order",)], "db string")
    rows = with_shard_columns(frame, 0, at=F.lit("2023-07-01 12:33:09").cast("timestamp")).collect()
    assert [(r._shard, r._write_time) for r in rows] == [("0_03", "2023-07-01 12:33:09"), ("0", "2023-07-01 12:33:09")]
    spec = TableSpec(name="t", key=("id",), schema=ROW).with_shard()
    assert spec.key == ("id", "_shard") and spec.columns == ["_write_time", "_shard", "id", "st"]


def test_tags(spark):
    frame = spark.createDataFrame(
        [("order_03", "orders"), ("order", "orders_202301"), ("order_1", "x_1"), ("a_1_2", "b")], "db string, t string")
    tagged = frame.select(routing.logical_tag(F.col("db"), F.col("t")).alias("_tag"))
    assert [r[0] for r in tagged.collect()] == ["order.orders", "order.orders_202301", "order.x_1", "a_1.b"]
    known = ["order.orders", "order.x_1"]
    expected = ["order.orders", "order.orders", "order.x_1", None]
    assert [r[0] for r in tagged.select(routing.resolve_tag(F.col("_tag"), known)).collect()] == expected
    names = spark.createDataFrame([(k,) for k in known], "tag string")
    got = [r._tag for r in routing.resolve_tag_from(tagged, names).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_targets_and_tables(spark):
    assert routing.bare_table_name("x_month_[0-9]{6}") == "x_month" and routing.bare_table_name("x") == "x"
    frame = spark.createDataFrame([("order", "x_month_[0-9]{6}", 3)], "db string, t string, s int")
    names = routing.target_names(F.col("db"), F.col("t"), F.col("s"), "/lake")
    assert tuple(frame.select(*[c.alias(n) for n, c in names.items()]).first()) == (
        "lake_order", "x_month_3", "/lake/lake_order/x_month_3")
    with pytest.raises(ValueError):
        routing.bucket_counts(["a.b"], [1, 2])
    good = routing.expand_tables(spark.createDataFrame([("order.o",)], "name string"), ["_00", "_01"])
    assert [r.physical for r in good.collect()] == ["order_00.o", "order_01.o"]
    with pytest.raises(Exception, match="db.table"):
        routing.expand_tables(spark.createDataFrame([("order",)], "name string"), ["_00"]).collect()


def test_unrouted_records_are_countable(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "_tag string")
    assert routing.route(frame, ["a"])["a"].count() == 1 and routing.unrouted(frame, ["a"]).count() == 2


def test_partitions_are_never_negative(spark):
    frame = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    for portable in (False, True):
        low, high = frame.select(kafka.key_partition(F.col("k"), 7, portable).alias("p")).agg(
            F.min("p"), F.max("p")).first()
        assert (low, high) == (0, 6)
    assert frame.select(bucket_of([F.col("k")], 5).alias("b")).filter("b < 0").count() == 0
    assert frame.select(key_hash([F.col("k")])).distinct().count() == 2000


def test_key_of_keyless_table(spark):
    frame = spark.createDataFrame([(1,)], "id int").select(F.struct("id").alias("key"))
    assert frame.select(kafka.record_key(F.col("key"), [])).first()[0] == ""


def test_describe_and_drift(spark):
    described = spark.createDataFrame(
        [("order_id", "varchar(32)", "PRI"), ("pay_amount", "double", ""), ("user_id", "varchar(32)", ""),
         ("user_name", "varchar(32)", "")], "Field string, Type string, Key string")
    old = spec_from_describe("test_db.cdc_order", described)
    assert old.key == ("order_id",) and old.schema["pay_amount"].dataType == T.DoubleType()
    new = TableSpec(name=old.name, key=old.key, schema=T.StructType([
        T.StructField("order_id", T.StringType()), T.StructField("pay_amount", T.DoubleType()),
        T.StructField("user_id", T.IntegerType()), T.StructField("email", T.StringType())]))
    changed = diff(old, new)
    assert (changed.added, changed.dropped, changed.retyped) == (("email",), ("user_name",), ("user_id",))
    rows = spark.createDataFrame([("a", 1.0, "7", "x"), ("b", 2.0, "jk1", "y"), ("c", 3.0, None, "z")],
                                 "order_id string, pay_amount double, user_id string, user_name string")
    got = {r.order_id: (r.user_id, r.email, r._rejects) for r in conform(rows, new).collect()}
    assert got == {"a": (7, None, []), "b": (None, None, ["user_id"]), "c": (None, None, [])}


def flat(op, after, before=None):
    return json.dumps({"db": "d", "table": "t", "op": op, "before": before, "after": after})


def test_a_bad_key_is_a_reject_and_not_a_null_row(spark):
    spec = TableSpec(name="d.t", key=("id",), schema=T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())]))
    good, bad = [flat("c", {"id": 1, "n": 2}), flat("d", None, {"id": 3, "n": None})], [
        flat("c", {"id": "x7", "n": 1}), flat("c", {"n": 1}), flat("c", {"id": 4, "n": 2 ** 40}), flat("q", {"id": 5}), "{no"]
    frame = spark.createDataFrame([(x, i) for i, x in enumerate(good + bad)], "value string, at int")
    rows = expand_flat_records(frame, spec, strict=False).collect()
    assert sorted((r.id, r.n, r._kind, r.at) for r in rows) == [(1, 2, "+I", 0), (3, None, "-D", 1)]
    lost = {r.at: (r._reject, r._raw) for r in flat_rejects(frame, spec).collect()}
    assert {k: v[0] for k, v in lost.items()} == {2: "lost value: id", 3: "null key", 4: "lost value: n", 5: "unknown op", 6: "malformed text"}
    assert [lost[i][1] for i in range(2, 7)] == bad
    assert expand_flat_records(frame.filter("at < 2"), spec).count() == 2
    for i in range(2, 7):
        with pytest.raises(Exception, match="record rejected"):
            expand_flat_records(frame.filter(F.col("at") == i), spec).collect()


def test_wide_tables_compile(spark):
    """40 columns of every kind, both images, in pieces that the JVM compiles."""
    kinds = [T.LongType(), T.DoubleType(), T.ShortType(), T.BooleanType(), T.DateType(), T.TimestampNTZType(), T.DecimalType(20, 2), T.StringType()]
    spec = TableSpec(name="d.t", key=("c0",), schema=T.StructType([T.StructField(f"c{i}", kinds[i % 8]) for i in range(40)]))
    image = {f"c{i}": ["1", "2.5", "3", "1", "19000", "1700000000000", "AQI=", "x"][i % 8] for i in range(40)}
    text = json.dumps({"topic": "s.d.t", "op": "u", "before": image, "after": image})
    frame = spark.range(50).select(F.lit(text).alias("value"), F.col("id").alias("at"))
    from tidewell.operators.typed import typed_envelopes
    typed = typed_envelopes(frame, spec)
    fallback = spark.conf.get("spark.sql.codegen.fallback", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")  # a piece that does not compile fails the job
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        rows = typed.select("at", "_reject", "after.*").collect()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", fallback)
        spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    assert len(rows) == 50 and all(r._reject is None and r.c6 is not None and r.c39 == "x" for r in rows)
