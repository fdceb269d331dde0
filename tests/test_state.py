import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import brute_state, plan
from tidewell.functions import gtid
from tidewell.operators import commits as rules
from tidewell.operators import offsets
from tidewell.operators.merge import current_state, merge_on_read, newest_versions
from tidewell.sources.readers import as_snapshot
from tidewell.sources.startup import AfterGtid, AtPosition, Initial, parse_start, start_from, wall_clock_millis
from pyspark.sql import functions as F

SCHEMA = "id bigint, seq bigint, _sub int, _kind string, v string"
KEY = ["id"]


def changes_of(moves):
    """A legal change history from (key, action) moves: sequence numbers rise."""
    live, rows = {}, []
    for seq, (key, remove) in enumerate(moves, 1):
        if key in live:
            old = live.pop(key)
            if remove:
                rows.append((key, seq, 0, "-D", old))
            else:
                rows += [(key, seq, 0, "-U", old), (key, seq, 1, "+U", f"v{seq}")]
                live[key] = f"v{seq}"
        else:
            rows.append((key, seq, 0, "+I", f"v{seq}"))
            live[key] = f"v{seq}"
    return rows, live


def state_of(frame):
    return {r.id: r.v for r in frame.collect()}


moves = st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=1, max_size=30)
slow = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@slow
@given(moves=moves, cut=st.integers(0, 60), seed=st.integers(0, 99))
def test_any_order_split_and_replay_gives_the_same_state(spark, moves, cut, seed):
    rows, live = changes_of(moves)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    assert {k[0]: r["v"] for k, r in brute_state([dict(zip(names, r)) for r in rows], KEY).items()} == live
    shuffled = rows + rows[: len(rows) // 2]
    random.Random(seed).shuffle(shuffled)
    whole = spark.createDataFrame(shuffled, SCHEMA)
    assert state_of(current_state(whole, KEY)) == live
    head = spark.createDataFrame(rows[:cut], SCHEMA)
    late = spark.createDataFrame(rows[cut:] + rows[: cut // 2], SCHEMA)
    assert state_of(merge_on_read(newest_versions(head, KEY), late, KEY)) == live


def test_reinsert_after_delete_and_late_record(spark):
    base = newest_versions(spark.createDataFrame(
        [(1, 1, 0, "+I", "a"), (1, 5, 0, "-D", "a"), (2, 1, 0, "+I", "b")], SCHEMA), KEY)
    late = spark.createDataFrame([(1, 3, 1, "+U", "old"), (2, 6, 0, "-D", "b"), (2, 7, 0, "+I", "new")], SCHEMA)
    assert state_of(merge_on_read(base, late, KEY)) == {2: "new"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.col("id").alias("seq"),
        F.lit(0).alias("_sub"), F.lit("+I").alias("_kind"), F.col("id").cast("string").alias("v"))
    state = current_state(frame, KEY)
    assert state.count() == 200001 and state.filter("id = 0").first().v == "299997"
    text = plan(state)
    assert text.index("[max(") < text.index("Exchange") < text.index("partial_max(")
    assert text.count("Exchange") == 1


def test_equal_versions_give_one_result_and_maps_are_allowed(spark):
    rows = [(1, 1, 0, "+I", v) for v in "bca"]
    for parts in (1, 3):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        assert state_of(current_state(frame, KEY)) == {1: "c"}
    mapped = spark.createDataFrame(rows, SCHEMA).withColumn("m", F.create_map("v", "v"))
    assert current_state(mapped.filter("v = 'a'"), KEY).first().m == {"a": "a"}


def test_sequences(spark):
    frame = spark.createDataFrame(
        [(("mysql-bin.000009", 500, "u:7", None),), (("mysql-bin.000010", 4, "u:8", 12),)],
        "source struct<file:string,pos:bigint,gtid:string,lsn:bigint>")
    got = lambda by: [r[0] for r in frame.select(offsets.source_sequence(by)).collect()]
    assert got("gtid") == [7, 8] and got("lsn") == [None, 12]
    low, high = got("position")
    assert low < high and high == (10 << 40) + 4
    with pytest.raises(ValueError):
        offsets.source_sequence("arrival")


def test_seed_order_table(spark):
    """The trial statements over the seed rows, as a change feed."""
    rows = [
        ("ab1000", 1, 0, "+I", 56.4), ("ab1001", 2, 0, "+I", 16.2), ("ab1001", 3, 0, "-U", 16.2),
        ("ab1001", 3, 1, "+U", 30.0), ("ab1002", 4, 0, "+I", 16.2), ("ab1002", 5, 0, "-D", 16.2),
        ("ab1000", 6, 0, "-U", 56.4), ("ab1000", 6, 1, "+U", 56.6), ("ab1011", 7, 0, "+I", 16.2),
        ("ab1011", 7, 0, "+I", 16.2)]
    frame = spark.createDataFrame(rows, "order_id string, seq bigint, _sub int, _kind string, pay_amount double")
    got = {r.order_id: r.pay_amount for r in current_state(frame, ["order_id"]).collect()}
    assert got == {"ab1000": 56.6, "ab1001": 30.0, "ab1011": 16.2}


def test_parse_start():
    assert parse_start(None) == Initial() and parse_start("") == Initial()
    assert parse_start("pos/mysql-bin.000001:5997") == AtPosition("mysql-bin.000001", 5997)
    assert parse_start("gtid/ u:1-5,w:7 ") == AfterGtid("u:1-5,w:7")
    for bad in ("latest", "pos/x", "gtid/", "time/1", "pos", "gtid/u"):
        with pytest.raises(ValueError):
            parse_start(bad)
    assert gtid.parse_set("u:1-20:30,w:4") == [("u", 1, 20), ("u", 30, 30), ("w", 4, 4)]
    assert wall_clock_millis("2023-08-19_22:00:00") == 1692453600000


def feed(spark, rows):
    return spark.createDataFrame(rows, "op string, source struct<file:string,pos:bigint,gtid:string>")


def test_start_positions_and_sets(spark):
    frame = feed(spark, [("r", ("b.1", 1, "u:1")), ("c", ("b.1", 5, "u:2")), ("u", ("b.2", 1, "u:9")),
                         ("u", ("b.2", 9, "w:1"))])
    got = lambda f: sorted(r.source.pos for r in f.collect())
    assert got(start_from(frame, Initial())) == [1, 1, 5, 9]
    assert got(start_from(frame, parse_start("pos/b.1:5"))) == [1, 5, 9]
    assert got(start_from(frame, parse_start("pos/b.2:2"))) == [9]
    assert got(start_from(frame, parse_start("gtid/u:1-2:4-9"))) == [9]


def test_low_water(spark):
    frame = spark.createDataFrame([(1, "a:1-20:30-50,b:1-7"), (2, "a:1-60,c:1-3"), (3, ""), (4, None)],
                                  "task int, gtid_set string")
    assert offsets.gtid_low_water(frame).first().gtid_set == "a:1-20:30-50,b:1-7,c:1-3"
    reset = offsets.reset_offsets(frame)
    assert {r.gtid_set for r in reset.collect()} == {"a:1-20:30-50,b:1-7,c:1-3"} and reset.count() == 4
    assert {r.gtid_set for r in offsets.reset_offsets(frame, "a:1-9").collect()} == {"a:1-9"}
    with pytest.raises(Exception, match="no task reported"):
        offsets.gtid_low_water(frame.filter("task > 2")).collect()


def test_offset_tables(spark):
    kinds = spark.createDataFrame([(1, "incremental"), (2, "snapshot")], "task int, kind string")
    assert [r.task for r in offsets.incremental_offsets(kinds).collect()] == [1]
    done = spark.createDataFrame([("a.x",), ("a.y",)], "table string")
    assert [r.table for r in offsets.reset_tables(done, done.filter("table = 'a.x'")).collect()] == ["a.y"]
    rows = as_snapshot(spark.createDataFrame([(1,)], "id int"), "s.a.z").withColumn("table", F.lit("a.z"))
    assert offsets.new_tables(rows, done).first().after.id == 1


def commit_frame(spark, rows):
    return spark.createDataFrame(rows, "table string, commit bigint, ts timestamp_ntz, compacted boolean")


def test_clean_and_archive_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"t{rng.randint(0, 2) if i % 3 else 0}", i, None, rng.random() < 0.7) for i in range(600)]
    frame = commit_frame(spark, rows)
    for keep in (1, 7, 150, 1000):
        expected = set()
        for name in {r[0] for r in rows}:
            ranked = sorted((r for r in rows if r[0] == name), key=lambda r: -r[1])
            expected |= {(r[0], r[1]) for r in ranked[keep:] if r[3]}
        got = {(r.table, r.commit) for r in rules.clean_candidates(frame, keep, salts=5).collect()}
        assert got == expected
    low, high = rules.archive_bounds(100)
    assert (low, high) == (110, 120) and rules.archive_bounds() == (10090, 10100)
    expected = set()
    for name in {r[0] for r in rows}:
        ranked = sorted((r[1] for r in rows if r[0] == name), reverse=True)
        expected |= {(name, c) for c in ranked[low:]} if len(ranked) > high else set()
    got = {(r.table, r.commit) for r in rules.archive_candidates(frame, 100, salts=5).collect()}
    assert got == expected and got


def test_compaction_due(spark):
    from datetime import datetime
    at = datetime(2024, 1, 1)
    frame = commit_frame(spark, [("many", i, at, False) for i in range(5)] + [("few", 9, at, False), ("done", 1, at, True)])
    due = lambda now: {r.table: r.due for r in rules.compaction_due(frame, F.expr(now)).collect()}
    assert due("timestamp_ntz'2024-01-01 00:10:00'") == {"many": True, "few": False}
    assert due("timestamp_ntz'2024-01-01 00:30:00'") == {"many": True, "few": True}


def test_newest_commit(spark):
    frame = spark.createDataFrame([("chk-1", 5), ("chk-9", 3), ("chk-2", 5)], "path string, mtime bigint")
    assert rules.newest_commit(frame).first().path == "chk-2"
