"""Chunked snapshots, silent keys, bounded redelivery and counted runs, against plain Python."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import brute_state, plan
from tidewell.operators import chunks as C
from tidewell.operators.envelope import with_reject_reason
from tidewell.operators.merge import current_state
from tidewell.session import scratch_dir
from tidewell.streaming import observed as O
from tidewell.streaming import silence as S

SCHEMA = "table string, key long, v string, seq long, _sub int, _kind string"


def history(seed, keys=60, length=400):
    """Changes of two tables, one per position."""
    r, alive, out = random.Random(seed), set(), []
    for seq in range(1, length):
        k = (r.choice("ab"), r.randrange(keys))
        if k in alive and r.random() < 0.4:
            alive.discard(k)
            out.append((*k, None, seq, 0, "-D"))
        else:
            out.append((*k, f"v{seq}", seq, 0, "+U" if k in alive else "+I"))
            alive.add(k)
    return out


def state_at(changes, mark):
    rows = [dict(zip(("table", "key", "v", "seq", "_sub", "_kind"), c)) for c in changes if c[3] <= mark]
    return brute_state(rows, ("table", "key"))


def chunk_rows(seed, keys=60):
    """Chunks in any order: some twice, some across others, some keys in none."""
    r, out = random.Random(seed), []
    for table in "ab":
        cuts = sorted(r.sample(range(keys), 5))
        bounds = [*zip([None, *cuts], [*cuts, None])] if seed % 3 else [*zip(cuts, cuts[1:])]
        bounds += [(low, low + r.randrange(1, 25)) for low in r.sample(range(keys), 3)] + bounds[:2] + [(9, 9)]
        out += [(table, low, high) for low, high in bounds]
    r.shuffle(out)
    return [(t, i, low, high, r.randrange(1, 400)) for i, (t, low, high) in enumerate(out)]


@pytest.mark.parametrize("seed", range(6))
def test_any_chunks_give_the_last_state(spark, monkeypatch, seed):
    if seed % 2:
        monkeypatch.setattr(C, "GROUP", 2)
        monkeypatch.setattr(C, "SMALL", 0)
    changes, chunks = history(seed), chunk_rows(seed)
    snapshot = [(t, k, row["v"], mark, 9, "+I", i) for t, i, low, high, mark in chunks
                for (of, k), row in state_at(changes, mark).items()
                if of == t and (low is None or k >= low) and (high is None or k < high)]
    feed = C.chunked_snapshot(
        spark.createDataFrame(snapshot, SCHEMA + ", chunk int"), spark.createDataFrame(changes, SCHEMA),
        spark.createDataFrame(chunks, "table string, chunk int, low long, high long, mark long"), "table", "key")
    got = {(r.table, r.key): r.v for r in current_state(feed, ["table", "key"]).collect()}
    assert got == {k: row["v"] for k, row in state_at(changes, 10**9).items()}
    text = plan(feed)
    assert "NestedLoop" not in text and "Cartesian" not in text
    # Changes that the snapshot already holds were left out.
    assert feed.count() < len(snapshot) + len(changes)


def test_no_chunks_keep_all_changes(spark):
    empty = spark.createDataFrame([], "table string, chunk int, low long, high long, mark long")
    changes = spark.createDataFrame(history(1), SCHEMA)
    feed = C.chunked_snapshot(changes.limit(0).withColumn("chunk", F.lit(1)), changes, empty, "table", "key")
    assert feed.count() == changes.count()


def test_chunks_left_and_passed(spark):
    rows = [("a", 0, None, 5, 7), ("a", 1, 5, None, None), ("b", 2, None, None, 9)]
    chunks = spark.createDataFrame(rows, "table string, chunk int, low long, high long, mark long")
    assert {r.table: (r.n, r.finished, r.passed) for r in C.chunk_offsets(chunks, 9).collect()} == {
        "a": (2, 1, False), "b": (1, 1, True)}
    assert [r.chunk for r in C.unfinished(chunks).collect()] == [1]


@pytest.mark.parametrize("count", [1, 2, 7, 100])
def test_even_chunks_cover_every_key_once(spark, count):
    cuts = C.even_chunks(spark.range(50), "id", count)
    assert cuts[0][1] is None and cuts[-1][2] is None and len(cuts) <= count
    assert all(sum((a is None or k >= a) and (b is None or k < b) for _, a, b in cuts) == 1 for k in range(-5, 60))


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 64, 100])
def test_binary_search(spark, size):
    bounds = sorted(random.Random(size).choices(range(50), k=size))
    array = F.array(*[F.lit(x) for x in bounds]).cast("array<int>")
    got = spark.range(-2, 55).select("id", C.at_or_below(array, F.lit(size), F.col("id").cast("int")).alias("n")).collect()
    assert all(r.n == sum(x <= r.id for x in bounds) for r in got)


@pytest.mark.parametrize("group,small,kind", [(2, 0, "long"), (2, 10**6, "string"), (C.GROUP, 0, "long")])
def test_ranges_are_found_without_numbering_them(spark, monkeypatch, group, small, kind):
    """Each record finds the last range at or below its key, in whichever leaf that is."""
    monkeypatch.setattr(C, "GROUP", group)
    monkeypatch.setattr(C, "SMALL", small)
    r = random.Random(group)
    key = {"long": int, "string": "{:05}".format}[kind]
    starts = [(t, key(n)) for t in ("a", "b", "d") for n in r.sample(range(3000), 700)] + [("b", None), (None, key(5))]
    ranges = [(t, s, i, i % 5 or None) for i, (t, s) in enumerate(starts)]  # some that no chunk governs
    ranges += [("a", s, 9999, mark) for _, s, _, mark in ranges[:3]]  # a start that comes twice: the greater chunk
    keys = [(r.choice(["a", "b", "c", "d", None]), r.choice([None, key(r.randrange(3003))])) for _ in range(3000)]
    records = [(i, *at) for i, at in enumerate(keys + starts + keys[:50])]

    def place(s):
        return s is not None, key(0) if s is None else s

    own = {t: sorted(((place(s), chunk, mark) for u, s, chunk, mark in ranges if u == t), key=lambda x: x[:2]) for t in "abd"}

    def want(t, s):
        return next(((chunk, mark) for at, chunk, mark in reversed(own.get(t, [])) if at <= place(s)), (None, None))

    found = C.located(spark.createDataFrame(records, f"i int, t string, k {kind}"),
                      spark.createDataFrame(ranges, f"table string, start {kind}, chunk int, mark int"), F.col("t"), F.col("k"))
    assert found.columns == ["i", "t", "k", "_chunk", "_mark"]
    assert Counter(tuple(x) for x in found.collect()) == Counter((i, t, s, *want(t, s)) for i, t, s in records)
    # No task puts all ranges in order, and no record reads a whole list.
    assert not re.search(r"\bWindow\b|SinglePartition|transform\(|NestedLoop|Cartesian", plan(found))


def silences(rows, gap, latest):
    """Brute force: times in seconds that nothing follows within the gap."""
    return {(k, t) for k, t in rows if k is not None and not any(k2 == k and t < t2 <= t + gap for k2, t2 in rows) and t + gap < latest}


def test_silent_keys_over_restarts_and_late_records(spark):
    r = random.Random(3)
    rows = [(r.choice("aaaaabcd"), r.randrange(0, 20_000)) for _ in range(200)] + [("z", 20_000), (None, 5)]
    rows.sort(key=lambda x: x[1] + r.randrange(600))  # out of order by less than the delay
    root = scratch_dir(spark, "silence")
    for i in range(0, len(rows), 45):
        part = spark.createDataFrame([(k, t) for k, t in rows[i:i + 45]], "k string, t long").select("k", F.timestamp_seconds("t").alias("t"))
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("k string, t timestamp").parquet(f"{root}/in")
        found = S.silent_keys(stream, "k", "t", 5, "15 minutes")
        query = (found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    got = [(x.key, x.t) for x in spark.read.parquet(f"{root}/out").select("key", F.unix_seconds("since").alias("t")).collect()]
    want = silences(set(rows), 300, 20_000 - 900)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    # The batch twin has them up to the last record, the delay included.
    frame = spark.createDataFrame(rows, "k string, t long").select("k", F.timestamp_seconds("t").alias("t"))
    batch = S.silent_keys_batch(frame, "k", "t", 5).select("key", F.unix_seconds("since").alias("t")).collect()
    assert {(x.key, x.t) for x in batch} == silences(set(rows), 300, 20_000)


def test_runs_join_in_any_order():
    r = random.Random(1)
    times = [r.randrange(500) for _ in range(60)]
    whole = S.joined([(t, t) for t in times], 7)
    state = {}
    for t in times:
        state = S.joined([*state.items(), (t, t)], 7)
    assert state == whole and all(b - a > 7 for a, b in zip(sorted(whole.values()), sorted(whole)[1:]))


class FakeState:
    """The map and the timers of one group, in memory."""

    def __init__(self):
        self.map, self.timers = {}, set()
        self.updateValue, self.removeKey = self.map.__setitem__, self.map.pop
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getMapState(self, *_):
        return self

    def iterator(self):
        return iter(list(self.map.items()))


@pytest.mark.parametrize("seed", range(5))
def test_a_group_of_keys_has_one_timer(seed):
    """However many keys and runs it holds; and the silences are those of each key."""
    r = random.Random(seed)
    rows = sorted(((r.choice("aaabcdefgh"), r.randrange(20_000)) for _ in range(400)), key=lambda x: x[1] + r.randrange(600))
    group, silence, got, late = FakeState(), S.Silence(300 * 10**6), [], 0
    silence.init(group)
    for i in range(0, len(rows), 40):
        frame = pd.DataFrame(rows[i:i + 40], columns=["key", "first"])
        frame["first"] *= 10**6
        frame["last"] = frame["first"]
        assert list(silence.handleInputRows((0,), iter([frame[:25], frame[25:]]), None)) == []
        assert len(group.timers) == 1
        late = max(late, *(t for _, t in rows[i:i + 40]))
        mark = (late - 600) * 1000
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        for due in [t for t in group.timers if t <= mark]:
            info = SimpleNamespace(getExpiryTimeInMs=lambda: due)
            for out in silence.handleExpiredTimer((0,), times, info):
                got += [(k, t // 10**6) for k, t in zip(out["key"], out["last"])]
            group.deleteTimer(due)
        assert len(group.timers) <= 1 and all(t > mark for t in group.timers)
    want = silences(set(rows), 300, late - 600)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40


def test_silent_keys_of_a_group_at_the_watermark(spark):
    """The instant at which the watermark reaches a gap's end counts; one millisecond before does not."""
    root, at, gap = scratch_dir(spark, "edge"), 10**12, 60_000
    times = [("a", at), ("b", at), ("b", at + gap), ("c", at + 1), ("d", at + 2), ("z", at + gap + 2)]
    frame = spark.createDataFrame(times, "k string, t long").select("k", F.timestamp_millis("t").alias("t"))
    frame.coalesce(1).write.parquet(f"{root}/in")
    found = S.silent_keys(spark.readStream.schema("k string, t timestamp").parquet(f"{root}/in"), "k", "t", 1, groups=1)
    found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(
        availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{root}/out").select("key", F.unix_millis("active_from").alias("f"), F.unix_millis("since").alias("t"))
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [("a", at, at), ("c", at + 1, at + 1)]
    batch = S.silent_keys_batch(frame, "k", "t", 1)
    assert sorted(r.key for r in batch.collect()) == ["a", "c"]


def test_redelivery_is_dropped_and_its_keys_forgotten(spark):
    root = scratch_dir(spark, "redelivery")
    for start in (10_000, 20_000, 30_000, 40_000):
        batch = [(i, start + i) for i in range(start // 100, start // 100 + 50)] * 2
        spark.createDataFrame(batch, "id long, s long").select("id", F.timestamp_seconds("s").alias("t")).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("id long, t timestamp").parquet(f"{root}/in")
        query = (S.without_redelivery(stream, ["id"], "t", "10 minutes").writeStream.format("parquet").option("path", f"{root}/out")
                 .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start())
        query.awaitTermination()
        held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        assert held <= 50  # the keys of this run; those of earlier ones are gone
    got = Counter(r.id for r in spark.read.parquet(f"{root}/out").collect())
    assert set(got.values()) == {1} and len(got) == 200


def envelopes(spark, n=60):
    return spark.range(n).select(
        F.expr("CASE id % 5 WHEN 0 THEN 'src' WHEN 1 THEN 'a.b' ELSE 's.d.t' END").alias("topic"),
        F.expr("CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE 'c' END").alias("op"),
        F.expr("CASE id % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'two' END").alias("_tag"), "id")


def plain_counts(n=60):
    out = Counter(records=n)
    for i in range(n):
        out["topic has one part" if i % 5 == 0 else "topic has not three parts" if i % 5 == 1 else
            "no op" if i % 7 == 0 else "unknown op" if i % 7 == 1 else "accepted" if i % 3 == 0 else "unrouted"] += 1
    return dict(out)


def test_counts_of_a_batch_come_from_its_write(spark):
    seen = Observation()
    frame = O.observed(with_reject_reason(envelopes(spark)), seen, ["one"])
    assert plan(frame).count("Range (") == 1
    frame.write.format("noop").mode("overwrite").save()
    assert {k: v for k, v in seen.get.items() if v} == plain_counts()


def test_counts_of_a_stream_over_batches_and_what_it_wrote(spark):
    root = scratch_dir(spark, "counts")
    listener = O.Counts()
    spark.streams.addListener(listener)
    try:
        for part in range(3):
            envelopes(spark).filter(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(envelopes(spark).schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        query = O.start_routed(with_reject_reason(stream), f"{root}/out", f"{root}/c", ["one"], interval=None)
        query.awaitTermination()
        counts = listener.of(query, "routed")
        assert listener.batches[str(query.runId)] >= 3
    finally:
        spark.streams.removeListener(listener)
    assert {k: v for k, v in counts.items() if v} == plain_counts()
    wrote = Counter(r._target for r in spark.read.parquet(f"{root}/out").select("_target").collect())
    want = plain_counts()
    assert dict(wrote) == {("one" if k == "accepted" else f"_{k}"): n for k, n in want.items() if k != "records"}
    assert sum(n for k, n in want.items() if k != "records") == want["records"]
