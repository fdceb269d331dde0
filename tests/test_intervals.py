"""Sets of transaction numbers against Python sets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import plan
from tidewell.operators import intervals as I
from tidewell.operators import offsets as O

SCHEMA = "uuid string, low long, high long"


def some_set(seed, n=60, most=400):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        low = r.randrange(-5, most)
        rows.append((r.choice("abc"), low, low + r.choice([-1, 0, 0, 1, 5, 40])))
    return rows + rows[:5]


def numbers(rows):
    return {(u, n) for u, low, high in rows for n in range(low, high + 1)}


def runs(wanted):
    out = []
    for u, n in sorted(wanted):
        if out and out[-1][0] == u and out[-1][2] == n - 1:
            out[-1][2] = n
        else:
            out.append([u, n, n])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 20), (2, 1), (3, 7), (4, 64)])
def test_algebra(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(I, "CHUNK", chunk)
    x, y = some_set(seed), some_set(seed + 100)
    a, b = spark.createDataFrame(x, SCHEMA), spark.createDataFrame(y, SCHEMA)
    for of, want in ((I.union, numbers(x) | numbers(y)), (I.intersection, numbers(x) & numbers(y)), (I.difference, numbers(x) - numbers(y))):
        assert sorted(tuple(r) for r in of(a, b).select("uuid", "low", "high").collect()) == runs(want)
    assert sorted(tuple(r) for r in I.union(a).select("uuid", "low", "high").collect()) == runs(numbers(x))
    assert I.difference(a, a).count() == 0 and I.union(a.limit(0)).count() == 0


def test_no_task_holds_a_server(spark):
    """Windows over single numbers are within a chunk; those over a server see one row for each chunk."""
    text = plan(I.union(spark.createDataFrame(some_set(1), SCHEMA)))
    windows = [line for line in text.split("\n") if re.search(r"\bWindow \[", line)]
    over = [re.search(r", \[([^\[\]]*)\], \[([^\[\]]*)\]$", w.rstrip()).groups() for w in windows]
    assert {("_chunk" in part, "_chunk" in order) for part, order in over} == {(True, False), (False, True)}
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_seen_sets_by_group_as_text(spark, most):
    feed = spark.createDataFrame([(i % 2, None if i == 7 else f"u{i % 3}:{i}") for i in range(40)], "task int, gtid string")
    seen = I.seen_intervals(feed.union(feed), ["task"], "gtid")
    rows = {(r.task, r.uuid, r.low, r.high) for r in seen.collect()}
    assert rows == {(i % 2, f"u{i % 3}", i, i) for i in range(40) if i != 7}
    text = I.sets_as_text(seen, ["task"], most)
    if most < 7:
        with pytest.raises(Exception, match="kept as rows"):
            text.collect()
    else:
        assert {r.task for r in text.collect()} == {0, 1}
        assert O.source_gtid_set(feed, ["task"], "gtid").filter("task = 0").first().gtid_set == \
            "u0:0:6:12:18:24:30:36,u1:4:10:16:22:28:34,u2:2:8:14:20:26:32:38"


def test_lookup_in_a_large_set(spark):
    many = [("a", i * 10, i * 10 + 3) for i in range(10_000)] + [("b", 5, 5)]
    text = ",".join(f"{u}:{low}-{high}" for u, low, high in many)
    frame = spark.range(0, 100_010, 7).select("id", F.concat(F.lit("a:"), F.col("id")).alias("g"))
    want = {i for i in range(0, 100_010, 7) if i % 10 <= 3 and i < 100_000}
    kept = frame.filter(O.in_gtid_set(text, F.col("g")))
    assert {r.id for r in kept.collect()} == want
    # The expression does not grow with the intervals, only its two lists do.
    assert kept._jdf.queryExecution().analyzed().toString().count("(") < 400
    found = I.covered(frame, spark.createDataFrame(many, SCHEMA), F.col("g"))
    assert {r.id for r in found.filter("_covered").collect()} == want and found.count() == frame.count()
    odd = spark.createDataFrame([(None,), ("a",), ("a:x",), ("z:1",), ("b:5",)], "g string")
    assert [r.g for r in odd.filter(O.in_gtid_set("b:1-5,a:1", F.expr("if(g = 'a:x', NULL, g)"))).collect()] == ["b:5"]
