"""The lookup table and the placement."""

from collections import Counter

import pytest

from helpers import plan
from tidewell.llm import sharding as S

DOCS = "doc_id long, text string, slot string, shard string"


@pytest.mark.parametrize("count", [1, 2, 3, 7, 16])
def test_table_is_even_and_complete(count):
    shards = [f"s{i}" for i in range(count)]
    slots = S.lookup_table(shards)
    owned = Counter(slots)
    assert set(slots) == set(range(count)) and max(owned.values()) - min(owned.values()) <= 1
    assert len(slots) >= 100 * count and all(len(slots) % d for d in range(2, len(slots)))


def test_removing_a_shard_moves_few_other_slots():
    shards = [f"s{i}" for i in range(16)]
    before = [shards[i] for i in S.lookup_table(shards, 1601)]
    less = shards[:-1]
    after = [less[i] for i in S.lookup_table(less, 1601)]
    moved = sum(a != b for a, b in zip(before, after) if a != "s15")
    assert moved < 0.1 * len(before)


def test_placement(spark):
    rows = [(i, "t") for i in range(5000)] + [(1, "other")] * 3 + [(None, f"n{i}") for i in range(3000)] + [(None, None)] * 2
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], DOCS)
    placed = S.sharded(frame)
    got = placed.collect()
    assert len(got) == len(rows) and all(r.doc.slot == "a" for r in got)
    slots = S.lookup_table()
    for r in got:
        assert r.shard == S.SHARDS[slots[r.slot]]
        if r.doc.doc_id is not None:
            assert r.slot == S._number(f"key:{r.doc.doc_id}") % len(slots)
    sizes = Counter(r.shard for r in got)
    assert len(sizes) == 16 and max(sizes.values()) < 1.3 * min(sizes.values())
    nulls = Counter(r.shard for r in got if r.doc.doc_id is None)
    assert max(nulls.values()) < 0.1 * sum(nulls.values())
    assert S.sharded(frame.limit(0)).count() == 0


def test_no_row_moves_and_no_python_runs(spark):
    text = plan(S.op6(spark, "/root/testdata/sf0.001"))
    assert text.count("Exchange") == 1 and "BroadcastExchange" in text
    assert "Python" not in text and "Arrow" not in text
    assert "ReadSchema: struct<doc_id:bigint>" in text
