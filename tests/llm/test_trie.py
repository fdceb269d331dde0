"""The prefix trie against plain Python, its queue against a sorted list."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from helpers import plan
from tidewell.llm import trie as R

SF = "/root/testdata/sf0.001"


def ordered(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            talks[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in talks.items()}


def families(talks):
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = talks.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:]
    return out


def brute(talks):
    """The nodes of conversations given as lists of turns."""
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        n = len(members[path])
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = sum(saved[x] for x in children[path]) + (len(path[-1][1].encode()) * (n - 1) if path else 0)
        ended = ",".join(str(c) for c in sorted(c for c in members[path] if len(talks[c]) == len(path)))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, n, len(children[path]),
                    leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*FIELDS).collect()), key=str)


def test_query_is_the_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(R.op12(spark, SF)) == brute(families(ordered(rows)))


def made(seed, copies=40, long=0):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        rows += [(c, t, r.choice(["user", "bot"]), r.choice(["x", "yé", ""])) for t in range(r.randrange(9))]
    for c in range(100, 100 + copies):  # copies, and one hot first turn before many second ones
        rows += [(c, t, "user", f"copy {t}") for t in range(5)]
        rows += [(c + 1000, 0, "user", "hot"), (c + 1000, 1, "bot", str(c))]
    return rows + [(5000, t, "user", str(t)) for t in range(long)] + [(5001, t, "user", str(t)) for t in range(long // 2)]


@pytest.mark.parametrize("seed,pieces,queued,chunk", [(1, 1024, 1000, 4096), (2, 1024, 2, 4), (3, 7, 0, 3), (4, 1, 5, 2)])
def test_any_cut_and_any_spill(spark, monkeypatch, seed, pieces, queued, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    monkeypatch.setattr(R, "SMALL", 0 if seed % 2 else R.SMALL)
    talks = ordered(made(seed, long=200))
    data = [(c, d + 1, hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), len(t.encode()))
            for c, turns in talks.items() for d, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(data, "conv_id long, depth long, turn_hash string, bytes long")
    lengths = spark.createDataFrame([*[(c, len(t)) for c, t in talks.items()], (9000, 0)], "conv_id long, len long")
    got = rows_of(R.prefix_trie(spark, turns, lengths, pieces=pieces, lightest=4, queued=queued))
    assert got == brute({**talks, 9000: []})


@pytest.mark.parametrize("chunk", [2, 4096])
def test_odd_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = [(0, None, None, None), (0, 1, "a", "b"), (0, 1, "a", "b"), (0, 1, "ab", ""), (0, -9, "a", "b"), (0, -2, "q", "é" * 70_000),
            (None, 0, "a", "b"), (3, None, "", ""), (3, None, "", ""), (-3, 5, "a", "b"), (-5, 0, "x", ""), (4, 10**12, "a", "b")]
    rows += [(0, 100 + i, "t", str(i)) for i in range(12)] + [(2, i, "t", str(i)) for i in range(12)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, len int")
    got = rows_of(R.prefix_trie(spark, *R.rebuilt(spark, frame)))
    assert got == brute(families(ordered(rows)))
    assert rows_of(R.prefix_trie(spark, *R.rebuilt(spark, frame.limit(0)))) == []


@pytest.mark.parametrize("most", [0, 1, 7, 1000])
def test_queue(most):
    r = random.Random(most)
    queue, waiting = R.SpillingQueue(most), defaultdict(list)
    for level in range(30):
        for key in sorted(waiting):
            if key[0] <= -30 + level:
                assert sorted(queue.pop(key)) == sorted(waiting.pop(key))
        for _ in range(r.randrange(40)):
            item = (-30 + level + r.randrange(1, 4), r.randrange(3), -r.randrange(3), r.randrange(9), 2**62)
            waiting[item[:3]].append(item)
            queue.push(item)
    assert most > 100 or queue.spilled
    for key in sorted(waiting):
        assert sorted(queue.pop(key)) == sorted(waiting[key])
    assert not list(queue.pop((99, 0, 0)))


def test_no_text_moves_and_hot_nodes_are_combined(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    lines = plan(R.numbered(turns)).split("\n")
    moved = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line and "AS turn_hash" in below]
    assert len(moved) == 1 and "octet_length(" in moved[0]
    nodes = R.prefixes(spark.range(9).selectExpr("id % 2 conv_id", "id div 2 + 1 depth", "'a' turn_hash", "1L bytes"),
                       spark.range(2).selectExpr("id conv_id", "4L len")).groupBy(*R.NODE).count()
    assert "partial_count" in plan(nodes)
