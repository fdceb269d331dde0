"""Fingerprints and groups against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidewell.llm import simhash as S
from tidewell.llm.components import components

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(fps):
    """Least index reachable over links of at most three bits."""
    root = list(range(len(fps)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    values = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_query_is_the_brute_force_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [fingerprint(r.text) for r in docs]
    want = {(docs[i].doc_id, f"{fps[i]:016x}", docs[g].doc_id) for i, g in enumerate(grouped(fps))}
    mine = [tuple(r) for r in S.op5(spark, SF).collect()]
    assert len(mine) == len(docs) and set(mine) == want
    assert len({r[2] for r in mine}) < len(mine)


def chained(seed, count):
    """Fingerprints in which each differs in up to four bits from an earlier one,
    often within one block."""
    r = random.Random(seed)
    fps = [r.getrandbits(64) for _ in range(5)]
    while len(fps) < count:
        base, block = r.choice(fps), r.randrange(3)
        bits = [21 * block + r.randrange(21) if r.random() < 0.5 else r.randrange(64) for _ in range(r.randint(1, 4))]
        fps.append(base ^ sum({1 << b for b in bits}))
    return fps


@pytest.mark.parametrize("seed", [1, 2])
def test_every_chain_of_links_is_found(spark, seed):
    fps = list(dict.fromkeys(chained(seed, 400) + [0, 7, (1 << 64) - 1, 1 << 63]))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = S.links(nodes)
    roots = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(spark, links, "test").collect()}
    mine = [roots.get(f, f) for f in fps]
    want = grouped(fps)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_dense_ball_is_one_group(spark):
    """All values within two bits of one: linked without listing pairs."""
    fps = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(40) for j in range(i)]
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = components(spark, S.links(nodes), "test").collect()
    assert len(roots) == len(fps) - 1 and len({r.root for r in roots}) == 1


@pytest.mark.parametrize("bits", [1, 3])
@pytest.mark.parametrize("count", [5, 40, 900])
def test_lookups_find_what_comparing_finds(count, bits):
    """Below and above the number of values that are compared pair by pair."""
    r = np.random.default_rng(count)
    values = np.unique(r.integers(0, 1 << 12, count).astype(np.uint64))
    found = {(int(a), int(b)) for i, j in S._near_values(values, bits, 21) for a, b in zip(values[i], values[j])}
    want = {(int(a), int(b)) for a in values for b in values if a < b and bin(int(a ^ b)).count("1") == bits}
    assert {tuple(sorted(x)) for x in found} == want


@pytest.mark.parametrize("block", range(len(S.BLOCKS)))
def test_bits_of_a_block_and_beside_it(block):
    fps = np.array([0, 5, (1 << 64) - 1, 0x123456789ABCDEF0], dtype=np.uint64)
    at, width = S.BLOCKS[block]
    for fp, inside, beside in zip(fps.tolist(), S._inside(fps, block).tolist(), S._beside(fps, block).tolist()):
        assert inside == fp >> at & (1 << width) - 1 and beside >> 48 == block
        assert beside & (1 << 48) - 1 == (fp & (1 << at) - 1) | (fp >> (at + width) << at)


DOCS = "doc_id long, text string, fp string, rank string, doc string"


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, None), (2, ""), (9, " \n"), (3, "one"), (4, "ONE"), (4, "ONE"), (None, "one"), (None, "alone here"),
            (7, long), (8, long + " tail")]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)
    found = {(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in S.near_duplicates(frame).collect()}
    assert {(a, c) for a, _, c in found} == {(5, 2), (2, 2), (9, 2), (3, 3), (4, 3), (None, 3), (None, None), (7, 7), (8, 7)}
    assert {b for _, b, _ in found} == {fingerprint(t) for _, t in rows}
    kept = S.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text[:5], r.rank) for r in kept.collect()), key=str) == sorted(
        [(2, "", "y"), (3, "one", "y"), (7, "w0 w1", "y"), (None, "alone", "y")], key=str)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert S.near_duplicates(none).count() == 0 and S.first_of_each(none).count() == 0


def test_no_wide_step_before_the_variants(spark):
    from helpers import plan
    text = plan(S.fingerprints(spark.read.parquet(f"{SF}/documents.parquet"), keep=["doc_id"]))
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text
