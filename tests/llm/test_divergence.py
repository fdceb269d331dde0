"""Distances between sources against plain Python."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa
import pytest

from tidewell.llm import divergence as D

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(docs, least=D.LEAST_DOCS, top=D.TOP):
    """The contract's rows for (lang, source, text)."""
    counts, holders, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        counts[lang, source].update(words)
        counts[lang, None].update(words)
        holders.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        terms = [w for (of, w), n in holders.items() if of == lang and n >= least]
        sources = sorted(s for of, s in groups if of == lang)

        def p(source, size):
            return {w: 1 + int(Fraction(10**9 * (counts[lang, source][w] + 5), size + 5 * len(terms))) for w in terms}

        own = {s: p(s, sum(counts[lang, s][w] for w in terms)) for s in [*sources, None]}
        for s in sources:
            apart = [(-sum(abs(own[s][w] - own[x][w]) for w in terms), x.encode(), x) for x in sources if x != s]
            out += [(lang, s, "pair", x, -v, i + 1) for i, (v, _, x) in enumerate(sorted(apart))]
            more = [(own[None][w] - own[s][w], w.encode(), w) for w in terms if counts[lang, s][w] and own[s][w] > own[None][w]]
            out += [(lang, s, "term", w, -v, i + 1) for i, (v, _, w) in enumerate(sorted(more)[:top])]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query_is_the_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()]
    got = rows_of(D.op13(spark, SF))
    assert got == brute(docs) and {r[2] for r in got} == {"pair", "term"}


def made(seed, n=300):
    r = random.Random(seed)
    words = ["the", "The", "É", "é", "ß", "a1b", "x_y", "end.", "日本", "rare", "TOP", "common"]
    out = [(r.choice(["en", "en", "de", None]), r.choice(["a", "a", "a", "b", "c", "", None, "é"]),
            " ".join(r.choices(words, weights=range(1, 13), k=r.randrange(9)))) for _ in range(n)]
    return out + out[:20] + [("xx", "only", "one"), ("xx", "two", None), ("yy", "z", ""), ("en", "empty", None), ("en", "a", "the " * 50_000)]


@pytest.mark.parametrize("seed,groups", [(1, 10**5), (2, 0)])
def test_odd_rows(spark, monkeypatch, seed, groups):
    monkeypatch.setattr(D, "MOST_GROUPS", groups)  # 0: all lists of sources are joined by shuffles
    docs = made(seed)
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "lang string, source string, text string, n int, term int")
    for least, top in ((2, 3), (40, 50)):
        assert rows_of(D.divergence(spark, frame, least, top)) == brute(docs, least, top)
    assert rows_of(D.divergence(spark, frame.limit(0))) == []


def test_counts_are_added_up_in_parts(monkeypatch):
    docs = [(x or "", y or "", z) for x, y, z in made(5, 100)]
    batches = [pa.RecordBatch.from_pydict(dict(zip("abc", map(list, zip(*docs[i:i + 9]))))) for i in range(0, len(docs), 9)]
    sums = []
    for held in (2, 10**6):
        monkeypatch.setattr(D, "HELD", held)
        total = Counter()
        for b in D._term_counts(iter(batches)):
            for lang, source, term, n, in_docs in zip(*b.to_pydict().values()):
                total[lang, source, term, "n"] += n
                total[lang, source, term, "docs"] += in_docs
        sums.append(total)
    assert sums[0] == sums[1] and sums[0]["en", "a", "the", "n"] >= 50_000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(1, 5), st.integers(1, 3), max_size=5), min_size=1, max_size=12),
       st.lists(st.integers(1, 4), min_size=12, max_size=12))
def test_tree_is_the_sum_over_rows(rows, times):
    z = [7, 100, 3, 60, 7, 1]
    paths = [[{"s": s, "n": n, "p": 50 * n + s, "z": z[s]} for s, n in sorted(row.items())] for row in rows]
    paths.sort(key=lambda path: [(x["s"], x["n"]) for x in path])
    want = Counter()
    for path, m in zip(paths, times):
        for j, y in enumerate(path):
            for x in path[:j]:
                want[x["s"], y["s"]] += m * (abs(x["p"] - y["p"]) - abs(x["p"] - y["z"]) - abs(x["z"] - y["p"]) + abs(x["z"] - y["z"]))
    kind = pa.list_(pa.struct([("s", pa.int32()), ("n", pa.int64()), ("p", pa.int64()), ("z", pa.int64())]))
    a, b, value = D.corrections(pa.array(paths, kind), np.array(times[:len(paths)]))
    assert {(x, y): v for x, y, v in zip(a.tolist(), b.tolist(), value.tolist()) if v} == {k: v for k, v in want.items() if v}


def test_frequencies_are_exact(spark):
    from pyspark.sql import functions as F
    n, total, terms = 9 * 10**17 + 1, 9 * 10**18, 10**6
    row = spark.range(1).select(D.frequency(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)
