"""Decontamination against a search for every window in every document."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tidewell.llm import decontaminate as D
from tidewell.llm.texts import Slice

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    places = {}
    for name, text in items:
        w = words(text)
        if w:
            n = min(window, len(w))
            for i in range(len(w) - n + 1):
                places.setdefault(n, {}).setdefault(tuple(w[i:i + n]), set()).add(name)
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n, known in places.items():
            for i in range(len(w) - n + 1):
                names = known.get(tuple(w[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        ids = sorted(str(x) for x in found if x is not None)
        out.append((key, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_query_is_the_brute_force_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    mine = [tuple(r) for r in D.op2(spark, SF).collect()]
    assert sorted(mine) == sorted(brute(docs, items))
    assert any(r[5] for r in mine) and not all(r[5] for r in mine)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab .é", max_size=60), min_size=1, max_size=4),
       st.lists(st.text("ab .é", max_size=40), max_size=4))
def test_repetitive_texts(docs, items):
    """Two letters give as many equal grams as possible."""
    data = [d.encode() for d in docs]
    part = Slice(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    index = D.Index([(str(i), t) for i, t in enumerate(items)], 4, 2)
    counts, spans = D._find(part, index)
    want = brute(list(enumerate(docs)), [(str(i), t) for i, t in enumerate(items)], 4)
    for i, row in enumerate(want):
        hit = {w for _, a, z in spans[i] for w in range(a, z)}
        assert (counts[i], len(hit), len({n for n, _, _ in spans[i]})) == row[1:4]


DOCS = "doc_id long, text string, n_words string, spans string"
LONG = " ".join(f"w{i}" for i in range(40_000))


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_odd_rows_blocks_and_clashing_names(spark, block_bytes):
    items = [(1, "short item"), (None, "no id here"), (2, None), (3, " .. "), (4, LONG[:500]), (1, "short item"),
             (5, " ".join(f"w{i}" for i in range(39_980, 40_000)))]
    docs = [(1, None), (2, ""), (None, "a short item stands"), (3, "NO ID HERE"), (3, "NO ID HERE"),
            (4, LONG), (5, "clean words only"), (6, "!! ..")]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = D.contamination(frame, bench, keep=["doc_id"], block_bytes=block_bytes)
    from pyspark.sql import functions as F
    mine = [(r.doc.doc_id, r.n_words, r.n, r.ids) for r in found.select(
        "doc", "n_words", D.n_hit(F.col("spans")).alias("n"), D.item_ids(F.col("spans")).alias("ids")).collect()]
    want = [(k, n, h, i) for (k, n, h, i, _, _) in brute(docs, [(str(a) if a else None, t) for a, t in items])]
    # Joined rows come in no order.
    assert sorted(((a, b, c, len(d)) for a, b, c, d in mine), key=str) == sorted(want, key=str)
    kept = D.clean_only(frame, bench, block_bytes=block_bytes)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.n_words) for r in kept.collect()) == [(1, "x"), (2, "x"), (4, "x"), (5, "x"), (6, "x")]


def found_spans(docs, items, **options):
    rows = D.contamination(docs, items, **options).collect()
    return sorted(((r.doc.doc_id, r.n_words, sorted({(s.item_id, s.start, s.end) for s in r.spans}, key=str)) for r in rows), key=str)


def test_joined_is_the_one_index(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert found_spans(docs, items, block_bytes=0) == found_spans(docs, items)


def test_joined_on_repetitive_texts(spark):
    r = random.Random(5)
    texts = [" ".join(r.choices(["a", "b", "\u00e9"], k=r.randrange(80))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:100])] + [(3, texts[3]), (None, texts[4])], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts[100:])) + [(7, "a b"), (None, "b b b a")], "item_id long, text string")
    for window, gram in [(13, 5), (4, 2)]:
        one = found_spans(docs, items, window=window, gram=gram)
        assert one == found_spans(docs, items, window=window, gram=gram, block_bytes=0) and any(s for _, _, s in one)


def test_a_large_benchmark_never_reaches_the_driver(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.createDataFrame([(i, " ".join(f"x{i}y{j}" for j in range(40))) for i in range(3000)], "item_id long, text string")
    frame = D.contamination(docs, items, block_bytes=1000)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 1 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert frame.filter("size(spans) > 0").count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a b c", "", "")], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(none, items).count() == 0
    assert [r.n_words for r in D.contamination(some, items).collect()] == [3]
    assert D.clean_only(none, some.selectExpr("doc_id item_id", "text")).count() == 0
