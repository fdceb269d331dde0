"""Counts, exact bounds and cutoffs."""

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tidewell.llm import rules as R
from tidewell.llm.texts import Slice

SF = "/root/testdata/sf0.001"


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeat = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            repeat.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(repeat))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \n#é", max_size=80), min_size=1, max_size=4))
def test_counts(texts):
    data = [t.encode() for t in texts]
    part = Slice(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    n, chars, symbols, _, _, dups, repeat = R._counts(part)
    assert list(zip(*(x.tolist() for x in (n, chars, symbols, dups, repeat)))) == [counted(t) for t in texts]


def test_query_is_the_brute_force_count(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = R.op10(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, *rest = counted(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 20 or 100 * rest[-1] > 30 * n)
        assert r.kept == (not r.base_failed and not r.broken_rules)


@pytest.mark.parametrize("n,p", [(1, 0.5), (20, 0.1), (300, 0.0125), (3000, 0.03)])
def test_binomial(n, p):
    for k in {0, 1, 2, n // 10, n - 1, n}:
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(min(k, n) + 1)) if n <= 300 else None
        if want is not None:
            assert R.at_most(k, n, p) == pytest.approx(want, rel=1e-9)
    assert R.at_most(0, 1_000_000_000, 0.01) == 0.0
    assert 0 < R.at_most(n // 2, n, p) <= 1


def labelled(spark, good, bad, lang="en"):
    rows = [(i, v, lang) for i, v in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, "doc_id long, symbols double, stratum string").selectExpr(
        "*", "0D shouting", "0D equal_lines", "0D repeats")
    labels = spark.createDataFrame([(i, int(i < len(good))) for i in range(len(rows))], "doc_id long, quality int")
    return frame, labels


def test_cutoff_is_the_lowest_that_is_proven(spark):
    good = [0.1] * 1000 + [0.3] * 3 + [0.6]
    frame, labels = labelled(spark, good, [0.9] * 50)
    got = {r.rule: r for r in R.cutoffs(frame, labels, "stratum").collect()}
    level, share = 0.05 / 4, 0.05 / 4
    rung = min(c for c in R.LADDER if R.at_most(sum(v >= c for v in good), len(good), share) <= level)
    assert got["symbols"].cutoff == rung and got["symbols"].k == sum(v >= rung for v in good)
    assert got["repeats"].cutoff == R.LADDER[0] and got["repeats"].n == len(good)


def test_too_few_labels_prove_nothing(spark):
    frame, labels = labelled(spark, [0.0] * 20, [0.9] * 20)
    assert R.cutoffs(frame, labels, "stratum").count() == 0


def test_false_rejection_stays_below_the_risk(spark):
    """Of many draws from a population, hardly any cutoff rejects more than its share."""
    r = np.random.default_rng(1)
    share, level, wrong = 0.05 / 4, 0.05 / 4, 0
    for _ in range(300):
        values = r.exponential(0.1, 800)
        best = None
        for c in reversed(R.LADDER):
            if R.at_most(int((values >= c).sum()), 800, share) > level:
                break
            best = c
        wrong += best is not None and math.exp(-best / 0.1) > share
    assert wrong <= 12


def test_odd_rows(spark):
    long = "word " * 40_000
    rows = [(1, None, "en"), (2, "", None), (None, "# # #", "en"), (3, long, "de"), (3, long, "de")]
    docs = spark.createDataFrame([(*x, "n") for x in rows], "doc_id long, text string, lang string, n_words string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    got = R.verdicts(spark, docs, labels).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_repeat_words, list(r.broken)) for r in got), key=str) == sorted(
        [(1, 0, 0, []), (2, 0, 0, []), (None, 3, 0, []), (3, 40_000, 40_000, []), (3, 40_000, 40_000, [])], key=str)
    assert R.verdicts(spark, docs.limit(0), labels).count() == 0
    assert R.verdicts(spark, docs, labels.limit(0)).count() == len(rows)
