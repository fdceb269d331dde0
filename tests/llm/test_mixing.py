"""Budgets and prefixes against plain Python."""

import hashlib
from collections import defaultdict
from fractions import Fraction
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from helpers import plan
from tidewell.llm import mixing as M


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(children, given):
    """children: {name: (weight, cap)}. Raise a common level until the budget is used."""
    out, open_ = {}, {c: x for c, x in children.items()}
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {c for c, (w, cap) in open_.items()
                if w == 0 or Fraction(cap, w) <= Fraction(given - sum(out.values()), weight)}
        if not full:
            left = given - sum(out.values())
            return out | {c: w * left // weight for c, (w, _) in open_.items()}
        # The fullest first: others may find more room afterwards.
        least = min(full, key=lambda c: Fraction(open_[c][1], open_[c][0] or 1))
        out[least] = open_[least][1] if open_[least][0] else 0
        del open_[least]
    return out


def brute(rows, mix, domain, more=lambda i: ""):
    """{index: copies} for rows of (doc_id, text, lang, source)."""
    leaves, tokens = defaultdict(int), []
    keys = []
    for key, text, lang, source in rows:
        keys.append((domain(source), lang or "", source or ""))
        tokens.append(len(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
        leaves[keys[-1]] += tokens[-1]
    weight = lambda level, name: mix.weights.get(level, {}).get(name, 1)
    cap = {k: n * mix.max_epochs * all(weight(*x) for x in zip(M.LEVELS, k)) for k, n in leaves.items()}
    def share(prefix, given):
        depth = len(prefix)
        if depth == 3:
            return {prefix: given}
        names = {k[depth] for k in leaves if k[:depth] == prefix}
        children = {n: (weight(M.LEVELS[depth], n), sum(c for k, c in cap.items() if k[:depth + 1] == (*prefix, n))) for n in names}
        out = {}
        for n, g in fill(children, given).items():
            out |= share((*prefix, n), g)
        return out
    budget = share((), min(sum(leaves.values()) * mix.percent // 100, sum(cap.values())))
    copies = {}
    for leaf, total in leaves.items():
        epochs = budget[leaf] // total if total else 0
        rest = budget[leaf] - epochs * total
        own = [i for i, k in enumerate(keys) if k == leaf]
        name = lambda i: f"{'' if rows[i][0] is None else rows[i][0]}:{hashlib.md5((rows[i][1] or '').encode()).hexdigest()}{more(i)}"
        place = {i: (number(f"{mix.seed}:{epochs}:{name(i)}"), i) for i in own}
        for i in own:
            used = sum(tokens[j] for j in own if place[j] <= place[i])
            copies[i] = epochs + int(rest > 0 and used <= rest)
    return copies, budget


def domain(source):
    return ["web", "books", "news"][number(source or "") % 3]


@pytest.mark.parametrize("seed,percent,weights", [
    (1, 60, None), (2, 95, {"language": {"a": 9}}), (3, 300, {"domain": {"web": 0}}), (4, 5, {"source": {"s1": 50}}),
    (5, 1000, None)])
def test_same_as_plain_python(spark, seed, percent, weights):
    r = random.Random(seed)
    rows = [(i if r.random() < 0.95 else None, r.choice([None, "", "w " * r.randint(1, 40)]),
             r.choice("aaab") if r.random() < 0.9 else None, f"s{int(r.random() ** 3 * 8)}" if r.random() < 0.95 else None)
            for i in range(400)]
    mix = M.Mix(percent=percent, seed=seed, **({"weights": weights} if weights else {}))
    frame = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, copies int")
    hashes = {r.copies: r.h for r in frame.select("copies", F.hex(F.xxhash64("copies")).alias("h")).collect()}
    want, budget = brute(rows, mix, domain, lambda i: f":{hashes[i]}")
    kept = M.mixed(frame, mix=mix)
    assert kept.columns == frame.columns
    got = {r.copies: r["count"] for r in kept.groupBy("copies").count().collect()}
    assert got == {i: c for i, c in want.items() if c}
    taken, _ = M.plan(spark, frame, M.domain_of(F.col("source")), mix)
    assert {(r.domain, r.language, r.source): r.budget for r in taken.collect()} == budget


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=2), st.tuples(st.integers(0, 5), st.integers(0, 50)), min_size=1),
       st.integers(0, 200))
def test_filling_wastes_nothing(children, given):
    """The rule the SQL is held against: no budget is left while a child has room."""
    children = {c: (w, cap if w else 0) for c, (w, cap) in children.items()}
    got = fill(children, min(given, sum(c for _, c in children.values())))
    assert all(got[c] <= cap for c, (_, cap) in children.items())
    assert min(given, sum(c for _, c in children.values())) - sum(got.values()) < len(children)


def test_repeated_rows_and_empty_table(spark):
    rows = [(7, "a b c", "en", "s")] * 5 + [(8, "a", "en", "s")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sum(len(r.text.split()) for r in M.mixed(frame).collect()) in (9, 10)  # of 18 tokens, 60 %
    assert M.mixed(frame.limit(0)).count() == 0
    blank = frame.withColumn("text", F.lit(None).cast("string"))
    assert M.mixed(blank).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_null_and_repeated_ids_leave_no_budget(spark, seed):
    """A third of the ids null, a third repeated, a third of the rows equal in all: every leaf
    is filled to within its next document, by operator and query alike."""
    r = random.Random(seed)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "w " * r.randint(1, 9) if i % 9 else "same text here", "en", f"s{i % 4 // 3}")
            for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = M.Mix(percent=[40, 130][seed % 2], seed=seed)
    budget = brute(rows, mix, domain)[1]
    got = {(domain(x.source), "en", x.source): x.n for x in M.mixed(frame, mix=mix).groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(M.WORDS))).alias("n")).collect()}
    assert all(budget[k] - 9 < got[k] <= budget[k] for k in budget)


def test_equal_rows_of_which_some_fit(spark, tmp_path):
    rows = [(None, "one two three", "en", "s")] * 2500 + [(i, "w", "en", "s") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    used = M.op1(spark, str(tmp_path))
    assert used.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0] in range(4530 - 2, 4531)
    assert sum(len(x.text.split()) for x in M.mixed(frame).collect()) in range(4530 - 2, 4531)


def test_no_python_runs(spark):
    frame = M.op1(spark, "/root/testdata/sf0.001")
    assert "Python" not in plan(frame) and "Arrow" not in plan(frame)
