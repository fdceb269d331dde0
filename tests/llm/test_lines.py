"""Lines shared by documents, against plain Python."""

import hashlib
from collections import defaultdict

import pytest

from helpers import plan
from tidewell.llm import lines as L

SF = "/root/testdata/sf0.001"


def brute(rows, length=L.LENGTH, often=L.OFTEN):
    """n_lines, n_dropped and the kept text of each (id, text)."""
    owner = lambda i, t: (1, i, "") if i is not None else (0, 0, hashlib.md5((t or "").encode()).hexdigest())
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= length:
                held[key(line)].add(owner(i, t))
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(held[key(x)]) < often or max(held[key(x)]) == owner(i, t)]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, kept int, h1 int")
    got = L.without_common_lines(spark, docs, **more).collect()
    assert all(r.doc.kept == 7 and r.doc.h1 == 8 for r in got)
    return sorted(((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str)


def test_query_is_the_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(docs)]
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in L.op11(spark, SF).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[2] for r in got)


FOOT = "A footer of no fewer than forty code points, É"
ODD = [(1, f"{FOOT}\nown"), (2, f"  {FOOT.replace('A', 'a')}\t\r\nb"), (2, f"again\n{FOOT}"), (3, FOOT), (3, FOOT),
       (None, f"x\n{FOOT}"), (None, f"y\n{FOOT}"), (None, f"y\n{FOOT}"), (4, None), (5, ""), (6, "\n\n"),
       (7, "é" * 40), (8, "É" * 40), (9, "short\n" * 9), (10, f"{FOOT}\n" * 4 + "tail"), (11, "z" * 300_000)]


@pytest.mark.parametrize("often", [2, 5, 6, 7])
def test_odd_rows(spark, often):
    assert result(spark, ODD, often=often) == brute(ODD, often=often)


def test_only_rows_without_ids(spark):
    rows = [(None, f"{i % 6}\n{FOOT}") for i in range(12)]
    got = result(spark, rows)
    assert got == brute(rows) and sum(r[2] == 0 for r in got) == 2


def test_no_rows(spark):
    assert result(spark, ODD[:0] or [], often=2) == []


def test_a_hot_line_is_counted_in_every_task(spark):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", f"concat('{FOOT}', '\n', id) AS text")
    counted = L.long_lines(rows).groupBy("h1", "h2").count()
    assert "partial_count" in plan(counted)
    got = L.without_common_lines(spark, rows)
    assert got.filter("n_dropped = 0").count() == 1 and got.filter("n_dropped = 1").count() == 3999
