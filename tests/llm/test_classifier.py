"""Held-out accuracy, calibration and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import classifier as C

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    good, bad = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    return np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])


def test_held_out_rows(spark):
    rows = {r.doc_id: r for r in C.op3(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for key, r in rows.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [(rows[k].score, y) for k, y in labels.items() if k in rows and rows[k].held_out]
    assert auc(*zip(*test)) > 0.95
    assert np.mean([(s >= 0.3) == y for s, y in test]) > 0.93


def test_only_the_text_counts(spark):
    """Other columns, and labels of the held-out fold, change no score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = {r.doc_id: r.score for r in C.scored(spark, docs, labels).collect()}
    b = {r.doc_id: r.score for r in C.scored(spark, other, turned).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_isotonic():
    x, y = C.isotonic(np.arange(6.0), np.array([0.1, 0.5, 0.3, 0.3, 0.9, 0.8]), np.array([1, 1, 1, 2, 1, 1.0]))
    assert y.tolist() == pytest.approx([0.1, 0.35, 0.85]) and x.tolist() == pytest.approx([0, 2.25, 4.5])


def test_features_approximate_the_kernel():
    r = np.random.default_rng(0)
    x = r.normal(size=(40, C.STATISTICS)) * 0.5
    z = C.fourier(x, np.zeros(C.STATISTICS), np.ones(C.STATISTICS))[:, :-1]
    width = C.WIDTH * np.sqrt(C.STATISTICS / 4)
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width ** 2))
    assert np.abs(z @ z.T - kernel).mean() < 0.12


ROWS = [(1, None), (2, ""), (None, "some text"), (3, "word " * 60_000), (3, "word " * 60_000), (4, "Ünï çødé\n\n!!")]


@pytest.mark.parametrize("labels,want", [
    ([], 0.5), ([(1, 1)], 1.0), ([(2, None), (9, 0)], 0.5),
    ([(1, 1), (2, 0), (2, 1), (3, 0), (4, 1), (None, 1)], None)])
def test_odd_rows(spark, labels, want):
    docs = spark.createDataFrame([(*x, "a", "b") for x in ROWS], "doc_id long, text string, score string, stats string")
    known = spark.createDataFrame([(a, b, 0) for a, b in labels], "doc_id long, quality int, toxic int")
    rows = C.scored(spark, docs, known).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    if want is not None:
        assert {r.score for r in rows} == {want}
    kept = C.good_only(spark, docs, known)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.3 for r in rows)
    assert C.scored(spark, docs.limit(0), known).count() == 0


def test_statistics_do_not_depend_on_neighbours():
    from tidewell.llm.texts import Slice
    texts = ["Aa bb bb\nAa bb bb", "", "x", "é é é\n!"]
    def rows(some):
        data = [t.encode() for t in some]
        return C.statistics(Slice(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])))
    assert np.allclose(rows(texts), np.vstack([rows([t]) for t in texts]))


def plain_scores(docs, labels):
    """Ridge and monotone calibration by plain matrices over all rows at once."""
    from tidewell.llm.texts import Slice
    data = [(t or "").encode() for _, t in docs]
    stats = C.statistics(Slice(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])))
    folds = {k: zlib.crc32(str(k).encode()) % 5 for k in labels}
    of = lambda keep: [i for i, (k, _) in enumerate(docs) if k in labels and keep(folds[k])]
    learn, check = of(lambda f: f > 1), of(lambda f: f == 1)
    six = lambda row: np.array([float(f"{v:.6g}") for v in row])
    centre, scale = six(stats[learn].mean(0)), six(stats[learn].std(0))
    z = C.fourier(stats, centre, np.where(scale > 1e-9, scale, 1.0))
    y = lambda rows: np.array([labels[docs[i][0]] for i in rows], dtype=float)
    n = len(learn)
    # Ridge as least squares with one more row for each weight.
    weights = np.linalg.lstsq(np.vstack([z[learn], np.sqrt(C.RIDGE * n) * np.eye(z.shape[1])]),
                              np.concatenate([y(learn), np.zeros(z.shape[1])]), rcond=None)[0]
    raw = z @ weights
    step = (C.HIGH - C.LOW) / C.BINS
    bins = {}
    for i, label in zip(check, y(check)):
        bins.setdefault(min(max(int((raw[i] - C.LOW) / step), 0), C.BINS - 1), []).append(label)
    at = sorted(bins)
    total, size = np.array([sum(bins[b]) for b in at]), np.array([len(bins[b]) for b in at], dtype=float)
    # The least monotone fit: greatest over starts of the least mean over ends.
    fit = [max(min(total[a:z].sum() / size[a:z].sum() for z in range(i + 1, len(at) + 1)) for a in range(i + 1))
           for i in range(len(at))]
    x, v = [], []
    for value in sorted({round(f, 9) for f in fit}):
        block = [i for i, f in enumerate(fit) if round(f, 9) == value]
        x.append(np.average([C.LOW + (at[i] + 0.5) * step for i in block], weights=size[block]))
        v.append(value)
    return {k: float(np.interp(r, x, v)) for (k, _), r in zip(docs, raw)}


def test_scores_are_those_of_plain_matrices(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    labels = {k: y for k, y in labels.items() if zlib.crc32(str(k).encode()) % 5}
    want = plain_scores(docs, labels)
    got = {r.doc_id: r.score for r in C.op3(spark, SF).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-6
