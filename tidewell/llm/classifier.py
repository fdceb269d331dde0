"""Quality classifier: ridge regression on random Fourier features.

A text becomes a short vector of statistics (lengths, character classes,
repeats). Random Fourier features ``sqrt(2 / D) cos(W x + b)`` approximate a
Gaussian kernel on the standardized statistics. Each partition of labelled rows
sums its part of the normal equations, Spark adds the parts, and the driver
solves one system of ``D + 1`` unknowns. Rows of another fold calibrate the raw
score: counts per score bin are pooled to the best non-decreasing fit (isotonic
regression), and scores follow the line through its blocks.

All labelled rows are used; what reaches the driver depends on ``FEATURES`` and
``BINS`` alone. Language, source and ids are never inputs of a score.

Defined results: null and empty texts have statistics of zero and are scored
like any other. Labels that are null or belong to no document are ignored;
several labels of one document count as their mean. Without labels every score
is 0.5, and with one class only its rate. Rows with a null id are never learned
from. Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.llm.rules import equal_lines, repeated, sums
from tidewell.llm.texts import INK, Slice, gram_hashes, map_texts, mix, run_hashes

FEATURES, WIDTH, RIDGE, SEED = 128, 3.0, 1e-3, 7
BINS, LOW, HIGH = 600, -1.0, 2.0
THRESHOLD, FOLDS = 0.3, 5


def _class(chars: str) -> np.ndarray:
    member = np.zeros(256, dtype=bool)
    member[[ord(c) for c in chars]] = True
    return member


_CLASSES = [
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("abcdefghijklmnopqrstuvwxyz"), _class("0123456789"),
    _class("!?"), _class(".,;:"), _class("#*$%&|<>"), _class("|"), _class("'\"()[]{}=_/\\@~^`+-"), _class("\n"),
    np.arange(256) >= 128,
]
STATISTICS = 10 + len(_CLASSES)


def _distinct(keys: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    """Distinct keys of each text."""
    _, first = np.unique(mix(keys ^ mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(text[first], minlength=count)


def statistics(part: Slice) -> np.ndarray:
    """One row of statistics per text."""
    count = len(part)
    starts, ends, bounds = part.runs(INK)
    words = run_hashes(part.data, starts, ends)
    n = np.diff(bounds)
    text = np.repeat(np.arange(count), n)
    size = np.diff(part.offsets)
    per_byte = 1.0 / np.maximum(size, 1)
    per_word = 1.0 / np.maximum(n, 1)
    length = ends - starts
    lines, dup_lines = equal_lines(part)
    pairs = gram_hashes(words, 2)
    inside = np.flatnonzero(text[:len(pairs)] == text[len(text) - len(pairs):])
    twin = np.zeros(len(words), dtype=bool)
    twin[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    mean = sums(length, bounds) * per_word
    spread = np.sqrt(np.maximum(sums(length * length, bounds) * per_word - mean * mean, 0))
    last = part.data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    columns = [
        np.log1p(n), np.log1p(size), mean, spread,
        _distinct(words, text, count) * per_word,
        _distinct(pairs[inside], text[inside], count) / np.maximum(n - 1, 1),
        sums(twin, bounds) * per_word,
        repeated(words, bounds, 8) * per_word,
        dup_lines / np.maximum(lines, 1),
        sums(~((last >= 97) & (last <= 122) | (last >= 128)), bounds) * per_word,
        *[sums(c[part.data], part.offsets) * per_byte for c in _CLASSES],
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def _vectors(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with their ``stats``."""
    return map_texts(docs, "stats array<double>", lambda: lambda part: [_vectors(statistics(part))], keep=keep)


@dataclass(frozen=True)
class Model:
    """Everything a score needs; a few thousand numbers."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.centre, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(self.knots):
            return np.full(len(stats), self.values[0] if len(self.values) else 0.5)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(stats: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the standardized statistics, and a constant."""
    draw = np.random.default_rng(SEED)
    w = draw.normal(size=(len(centre), FEATURES)) / (WIDTH * np.sqrt(len(centre) / 4))
    b = draw.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - centre) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ w + b), np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def _normal_equations(rows: DataFrame, centre: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``Z'Z`` and ``Z'y``, summed in each partition and then over the partitions."""
    size = FEATURES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                z = fourier(_matrix(piece.column(0)), centre, scale)
                y = piece.column(1).to_numpy(zero_copy_only=False)
                total += z.T @ np.hstack([z, y[:, None]])
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "v"])

    parts = rows.select("stats", "y").mapInArrow(part, "at long, v double")
    total = np.zeros(size * (size + 1))
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():  # (D + 1)(D + 2) numbers
        total[r.at] = r.v
    total = total.reshape(size, size + 1)
    return total[:, :size], total[:, size]


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing fit of means ``y`` with weights ``n``, as one point per block."""
    blocks: list[list[float]] = []
    for at, value, weight in zip(x, y, n):
        blocks.append([at * weight, value * weight, weight])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    return (np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks]))


def fold(doc_id: str = "doc_id") -> Column:
    """The fold of a row, 0 to 4; 0 is held out. Null ids are held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(0))


def fit(rows: DataFrame) -> Model:
    """A model from rows with ``stats``, ``y`` and ``fold``: fold 1 calibrates, folds
    2 to 4 fit the scores. ``rows`` is read a few times."""
    learn, check = rows.filter("fold > 1"), rows.filter("fold = 1")
    each = [f(F.get(F.col("stats"), i)) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]
    summary = list(learn.agg(F.count("*"), F.avg("y"), *each).first())
    if not summary[0]:
        rate = rows.agg(F.avg("y")).first()[0]
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), None, np.zeros(0),
                     np.array([0.5 if rate is None else rate]))
    # Rounded, so that the order of additions cannot show.
    rounded = np.array([float(f"{v:.6g}") for v in summary[2:]])
    centre, scale = rounded[0::2], np.where(rounded[1::2] > 1e-9, rounded[1::2], 1.0)
    left, right = _normal_equations(learn, centre, scale)
    weights = np.linalg.solve(left + RIDGE * summary[0] * np.eye(len(left)), right)
    model = Model(centre, scale, weights, np.zeros(0), np.zeros(0))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, y = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            at = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            y += np.bincount(at, weights=batch.column(1).to_numpy(zero_copy_only=False), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(n), pa.array(y)], names=["at", "n", "y"])

    source = learn if check.isEmpty() else check
    bins = (source.select("stats", "y").mapInArrow(binned, "at long, n double, y double").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("y").alias("y")).filter("n > 0").orderBy("at").collect())
    n = np.array([r.n for r in bins])
    centres = LOW + (np.array([r.at for r in bins]) + 0.5) * (HIGH - LOW) / BINS
    knots, values = isotonic(centres, np.array([r.y for r in bins]) / n, n)
    return Model(centre, scale, weights, knots, values)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics with labels, outside the held-out fold: ``stats``, ``y``, ``fold``."""
    known = (labels.filter("quality IS NOT NULL").groupBy("doc_id")
             .agg(F.avg(F.col("quality").cast("double")).alias("y")).filter(fold() > 0))
    return stats.join(known, "doc_id").select("stats", "y", fold().alias("fold"))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the stored statistics (``doc_id``, ``stats``) of all documents."""
    stats = measured(docs, keep=["doc_id"]).select(F.col("doc")["doc_id"].alias("doc_id"), "stats")
    stats = stored(spark, stats, "classifier-stats")
    rows = stored(spark, labelled(stats, labels), "classifier-labelled")
    return fit(rows), stats


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row."""
    model, stats = train(spark, docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def good_only(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    model, _ = train(spark, docs, labels)
    found = map_texts(docs, "score double", lambda: lambda part: [model.score(statistics(part))])
    return found.filter(F.col("score") >= threshold).select(*[F.col("doc")[c].alias(c) for c in docs.columns])


@query("op3_quality_classifier")
def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(spark, docs, table(spark, sf_dir, "labels")).select(
        "doc_id", (fold() == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
