"""Texts as byte buffers inside Arrow tasks: splitting, hashing, row plumbing.

Every word class used here takes whole runs of bytes from 0x80 up, so words can
be found on UTF-8 bytes without decoding. A task works through its rows in
slices of about ``SLICE_BYTES``; only a single longer text makes a larger one.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``, after lower-casing.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True
#: Bytes of ``[^\x20\x09-\x0D]``.
INK = np.ones(256, dtype=bool)
INK[32] = INK[9:14] = False


class Slice:
    """Some texts in one buffer; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Slice:
        return Slice(LOWER[self.data], self.offsets)

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs of member bytes, never across two texts,
        and the number of runs before each text (one more than texts)."""
        inside = member[self.data]
        first = inside.copy()
        last = inside.copy()
        if len(inside):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = self.offsets[:-1][np.diff(self.offsets) > 0]
            first[edges] = inside[edges]
            edges = self.offsets[1:][np.diff(self.offsets) > 0] - 1
            last[edges] = inside[edges]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the lines (split at ``\n``), and lines before each text."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([self.offsets[1:], breaks])
        text = np.concatenate([np.arange(len(self)),
                               np.searchsorted(self.offsets, breaks, side="right") - 1])
        order = np.lexsort((starts, text))
        counts = np.bincount(text, minlength=len(self))
        # A text's lines, in order: each starts after a break and ends at the next one.
        return starts[order], _line_ends(ends, text), np.concatenate([[0], np.cumsum(counts)])


def _line_ends(ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    return ends[np.lexsort((ends, text))]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Cache(dict):
    """Rebuilt where it is needed, never sent along."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def _power(base: int, count: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < count:
        steps = np.full(max(count, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run; equal runs hash alike wherever they stand.
    Runs come in order and do not overlap; long buffers are taken part by part."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        origin = starts[done]
        upto = max(done + 1, int(np.searchsorted(ends, origin + SLICE_BYTES, side="right")))
        part = data[origin:ends[upto - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(_FACTOR, len(part))[:len(part)],
                  out=sums[1:])
        a, b = starts[done:upto] - origin, ends[done:upto] - origin
        out[done:upto] = (sums[b] - sums[a]) * _power(_INVERSE, len(part) + 1)[a]
        out[done:upto] += (b - a).astype(np.uint64)
        done = upto
    return mix(out)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes (empty when there are fewer)."""
    count = max(0, len(words) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        out *= np.uint64(_FACTOR)
        out += words[i:i + count]
    return mix(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts have no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), offsets


def slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, Slice]]:
    """The column's texts in slices, each with the index of its first text."""
    data, offsets = buffers(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + slice_bytes, side="right")) - 1)
        yield at, Slice(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
        at = end


def map_texts(docs: DataFrame, results: str, work: Callable[[], Callable[[Slice], list]],
              text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` as one struct column ``doc``, beside result columns.

    The input's columns (or those in ``keep``) travel inside ``doc``, so that no
    name of theirs can clash with a result. ``results`` is a DDL schema;
    ``work()`` is called once per task and gives a function from a slice to one
    Arrow-compatible array per result column. Narrow: no row moves.
    """
    fields = [docs.schema[c] for c in (docs.columns if keep is None else keep)]
    schema = T.StructType([T.StructField("doc", T.StructType(fields), False)])
    added = T.StructType.fromDDL(results)
    for field in added:
        schema.add(field)
    rows = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in fields]).alias("doc"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    names = ["doc", *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = work()
        for batch in batches:
            doc, texts = batch.column(0), batch.column(1)
            for at, part in slices(texts):
                found = [x if isinstance(x, pa.Array) else pa.array(x) for x in handle(part)]
                yield pa.RecordBatch.from_arrays([doc.slice(at, len(part)), *found], names=names)

    return rows.mapInArrow(run, schema)


def unpacked(frame: DataFrame) -> DataFrame:
    """The columns of the ``doc`` struct again, as they were."""
    names = frame.schema["doc"].dataType.names
    return frame.select(*[F.col("doc")[n].alias(n) for n in names])


def text_hashes(part: Slice) -> np.ndarray:
    return run_hashes(part.data, part.offsets[:-1], part.offsets[1:])
