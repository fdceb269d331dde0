"""SimHash fingerprints and near duplicates by meeting in the middle.

Two fingerprints ``a`` and ``b`` that differ in at most ``2 r`` bits have a value
between them, within ``r`` bits of both. So when each emits all variants within
half the radius, every close pair meets at a common variant, and one shuffle on
the variants finds all of them.

The radius here is 3, and half of it is no whole number. The 64 bits are split
into three blocks of 21, 21 and 22, and for each block every fingerprint emits the
variants within one bit of its other bits (131 variants instead of the 2,081 within
two bits). Fingerprints that meet at a variant differ in at most two of those bits,
so those whose blocks are equal or one bit apart are links. That leaves one kind
of pair, all three bits in one block; such a pair meets at the unchanged other bits,
where block values three bits apart are linked too. No close pair is missed and
none is assumed: every link is verified on all 64 bits.

Equal fingerprints are one node, so groups of copies cost nothing. At a variant
the nodes are linked through their block values; where there are more than
``FEW`` of these, by looking up the neighbours of each value, not pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.components import components, stored
from tidewell.llm.registry import query, table
from tidewell.llm.texts import INK, Slice, map_texts

SEED, SHINGLE, RADIUS = 42, 3, 3
#: First bit and width of each block.
BLOCKS = ((0, 21), (21, 21), (42, 22))
FEW = 256

# -- fingerprints ----------------------------------------------------------


def _fingerprints(part: Slice, shingle: int, seed: int) -> np.ndarray:
    low = part.lowered()
    starts, ends, bounds = low.runs(INK)
    if not len(starts):
        return np.zeros(len(part), dtype=np.uint64)
    # One space after each word, whatever stood there; word places shift along.
    keep = INK[low.data]
    gaps = ends[ends < len(low.data)]
    gaps = gaps[~keep[gaps]]
    keep[gaps] = True
    spaced = np.where(INK[low.data], low.data, np.uint8(32))[keep]
    place = np.cumsum(keep) - 1
    a, z = place[starts], place[ends - 1] + 1
    raw = spaced.tobytes()
    out = np.zeros(len(part), dtype=np.uint64)
    for i in range(len(part)):
        lo, hi = bounds[i], bounds[i + 1]
        if lo == hi:
            continue
        step = min(shingle, hi - lo) - 1
        cuts = map(slice, a[lo:hi - step].tolist(), z[lo + step:hi].tolist())
        count = hi - lo - step
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(raw.__getitem__, cuts), repeat(seed)),
                             dtype=np.uint64, count=count)
        out[i] = _majority(hashes)
    return out


def _majority(hashes: np.ndarray, rows: int = 1 << 16) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), rows):
        octets = hashes[at:at + rows].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED,
                 keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with the SimHash ``fp`` of the whole text (a
    bigint holding 64 bits). Null, empty and blank texts have fingerprint zero;
    texts of fewer words than a shingle are one shingle."""

    def work():
        return lambda part: [_fingerprints(part, shingle, seed).view(np.int64)]

    return map_texts(docs, "fp long", work, keep=keep)


# -- links -----------------------------------------------------------------

def _inside(fps: np.ndarray, block: int) -> np.ndarray:
    """The value of a block."""
    at, width = BLOCKS[block]
    return (fps >> np.uint64(at)) & np.uint64((1 << width) - 1)


def _beside(fps: np.ndarray, block: int) -> np.ndarray:
    """The bits beside a block, with the block's number above them."""
    at, width = BLOCKS[block]
    low = fps & np.uint64((1 << at) - 1)
    high = np.zeros_like(fps) if at + width == 64 else (fps >> np.uint64(at + width)) << np.uint64(at)
    return low | high | np.uint64(block << 48)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(every), 2000):
            fps = every[at:at + 2000]
            for block, (_, width) in enumerate(BLOCKS):
                flips = np.array([0] + [1 << bit for bit in range(64 - width)], dtype=np.uint64)
                keys = (_beside(fps, block)[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.repeat(fps, len(flips)).view(np.int64))],
                    names=["variant", "fp"])


def _near_values(values: np.ndarray, bits: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted, distinct block values exactly ``bits`` bits apart."""
    if len(values) < 2:
        return
    if len(values) <= FEW:
        i, j = np.triu_indices(len(values), 1)
        near = np.bitwise_count(values[i] ^ values[j]) == bits
        yield i[near], j[near]
        return
    for flipped in combinations(range(width), bits):
        other = values ^ np.uint64(sum(1 << b for b in flipped))
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        i = np.flatnonzero((values[at] == other) & (values < other))
        yield i, at[i]


def _links(variant: int, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among the fingerprints that meet at a variant."""
    block = variant >> 48
    width = BLOCKS[block][1]
    values = _inside(fps, block)
    order = np.argsort(values, kind="stable")
    fps, values = fps[order], values[order]
    lead = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    leader = np.repeat(lead, np.diff(np.append(lead, len(fps))))
    rest = leader != np.arange(len(fps))
    yield fps[leader[rest]], fps[rest]
    for i, j in _near_values(values[lead], 1, width):
        yield fps[lead[i]], fps[lead[j]]
    here = np.sort(fps[_beside(fps, block) == np.uint64(variant)])
    for i, j in _near_values(_inside(here, block), 3, width):
        yield here[i], here[j]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows that come sorted by variant; the last variant of a batch
    may go on in the next one."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def closed(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
        size = np.diff(np.append(first, len(keys)))
        found = [pair for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist())
                 for pair in _links(int(keys[at]), fps[at:at + n])]
        if not found:
            return
        a = np.concatenate([x for x, _ in found])
        b = np.concatenate([y for _, y in found])
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))],
                                         names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if keys[0] == keys[-1]:
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        yield from closed(keys[:cut], fps[:cut])
        keys, fps = keys[cut:].copy(), fps[cut:].copy()
    yield from closed(keys, fps)


def links(nodes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints in ``nodes.fp``, enough to
    connect all that differ in at most three bits, and only such pairs."""
    met = (nodes.select("fp").mapInArrow(_emit, "variant long, fp long")
           .repartition("variant").sortWithinPartitions("variant")
           .mapInArrow(_meet, "a long, b long"))
    return (met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
            .distinct())


# -- groups ----------------------------------------------------------------


def groups(spark: SparkSession, marked: DataFrame, order: str) -> DataFrame:
    """``fp`` and ``first``: the least ``order`` value in its group, for every
    fingerprint that stands in ``marked``. ``marked`` must be cheap to read again."""
    nodes = stored(spark, marked.groupBy("fp").agg(F.min(order).alias("first")), "simhash-nodes")
    roots = components(spark, links(nodes), "simhash")
    named = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(spark, named, "simhash-named")
    firsts = named.groupBy("root").agg(F.min("first").alias("least"))
    return named.join(firsts, "root").select("fp", F.col("least").alias("first"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", shingle: int = SHINGLE,
                    seed: int = SEED) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the least id in the row's group of
    near duplicates. Fingerprints of at most three differing bits link, groups are
    the connected components, and equal rows stand in one group. A row whose id is
    null keeps null unless its group has ids."""
    spark = docs.sparkSession
    found = fingerprints(docs, shingle, seed, keep=[doc_id])
    marked = stored(spark, found.select(F.col("doc")[doc_id].alias("doc_id"), "fp"), "simhash-fp")
    least = groups(spark, marked, "doc_id").withColumnRenamed("fp", "_fp")
    return marked.join(least, F.col("fp") == F.col("_fp")).select(
        "doc_id", "fp", F.col("first").alias("component_id"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", shingle: int = SHINGLE,
                  seed: int = SEED) -> DataFrame:
    """One document of each group of near duplicates, with its own columns: the one
    with the least id (null ids last), then the least hash of the whole row; of
    wholly equal rows one. The documents are stored once with a number, so that the
    kept ones are known by number and each text is shuffled once at most."""
    spark = docs.sparkSession
    names = docs.columns
    doc = F.col("doc")
    own = F.struct(doc[doc_id].isNull().alias("no_id"), doc[doc_id].alias("id"),
                   F.xxhash64(*[doc[c] for c in names]).alias("hash"), F.monotonically_increasing_id().alias("row"))
    found = stored(spark, fingerprints(docs, shingle, seed, keep=names).withColumn("rank", own), "simhash-docs")
    least = groups(spark, found.select("fp", "rank"), "rank").select(F.col("first.row").alias("row")).distinct()
    kept = found.withColumn("row", F.col("rank.row")).join(least, "row", "left_semi")
    return kept.select(*[doc[c].alias(c) for c in names])


@query("op5_simhash")
def op5(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
