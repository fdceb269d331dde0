"""Benchmark decontamination by winnowing.

Per sliding window of k-gram hashes the smallest one is a fingerprint. Two texts
that share ``window`` consecutive words share a whole such window of k-grams, so
they share its fingerprint: no shared span of that length is missed. A hit is
then extended word by word, on the words themselves, to the longest common run.

A benchmark of at most ``block_bytes`` of text, by a sum over all of it, goes to the
tasks as one index, and no document moves. A larger one is joined: fingerprints of
items and of documents meet by a shuffle, which names the documents that may hold
something; their texts then give each hit with the words around it (a window's reach
to either side), and those meet the items' in a second join and are compared there.
The longest runs are put together from the pieces. Frequent fingerprints are salted:
the items' side has a row for each salt that occurs, the documents' side is spread.

Defined results: a null or empty text has no words, no hits, and is clean. An
item without words matches nothing. An item shorter than the window must occur
as a whole. An item whose id is null marks words but is listed nowhere; rows
with the same id count as one item. Repeated documents are judged one by one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.llm.texts import LETTERS, Slice, gram_hashes, map_texts, run_hashes, slices

WINDOW, GRAM = 13, 5
BLOCK_BYTES = 8 << 20
ROW_BYTES = 64  # what a row counts beside its text
SALTS = 16
RESULTS = "n_words long, spans array<struct<item_id: string, start: long, `end`: long>>"


def selected(grams: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each ``size`` consecutive values."""
    count = max(0, len(grams) - size + 1)
    least = grams[:count].copy()
    for i in range(1, size):
        np.minimum(least, grams[i:i + count], out=least)
    return least


def _split(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """Words of one text and their hashes."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    part = Slice(data, np.array([0, len(data)])).lowered()
    starts, ends, _ = part.runs(LETTERS)
    raw = part.data.tobytes()
    return ([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())],
            run_hashes(part.data, starts, ends))


class Index:
    """Fingerprints of one block of items.

    ``shapes`` maps (span length, k) to sorted fingerprints; ``places`` maps a
    fingerprint to where it stands in the items of that span length.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, gram: int):
        self.ids: list[str | None] = []
        self.words: list[list[bytes]] = []
        self.need: list[int] = []
        places: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for name, text in items:
            words, hashes = _split(text)
            if not words:
                continue
            span = min(window, len(words))
            k = min(gram, span)
            grams = gram_hashes(hashes, k)
            least = set(selected(grams, span - k + 1).tolist())
            for at, value in enumerate(grams.tolist()):
                if value in least:
                    places[span, k][value].append((len(self.ids), at))
            self.ids.append(name)
            self.words.append(words)
            self.need.append(span)
        self.places = {shape: dict(found) for shape, found in places.items()}
        self.shapes = {shape: np.array(sorted(found), dtype=np.uint64) for shape, found in places.items()}


def _candidates(words: np.ndarray, bounds: np.ndarray, index: Index) -> Iterator[tuple[int, tuple, int]]:
    """Word positions whose k-gram is a fingerprint here and in the index."""
    for (span, k), known in index.shapes.items():
        grams = gram_hashes(words, k)
        width = span - k + 1
        least = selected(grams, width)
        if not len(least):
            continue
        # The smallest value changes about twice per window: look up each change only.
        changes = np.concatenate([[True], least[1:] != least[:-1]])
        values = least[changes]
        slot = np.minimum(np.searchsorted(known, values), len(known) - 1)
        hit = np.flatnonzero((known[slot] == values)[np.cumsum(changes) - 1])
        if not len(hit):
            continue
        around = hit[:, None] + np.arange(width)
        for at in np.unique(around[grams[around] == least[hit][:, None]]).tolist():
            text = int(np.searchsorted(bounds, at, side="right")) - 1
            yield text, (span, k), at


def _find(part: Slice, index: Index) -> tuple[np.ndarray, list[list[tuple[str | None, int, int]]]]:
    """Words per text, and the longest common runs with the items, in words."""
    low = part.lowered()
    starts, ends, bounds = low.runs(LETTERS)
    words = run_hashes(low.data, starts, ends)
    spans: list[list[tuple[str | None, int, int]]] = [[] for _ in range(len(part))]
    seen: dict[tuple[int, int, int], int] = {}  # (text, item, shift) -> end of its last run
    data = low.data

    def word(i: int) -> bytes:
        return data[starts[i]:ends[i]].tobytes()

    for text, shape, at in _candidates(words, bounds, index):
        first, stop = int(bounds[text]), int(bounds[text + 1])
        for item, place in index.places[shape].get(int(gram_hashes(words[at:at + shape[1]], shape[1])[0]), ()):
            if seen.get((text, item, at - place), -1) > at:
                continue
            own = index.words[item]
            a, b = at, place
            if word(a) != own[b]:
                continue
            while a > first and b > 0 and word(a - 1) == own[b - 1]:
                a, b = a - 1, b - 1
            z, y = at + 1, place + 1
            while z < stop and y < len(own) and word(z) == own[y]:
                z, y = z + 1, y + 1
            seen[text, item, at - place] = z
            if z - a >= index.need[item]:
                spans[text].append((index.ids[item], a - first, z - first))
    return np.diff(bounds), spans


def _matcher(index: Index):
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def handle(part: Slice) -> list:
        counts, spans = _find(part, index)
        rows = [[{"item_id": i, "start": a, "end": z} for i, a, z in found] for found in spans]
        return [counts.astype(np.int64), pa.array(rows, kind)]

    return handle


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with ``n_words`` and ``spans``: each longest run of
    words in common with an item, of ``window`` words or the whole shorter item.
    ``start`` and ``end`` count words, the end exclusive."""
    named = items.select(F.col("`item_id`").cast("string").alias("item_id"), F.col("`text`").cast("string").alias("text"))
    size = named.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    wanted = docs.columns if keep is None else keep
    filled = named.filter(F.octet_length("text") > 0)
    if size > block_bytes:
        return _joined(docs, filled, window, gram, wanted)
    index = Index([tuple(r) for r in filled.collect()], window, gram)
    return map_texts(docs, RESULTS, lambda: _matcher(index), keep=wanted)


# -- a benchmark too large for one index -------------------------------------


HIT = "span: int, fp: long, at: long, off: int, words: string"
_PRINT = pa.schema([("span", pa.int32()), ("fp", pa.int64()), ("at", pa.int64()), ("off", pa.int32()), ("words", pa.string())])
PRINTS = "span int, fp long, at long, off int, words string"


def _around(words: list[bytes], at: int, span: int, k: int) -> tuple[int, str]:
    """The words a window over the gram at ``at`` can reach, and where the gram stands in them."""
    low = max(0, at - (span - k))
    return at - low, b" ".join(words[low:at + span]).decode()


def _prints_of(words: list[bytes], hashes: np.ndarray, span: int, k: int, wanted: np.ndarray | None = None) -> Iterator[tuple]:
    """Rows of ``PRINTS``: each place of a gram that is some window's least (and wanted)."""
    values = gram_hashes(hashes, k)
    least = np.unique(selected(values, span - k + 1))
    if wanted is not None:
        least = np.intersect1d(least, wanted)
    for at in np.flatnonzero(np.isin(values, least)).tolist():
        yield (span, int(values[at:at + 1].view(np.int64)[0]), at, *_around(words, at, span, k))


def _item_prints(window: int, gram: int):
    schema = pa.schema([("item_id", pa.string()), ("row", pa.string()), *_PRINT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                words, hashes = _split(text)
                if words:
                    span = min(window, len(words))
                    found = [(name, row, *p) for p in _prints_of(words, hashes, span, min(gram, span))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)

    return run


def _doc_prints(shapes: list[tuple[int, int]]):
    """Distinct fingerprints of each text, for each shape."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(2)):
                low = part.lowered()
                starts, ends, bounds = low.runs(LETTERS)
                words = run_hashes(low.data, starts, ends)
                text = np.repeat(np.arange(len(part)), np.diff(bounds))
                for span, k in shapes:
                    least = selected(gram_hashes(words, k), span - k + 1)
                    owner = text[:len(least)]
                    inside = owner == text[span - 1:]
                    owner, least = owner[inside], least[inside]
                    order = np.lexsort((least, owner))
                    owner, least = owner[order], least[order]
                    new = np.ones(len(least), dtype=bool)
                    new[1:] = (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
                    at = pa.array(owner[new] + first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(len(at), span, np.int32)),
                         pa.array(least[new].view(np.int64))], names=["k1", "k2", "span", "fp"])

    return run


def _doc_hits(shapes: dict[int, int]):
    """Number of words of each text, and the places of its fingerprints that an item has."""
    kind = pa.list_(pa.struct(list(_PRINT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, k1, k2, texts, known = batch.columns
            for first, part in slices(texts):
                counts = np.diff(part.lowered().runs(LETTERS)[2]).astype(np.int64)
                hits = []
                for row in range(first, first + len(part)):
                    hits.append([])
                    wanted: dict[int, list[int]] = defaultdict(list)
                    for entry in known[row].as_py() or ():
                        wanted[entry["span"]].append(entry["fp"])
                    words, hashes = _split(texts[row].as_py()) if wanted else ([], None)
                    for span, values in wanted.items():
                        values = np.array(values, dtype=np.int64).view(np.uint64)
                        hits[-1] += [dict(zip(_PRINT.names, p))
                                     for p in _prints_of(words, hashes, span, shapes[span], values)]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(first, size), k1.slice(first, size), k2.slice(first, size), pa.array(counts),
                     pa.array(hits, kind)], names=["doc", "k1", "k2", "n_words", "hits"])

    return run


def _pieces(shapes: dict[int, int]):
    """Hits of a document beside those of an item: the common run around each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k1, k2, item_id, row, span, at, off, words, place, item_off, item_words in zip(
                    *(c.to_pylist() for c in batch.columns)):
                own, other, k = words.split(" "), item_words.split(" "), shapes[span]
                if own[off:off + k] != other[item_off:item_off + k]:
                    continue
                a = 0
                while a < min(off, item_off) and own[off - a - 1] == other[item_off - a - 1]:
                    a += 1
                z = k
                while z < min(len(own) - off, len(other) - item_off) and own[off + z] == other[item_off + z]:
                    z += 1
                if a + z >= span:
                    out.append((k1, k2, item_id, row, at - place, at - a, at + z))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["k1", "k2", "item_id", "row", "shift", "a", "z"])

    return run


def _joined(docs: DataFrame, items: DataFrame, window: int, gram: int, wanted: list[str]) -> DataFrame:
    """``contamination`` by joins. Documents are known by two hashes of all their columns:
    equal rows have equal results."""
    spark = docs.sparkSession
    row = F.sha2(F.concat_ws(":", F.coalesce(F.length("item_id"), F.lit(-1)), "item_id", "text"), 256)
    entries = stored(spark, items.select("item_id", row.alias("row"), "text").distinct()
                     .mapInArrow(_item_prints(window, gram), f"item_id string, row string, {PRINTS}"), "benchmark-prints")
    # At most ``window`` of them.
    shapes = {r.span: min(gram, r.span) for r in entries.select("span").distinct().collect()}

    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("doc"),
                        F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("second"), *columns).alias("k2"),
                        F.col("`text`").cast("string").alias("text"))
    salt = F.pmod("k1", F.lit(SALTS)).alias("salt")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    seen = keyed.select("k1", "k2", "text").mapInArrow(_doc_prints(list(shapes.items())), "k1 long, k2 long, span int, fp long")
    hits = stored(spark, seen.select("*", salt).join(
        entries.select("span", "fp").distinct().select("*", salts), ["span", "fp", "salt"], "left_semi"), "benchmark-hits")
    own = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("span", "fp")).alias("known"))
    fields = T.StructType([T.StructField("doc", keyed.schema["doc"].dataType, False)])
    for field in T.StructType.fromDDL(f"k1 long, k2 long, n_words long, hits array<struct<{HIT}>>"):
        fields.add(field)
    placed = stored(spark, keyed.join(own, ["k1", "k2"], "left").select("doc", "k1", "k2", "text", "known")
                    .mapInArrow(_doc_hits(shapes), fields), "benchmark-docs")

    there = entries.join(hits.select("span", "fp", "salt").distinct(), ["span", "fp"]).select(
        "span", "fp", "salt", "item_id", "row", F.col("at").alias("place"), F.col("off").alias("item_off"),
        F.col("words").alias("item_words"))
    pairs = (placed.select("k1", "k2", F.explode("hits").alias("hit")).distinct().select("k1", "k2", salt, "hit.*")
             .join(there, ["span", "fp", "salt"])
             .select("k1", "k2", "item_id", "row", "span", "at", "off", "words", "place", "item_off", "item_words"))
    pieces = pairs.mapInArrow(_pieces(shapes), "k1 long, k2 long, item_id string, row string, shift long, a long, z long")
    # Pieces of one run overlap, so a run starts where no earlier piece reaches.
    line = Window.partitionBy("k1", "k2", "row", "shift").orderBy("a", "z")
    before = F.max("z").over(line.rowsBetween(Window.unboundedPreceding, -1))
    runs = (pieces.select("*", (F.coalesce(before, F.lit(-1)) < F.col("a")).cast("int").alias("new"))
            .select("*", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
            .groupBy("k1", "k2", "row", "shift", "run")
            .agg(F.first("item_id").alias("item_id"), F.min("a").alias("start"), F.max("z").alias("end")))
    spans = runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("item_id", "start", "end")).alias("spans"))
    none = F.array().cast("array<struct<item_id: string, start: long, `end`: long>>")
    return placed.join(spans, ["k1", "k2"], "left").select("doc", "n_words", F.coalesce("spans", none).alias("spans"))


def n_hit(spans: Column) -> Column:
    """Words inside any span: the spans in order, each counted from where the last ended."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("z"))))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(ordered, nothing, lambda got, s: F.struct(
        (got["n"] + F.greatest(F.lit(0).cast("long"), s["z"] - F.greatest(s["a"], got["upto"]))).alias("n"),
        F.greatest(got["upto"], s["z"]).alias("upto")), lambda got: got["n"])


def item_ids(spans: Column) -> Column:
    """Ids of the items found, as sorted strings, without null."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(spans, lambda s: s["item_id"]),
                                                  lambda i: i.isNotNull())))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def clean_only(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = contamination(docs, items, **options)
    names = docs.columns
    kept = found.filter(~contaminated(n_hit(F.col("spans")), F.col("n_words")))
    return kept.select(*[F.col("doc")[c].alias(c) for c in names])


OP2_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, span, array_to_string(words[i:i + span - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - span + 2)) AS i
        FROM (SELECT *, least(13, len(words)) AS span FROM items WHERE len(words) > 0))
), doc_windows AS (
  SELECT r, span, i, array_to_string(words[i:i + span - 1], ' ') AS w
  FROM (SELECT r, words, span, unnest(range(1, len(words) - span + 2)) AS i
        FROM docs, (SELECT DISTINCT span FROM item_windows))
), hits AS (SELECT r, i, span, item_id FROM doc_windows JOIN item_windows USING (span, w)
), covered AS (
  SELECT r, sum(greatest(0, z - greatest(i, coalesce(upto, 0))))::BIGINT AS n_hit
  FROM (SELECT r, i, z, max(z) OVER (PARTITION BY r ORDER BY i, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
        FROM (SELECT DISTINCT r, i, i + span AS z FROM hits)) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hits GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@query("op2_decontaminate", OP2_SQL)
def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        F.col("doc")["doc_id"].alias("doc_id"), "n_words", n_hit(F.col("spans")).alias("n_hit"),
        item_ids(F.col("spans")).alias("ids"),
    ).select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))
