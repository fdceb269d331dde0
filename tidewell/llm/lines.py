"""Lines that many documents share, kept in one of them.

Lines are normalised (outer blanks off, A-Z lower-cased), hashed to 128 bits and
exploded, those of at least ``length`` code points only. A hash held by at least
``often`` documents loses its lines everywhere but in the largest document that
holds it; what stays is put together again by position.

Two counts keep the work small and whole. Rows per hash are counted first, with a
map-side combine and one shuffle; no hash of fewer rows can have enough documents.
The distinct documents are then counted for the remaining hashes alone. A hot line
is a row per task in the first count, and spread over its documents in the second.
All joins shuffle at every size, hashes with hashes, and at last the documents, once,
with their dropped positions; a hot hash is a join partition that Spark splits.

A document is a ``doc_id``: rows that share one are one document, and all of them
keep a line which their id wins. Rows without an id are documents by their text,
below every id; the greater MD5 of the text is the larger. Null and empty texts
have one empty line. Repeated rows and their lines are treated alike. Lines are
compared by their hash. Other columns travel in ``doc`` and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
import xxhash

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.llm.texts import Slice, map_texts

LENGTH, OFTEN = 40, 5
BLANK = b" \t\n\v\f\r"
HASHED = "lines array<struct<pos: long, h1: long, h2: long>>"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # of bytes: A-Z alone


def _code_points(key: bytes) -> int:
    return len(key) - sum(1 for b in key if b & 0xC0 == 0x80)


def is_long(key: bytes, length: int) -> bool:
    """Of at least ``length`` code points; a code point has one to four bytes."""
    return len(key) >= length and (len(key) >= 4 * length or _code_points(key) >= length)


def _hashed(part: Slice, length: int) -> list[pa.Array]:
    data, bounds = part.data.tobytes(), part.offsets.tolist()
    counts, places, digests = [0], [], []
    for a, b in zip(bounds, bounds[1:]):
        for place, line in enumerate(data[a:b].split(b"\n")):
            key = line_key(line)
            if is_long(key, length):
                places.append(place)
                digests.append(xxhash.xxh3_128_digest(key))
        counts.append(len(places))
    halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    rows = pa.StructArray.from_arrays(
        [pa.array(places, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["pos", "h1", "h2"])
    return [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)]


def _identity(docs: DataFrame, key: str, text: str) -> list[Column]:
    """The id, and a hash of the text, which tells rows of one id apart."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [F.col(f"`{key}`").alias("id"), F.unhex(F.md5(whole)).alias("t")]


def long_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id`` and ``t`` of the row, ``pos`` and the hash ``h1``, ``h2`` of each long line."""
    rows = docs.select(*_identity(docs, key, text), F.col(f"`{text}`").alias("text"))
    found = map_texts(rows, HASHED, lambda: lambda part: _hashed(part, length), keep=["id", "t"])
    return found.select("doc.*", F.explode("lines").alias("x")).select("id", "t", "x.pos", "x.h1", "x.h2")


def dropped_positions(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                      length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """``id``, ``t`` and the ``positions`` that such rows lose; rows that lose none are left out."""
    lines = stored(spark, long_lines(docs, key, text, length), "lines-hashed")
    candidates = stored(spark, lines.groupBy("h1", "h2").count().filter(F.col("count") >= often)
                        .select("h1", "h2"), "lines-candidates")
    owner = F.struct("id", F.when(F.col("id").isNull(), F.col("t")).alias("t")).alias("owner")
    held = stored(spark, lines.join(candidates, ["h1", "h2"]).select("*", owner), "lines-held")
    common = stored(spark, held.groupBy("h1", "h2").agg(
        F.count_distinct("owner").alias("n"), F.max("owner").alias("largest"))
        .filter(F.col("n") >= often).select("h1", "h2", "largest"), "lines-common")
    lost = held.join(common, ["h1", "h2"])
    return lost.filter(~F.col("owner").eqNullSafe(F.col("largest"))).groupBy("id", "t").agg(
        F.collect_set("pos").alias("positions"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lost = batch.column(1), batch.column(2)
        kept, n_lines, n_dropped = [], [], []
        for text, positions in zip(texts, lost):
            lines = (text.as_py() or "").split("\n")
            out = set(positions.as_py() or ())
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in out) if out else "\n".join(lines))
            n_lines.append(len(lines))
            n_dropped.append(len(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
             pa.array(kept, pa.large_string())], names=["doc", "n_lines", "n_dropped", "kept"])


def without_common_lines(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                         length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with ``n_lines``, ``n_dropped`` and the ``kept`` text."""
    drops = dropped_positions(spark, docs, key, text, length, often).select(
        F.col("id").alias("of"), F.col("t").alias("of_text"), "positions")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       *_identity(docs, key, text))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("of_text"))
    joined = rows.join(drops, same, "left").select("doc", F.col("doc")[text].cast("string").alias("text"), "positions")
    schema = T.StructType([joined.schema["doc"], *T.StructType.fromDDL("n_lines long, n_dropped long, kept string")])
    return joined.mapInArrow(_kept, schema)


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) END AS unnamed
  FROM documents
), lines AS (
  SELECT r, doc_id, unnamed, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM docs
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS largest, max(unnamed) AS largest_unnamed FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) + count(DISTINCT unnamed) >= 5
), judged AS (
  SELECT r, doc_id, pos, line, common.key IS NOT NULL AND CASE
    WHEN doc_id IS NOT NULL THEN doc_id <> largest ELSE largest IS NOT NULL OR unnamed <> largest_unnamed END AS lost
  FROM keyed LEFT JOIN common USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY r
"""


@query("op11_line_dedup", OP11_SQL)
def op11(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_common_lines(spark, docs).select(
        F.col("doc")["doc_id"].alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
