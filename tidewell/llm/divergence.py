"""How far the word use of each source lies from the others, and in which words.

Within a language, every source has a smoothed frequency ``p`` of each kept term (one
found in enough documents), as a whole number of billionths. Two sources are as far
apart as the sum of their differences over all kept terms, absent ones included.

Taken term by term, that is a difference for each pair of sources and term. Instead a
term is a row of its nonzero counts in the order of the sources, and the rows of a
language go into a frequent-pattern tree: rows that begin alike share a path, whose
nodes hold how many rows pass. With ``z`` the frequency of an absent term, the
distance of a and b is ``V |za - zb|``, plus ``|p - zb| - |za - zb|`` for each nonzero
``p`` of a (and the other way round), plus for each row in which both are nonzero
``|pa - pb| - |pa - zb| - |za - pb| + |za - zb|``. Only the last depends on pairs; it
is worked out once for each node and ancestor, times the rows through the node.

Equal rows are counted before the tree is built. The tree is cut into ranges of rows
that begin alike, one a task; a node that straddles a cut is counted in two parts,
which add up. Sources come in ascending order of size, since low counts repeat most. A
source's rows, however many, are counted in the task that reads them, and only
numbers by term move. Lists of sources are broadcast up to ``MOST_GROUPS`` of them,
and joined by shuffles beyond; the result itself has a row per pair of them.

Defined results: null text, language and source are empty strings. A source without
kept terms is compared like any other; in a language without kept terms all distances
are zero. Repeated rows are documents of their own. Terms are compared as such, and
all sums are whole numbers. Without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.llm.texts import Slice, slices

LEAST_DOCS, TOP, SMOOTHING, SCALE = 30, 50, 5, 1_000_000_000
MOST_GROUPS = 100_000
HELD = 400_000  # counts of a task that wait to be added up
RANGE_ROWS, SHARED = 20_000, 8  # rows of a range of the tree, and items by which ranges are cut
#: Bytes of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]``, after lower-casing.
TERM = np.zeros(256, dtype=bool)
TERM[97:123] = TERM[128:] = True


def _words(part: Slice) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of the words, what they stand for, and the text that each is in."""
    low = part.lowered()
    starts, ends, bounds = low.runs(TERM)
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = low.data[TERM[low.data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.repeat(np.arange(len(part)), np.diff(bounds))


def _counted(part: Slice, group: np.ndarray) -> pa.Table:
    """Occurrences ``n`` and ``docs`` of each group and term of a slice."""
    code, terms, text = _words(part)
    size = max(1, len(terms))
    in_text, n = np.unique(text * size + code, return_counts=True)
    key = group[in_text // size] * size + in_text % size
    order = np.argsort(key, kind="stable")
    key, first = np.unique(key[order], return_index=True)
    docs = np.diff(np.append(first, len(order)))
    n = np.add.reduceat(n[order], first) if len(first) else n
    return pa.table({"g": key // size, "term": terms.take(pa.array(key % size)), "n": n.astype(np.int64), "docs": docs})


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def added() -> pa.Table:
        one = pa.concat_tables(held).group_by(["g", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return one.select(["g", "term", "n_sum", "docs_sum"]).rename_columns(["g", "term", "n", "docs"])

    def out(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        pairs, g = list(names), counts["g"]
        lang, source = (pa.array([p[i] for p in pairs], pa.string()).take(g.combine_chunks()) for i in (0, 1))
        terms = counts["term"].cast(pa.string())
        yield from pa.table({"lang": lang, "source": source, "term": terms, "n": counts["n"], "docs": counts["docs"]}).to_batches(50_000)

    for batch in batches:
        group = np.array([names.setdefault(pair, len(names)) for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())],
                         dtype=np.int64)
        for at, part in slices(batch.column(2)):
            held.append(_counted(part, group[at:at + len(part)]))
            if sum(map(len, held)) > HELD:
                held = [added()]
                if len(held[0]) > HELD // 2:
                    yield from out(held.pop())
    if held:
        yield from out(added())


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term`` with ``n`` occurrences in ``docs`` documents; several rows of a
    term are to be added."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long")


def frequency(n: Column, total: Column, terms: Column) -> Column:
    """Billionths; decimals hold the product exactly, and none is there without terms."""
    share = F.call_function("div", (n + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE),
                            total.cast("decimal(20,0)") + terms * F.lit(SMOOTHING))
    return F.when(terms > 0, share + 1).otherwise(F.lit(0).cast("long"))


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Counts of the kept terms by source; ``total`` is the language's, ``first`` marks one row a term."""
    of_term = W.partitionBy("lang", "term")
    counts = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.withColumns({
        "in_docs": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term),
        "first": F.row_number().over(of_term.orderBy("source")) == 1,
    }).filter(F.col("in_docs") >= least_docs).select("lang", "term", "source", "n", "total", "first")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every source of a language: its number ``s`` there, its ``size``, the language's
    ``terms`` and ``lang_size``, and ``z``, the frequency of a term it lacks."""
    occurring = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("first").alias("terms"))
    of_lang = W.partitionBy("lang")
    found = occurring.join(sizes, ["lang", "source"], "left").fillna(0, ["size", "terms"])
    found = found.withColumns({"terms": F.sum("terms").over(of_lang), "lang_size": F.sum("size").over(of_lang),
                               "s": F.row_number().over(of_lang.orderBy("size", "source"))})
    return found.withColumn("z", frequency(F.lit(0), F.col("size"), F.col("terms")))


PATH = "array<struct<s: int, n: long, p: long, z: long>>"


def _tree_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order, so a node is a run of rows that begin alike."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        cuts = [0, *[i for i in range(1, len(langs)) if langs[i] != langs[i - 1]], len(langs)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                paths = batch.column(1).slice(a, b - a)
                left, right, value = corrections(paths, batch.column(2).slice(a, b - a).to_numpy())
                yield pa.RecordBatch.from_pydict({"lang": [langs[a]] * len(left), "a": left, "b": right, "value": value})


def corrections(paths: pa.ListArray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums by pair of sources over the tree of these rows, each there so many times."""
    items, lengths = paths.flatten(), np.diff(paths.offsets.to_numpy())
    row = np.repeat(np.arange(len(paths)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    shape = (len(paths), int(lengths.max(initial=0)))
    s, n, p, z = (np.full(shape, -1, dtype=np.int64) for _ in range(4))
    for name, filled in zip("snpz", (s, n, p, z)):
        filled[row, place] = items.field(name).to_numpy()
    # A node begins where a row differs from the one before, here or earlier.
    new = np.ones(shape, dtype=bool)
    new[1:] = np.logical_or.accumulate((s[1:] != s[:-1]) | (n[1:] != n[:-1]), axis=1)
    sums: dict[int, int] = {}
    width = int(s.max(initial=0)) + 1
    for j in range(1, shape[1]):
        first = np.flatnonzero(new[:, j])
        through = np.add.reduceat(times, first)
        real = s[first, j] >= 0
        first, through = first[real], through[real]
        b, pb, zb = s[first, j], p[first, j], z[first, j]
        for i in range(j):
            a, pa_, za = s[first, i], p[first, i], z[first, i]
            change = through * (np.abs(pa_ - pb) - np.abs(pa_ - zb) - np.abs(za - pb) + np.abs(za - zb))
            codes, where = np.unique(np.minimum(a, b) * width + np.maximum(a, b), return_inverse=True)
            total = np.zeros(len(codes), dtype=np.int64)
            np.add.at(total, where, change)
            for code, value in zip(codes.tolist(), total.tolist()):
                sums[code] = sums.get(code, 0) + value
    codes = np.array(list(sums), dtype=np.int64)
    return codes // width, codes % width, np.array(list(sums.values()), dtype=np.int64)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b")]


def distances(spark: SparkSession, measured: DataFrame, found: DataFrame) -> DataFrame:
    """``lang``, ``a`` < ``b`` (numbers of sources) and their distance ``value``."""
    rows = measured.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("s", "n", "p", "z"))).cast(PATH).alias("path"))
    rows = stored(spark, rows.groupBy("lang", "path").agg(F.count("*").alias("times")), "divergence-rows")
    # A short text for the cuts, since Spark samples them on the driver; equal ones are spread.
    start = F.array_join(F.transform(F.slice("path", 1, SHARED), lambda x: F.concat(
        x["s"].cast("string"), F.lit(":"), x["n"].cast("string"))), ",")
    shared = rows.repartitionByRange(rows.count() // RANGE_ROWS + 1, "lang", start, F.hash("path")).sortWithinPartitions(
        "lang", "path").mapInArrow(
        _tree_corrections, "lang string, a long, b long, value long")
    other = found.select("lang", F.col("s").alias("s2"), F.col("z").alias("z2"))
    apart = F.abs(F.col("z") - F.col("z2"))
    alone = (measured.groupBy("lang", "s", "p", "z").agg(F.count("*").alias("times")).join(other, "lang").filter("s <> s2")
             .select("lang", *_pair("s", "s2"), (F.col("times") * (F.abs(F.col("p") - F.col("z2")) - apart)).alias("value")))
    absent = found.join(other, "lang").filter("s < s2").select("lang", *_pair("s", "s2"), (F.col("terms") * apart).alias("value"))
    return shared.union(alone).union(absent).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(spark: SparkSession, docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    kept = stored(spark, kept_terms(docs, least_docs), "divergence-terms")
    found = stored(spark, groups(docs, kept), "divergence-groups")
    few = F.broadcast if found.count() <= MOST_GROUPS else lambda frame: frame
    measured = stored(spark, kept.join(few(found), ["lang", "source"]).select(
        "lang", "source", "term", "s", "n", "z", frequency(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
        frequency(F.col("total"), F.col("lang_size"), F.col("terms")).alias("q")), "divergence-measured")
    of_group = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = (measured.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                             (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(of_group)).filter(F.col("rank") <= top))
    names = found.select("lang", F.col("s").cast("long").alias("s"), "source")
    apart = distances(spark, measured, few(found))
    both = apart.select("lang", "a", "b", "value").union(apart.select("lang", "b", "a", "value"))
    pairs = (both.join(few(names.withColumnRenamed("s", "a")), ["lang", "a"])
             .join(few(names.select("lang", F.col("s").alias("b"), F.col("source").alias("item"))), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(of_group)))
    return pairs.union(words)


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), langs AS (
  SELECT lang, (SELECT count(*) FROM kept WHERE kept.lang = d.lang) AS v,
         (SELECT coalesce(sum(total), 0) FROM kept WHERE kept.lang = d.lang) AS n FROM (SELECT DISTINCT lang FROM docs) d
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY ALL
), measured AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * v) AS p, 1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * v) AS q
  FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         (SELECT coalesce(sum(abs(x.p - y.p)), 0) FROM measured x JOIN measured y ON x.lang = y.lang AND x.term = y.term
          WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source)::BIGINT AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM measured WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", OP13_SQL)
def op13(spark, sf_dir: str) -> DataFrame:
    return divergence(spark, table(spark, sf_dir, "documents").select("lang", "source", "text"))
