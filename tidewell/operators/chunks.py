"""Snapshots read chunk by chunk, each with its own mark in the change log.

A chunk is a key range of one table, read between two log positions; its rows stand
for the table at the high one, its *mark*. A change counts only behind the
mark of the chunk that governs its key. Chunks may come in any order, be read twice
or overlap. Where several cover a key, the one that reaches furthest governs it, of
equal ones the last read, and only its rows of the key are taken; keys that no chunk
covers keep all their changes.

The governing ranges are disjoint and sorted. A key finds its range by three binary
searches: in the first keys of groups of ranges, which are part of the expression, in
the first keys of its group's leaves, and in its leaf; an equality join brings each of
the two. A record carries no more than such a short list, and none of the searches
reads more than a logarithm of it. Groups and leaves begin at ranges that a hash of
their first key picks, so ranges find their own leaf as the keys do, without being
numbered. No pairs are formed. The list of chunks itself, a row for each, is put in
order by one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_CHUNKS = 10_000  # of one call of even_chunks: as many quantiles reach the driver
GROUP = 4096  # ranges a group on average, at least; the first key of each group is on the driver
MOST_GROUPS = 4096
SMALL = 200_000  # ranges that are sent to every task; more are joined by a shuffle

CHUNK, LOW, HIGH, MARK = "chunk", "low", "high", "mark"


def even_chunks(rows: DataFrame, key: str, count: int) -> list[tuple]:
    """``(chunk, low, high)`` of about equally many rows; the first and last are open."""
    if not 1 <= count <= MOST_CHUNKS:
        raise ValueError(f"between 1 and {MOST_CHUNKS} chunks")
    shares = [i / count for i in range(1, count)]
    cuts = rows.agg(F.percentile_approx(key, shares, 100 * count)).first()[0] if shares else []
    bounds = [None, *sorted(set(cuts or [])), None]
    return [(i, low, high) for i, (low, high) in enumerate(zip(bounds, bounds[1:]))]


def covering(key: Column, low: Column, high: Column) -> Column:
    """Whether a key is in a range: from ``low`` on, below ``high``; null is no bound."""
    return F.coalesce(key >= low, F.lit(True)) & F.coalesce(key < high, F.lit(True))


def governed_ranges(chunks: DataFrame, table: str = "table") -> DataFrame:
    """Disjoint ranges ``table``, ``start`` (null: from the first key), with the ``chunk``
    and ``mark`` that govern them, null where no chunk does.

    One row per chunk bound; of the chunks begun so far, the one that reaches furthest
    covers a bound if any does.
    """
    known = chunks.select(F.col(table).alias("table"), LOW, HIGH, CHUNK, MARK).filter(
        F.col(LOW).isNull() | F.col(HIGH).isNull() | (F.col(LOW) < F.col(HIGH)))
    # A null bound is the least as a start and the greatest as an end.
    reach = F.struct(F.col(HIGH).isNull().alias("open"), F.col(HIGH).alias("high"), F.col(MARK).alias("mark"),
                     F.col(CHUNK).alias("chunk"))
    begun = known.groupBy("table", F.col(LOW).isNotNull().alias("inner"), F.col(LOW).alias("start")).agg(F.max(reach).alias("reach"))
    nothing = F.lit(None).cast(begun.schema["reach"].dataType)
    ended = known.filter(F.col(HIGH).isNotNull()).select(
        "table", F.lit(True).alias("inner"), F.col(HIGH).alias("start"), nothing.alias("reach"))
    bounds = begun.union(ended).groupBy("table", "inner", "start").agg(F.max("reach").alias("reach"))
    sofar = Window.partitionBy("table").orderBy("inner", "start").rowsBetween(Window.unboundedPreceding, 0)
    best = bounds.withColumn("best", F.max("reach").over(sofar))
    covers = F.col("best.open") | (F.col("best.high") > F.col("start")) | ~F.col("inner") & F.col("best").isNotNull()
    return best.select("table", "start", *[F.when(covers, F.col(f"best.{c}")).alias(c) for c in ("chunk", "mark")])


def at_or_below(bounds: Column, size: Column, key: Column, of: Callable[[Column], Column] = lambda x: x) -> Column:
    """How many of a sorted array's elements (``of`` each) are at most ``key``, by binary search:
    steps of falling powers of two, each taken if the element behind it is still at most ``key``."""
    powers = F.sequence(F.ceil(F.log2(size + 1)).cast("int"), F.lit(0), F.lit(-1))

    def step(found: Column, power: Column) -> Column:
        on = found + F.call_function("shiftleft", F.lit(1), power)
        return F.when(of(F.get(bounds, on - 1)) <= key, on).otherwise(found)

    return F.when(size > 0, F.aggregate(powers, F.lit(0), step)).otherwise(F.lit(0))


def located(frame: DataFrame, ranges: DataFrame, table: Column, key: Column) -> DataFrame:
    """``frame`` with ``_chunk`` and ``_mark`` of the range that each record's key is in."""
    kind = T.StructType([T.StructField(c, ranges.schema[c].dataType) for c in ("table", "start")])

    def at(*own: Column) -> Column:
        return F.struct(*[value.cast(of.dataType).alias(of.name) for value, of in zip(own, kind)]).cast(kind)

    keyed = ranges.select(at(F.col("table"), F.col("start")).alias("_at"), "chunk", "mark")
    count, least = keyed.agg(F.count("*"), F.min("_at")).first()
    if not count:
        return frame.select("*", *[F.lit(None).cast(ranges.schema[c].dataType).alias(f"_{c}") for c in ("chunk", "mark")])
    leaf = math.ceil(math.sqrt(max(GROUP, count / MOST_GROUPS)))  # ranges a leaf, and leaves a group

    def begins(size: int) -> Column:
        hashed = F.xxhash64("_at.table", "_at.start") % size == 0
        return hashed | F.col("_at").eqNullSafe(at(*map(F.lit, least)))

    cuts = keyed.filter(begins(leaf * leaf)).select("_at.*").distinct().orderBy("table", "start").collect()
    root = F.array(*[at(*map(F.lit, cut)) for cut in cuts]).cast(T.ArrayType(kind))
    group = at_or_below(root, F.lit(len(cuts)), F.col("_at"))
    firsts = keyed.filter(begins(leaf)).groupBy(group.alias("_group")).agg(F.sort_array(F.collect_set("_at")).alias("_firsts")).persist()

    def placed(rows: DataFrame) -> DataFrame:
        grouped = rows.withColumn("_group", group).join(F.broadcast(firsts), "_group", "left")
        return grouped.withColumn("_leaf", at_or_below(F.col("_firsts"), F.size("_firsts"), F.col("_at"))).drop("_firsts")

    leaves = placed(keyed).groupBy("_group", "_leaf").agg(
        F.sort_array(F.collect_list(F.struct("_at", "chunk", "mark"))).alias("_ranges"))
    joined = placed(frame.withColumn("_at", at(table, key))).join(
        F.broadcast(leaves) if count <= SMALL else leaves, ["_group", "_leaf"], "left")
    below = at_or_below(F.col("_ranges"), F.size("_ranges"), F.col("_at"), lambda r: r["_at"])
    found = joined.withColumn("_r", F.get("_ranges", below - 1))
    same = F.col("_r._at.table") == F.col("_at.table")
    return found.select(*[F.col(f"`{c}`") for c in frame.columns],
                        *[F.when(same, F.col(f"_r.{c}")).alias(f"_{c}") for c in ("chunk", "mark")])


def chunked_snapshot(snapshot: DataFrame, changes: DataFrame, chunks: DataFrame, table: str, key: str,
                     seq: str = "seq") -> DataFrame:
    """Snapshot rows and the changes behind their chunks' marks, as one feed.

    ``chunks`` has ``table``, ``chunk``, ``low``, ``high`` and ``mark``; ``snapshot`` the
    number of the ``chunk`` that read each row, ``changes`` the log position ``seq``.
    Both have the columns ``table`` and ``key``; ``chunk`` is left out of the result.
    """
    ranges = governed_ranges(chunks).persist()
    own = located(snapshot, ranges, F.col(table), F.col(key)).filter(F.col("_chunk") == F.col(CHUNK))
    behind = located(changes, ranges, F.col(table), F.col(key)).filter(
        F.col("_mark").isNull() | (F.col(seq) > F.col("_mark")))
    return own.drop("_chunk", "_mark", CHUNK).unionByName(behind.drop("_chunk", "_mark"))


def chunk_offsets(chunks: DataFrame, position: Column | int, table: str = "table") -> DataFrame:
    """State of each table's snapshot: ``finished`` chunks of ``n``, the least and greatest
    mark, and whether the log has passed all marks, so that marks need no more looking up."""
    return chunks.groupBy(table).agg(
        F.count("*").alias("n"), F.count(MARK).alias("finished"), F.min(MARK).alias("least_mark"),
        F.max(MARK).alias("greatest_mark")).withColumn(
        "passed", (F.col("n") == F.col("finished")) & (F.col("greatest_mark") <= position))


def unfinished(chunks: DataFrame) -> DataFrame:
    """Chunks still to be read after a restart: those without a mark."""
    return chunks.filter(F.col(MARK).isNull())


def columns_of(chunks: Sequence[tuple], table: str, marks: Sequence[int | None]) -> list[tuple]:
    """Rows of a chunk table from ``even_chunks`` and the marks at which they were read."""
    return [(table, i, low, high, mark) for (i, low, high), mark in zip(chunks, marks)]
