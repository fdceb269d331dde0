"""Logical tags, targets and per-table routing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = "_tag"
SUFFIX = r"_\d+$"
MOST_TABLES = 100_000


def logical_tag(db: Column, table: Column) -> Column:
    """``order_03``, ``orders`` -> ``order.orders``."""
    return F.concat(F.regexp_replace(db, SUFFIX, ""), F.lit("."), table)


def resolve_tag(tag: Column, known: Sequence[str]) -> Column:
    """The tag when it is known, else the tag without the table's own numeric
    suffix when that is known, else null."""
    short = F.regexp_replace(tag, SUFFIX, "")
    names = list(known)
    return F.when(tag.isin(names), tag).when(short.isin(names), short)


def resolve_tag_from(frame: DataFrame, known: DataFrame, tag: str = TAG) -> DataFrame:
    """As ``resolve_tag`` with the known tags in a frame with a ``tag`` column.

    The list of captured tables is read first (at most ``MOST_TABLES``, else an
    error) and becomes part of the expression: the records are not shuffled.
    """
    names = [r.tag for r in known.select("tag").distinct().limit(MOST_TABLES + 1).collect()]
    if len(names) > MOST_TABLES:
        raise ValueError(f"more than {MOST_TABLES} known tags")
    return frame.withColumn(tag, resolve_tag(F.col(tag), names))


def bare_table(table: Column) -> Column:
    """A table name given as a pattern, cut one character before its bracket:
    ``x_month_[0-9]{6}`` -> ``x_month``."""
    at = F.instr(table, "[")
    return F.when(at == 0, table).otherwise(F.substr(table, F.lit(1), at - 2))


def bare_table_name(table: str) -> str:
    at = table.find("[")
    return table if at < 0 else table[: at - 1]


def target_names(db: Column, table: Column, shard: Column, root: str,
                 prefix: str = "lake_") -> dict[str, Column]:
    """Target database, table and path of a logical table's shard."""
    target_db = F.concat(F.lit(prefix), db)
    target_table = F.concat(bare_table(table), F.lit("_"), shard.cast("string"))
    return {
        "target_db": target_db,
        "target_table": target_table,
        "target_path": F.concat(F.lit(root.rstrip("/")), F.lit("/"), target_db, F.lit("/"),
                                target_table),
    }


def bucket_counts(tables: Sequence[str], buckets: Sequence[int]) -> dict[str, int]:
    """Buckets by table, from two lists of equal length."""
    if len(tables) != len(buckets):
        raise ValueError("the list of bucket counts and the list of tables differ in length")
    return dict(zip(tables, map(int, buckets)))


def with_bucket_count(frame: DataFrame, buckets: Mapping[str, int]) -> DataFrame:
    """Add the table's ``buckets``; null for tables that are not listed, whose records
    stay (``unrouted`` finds them). The list is part of the expression: no join."""
    counts = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair]) if buckets else \
        F.create_map().cast("map<string,int>")
    return frame.withColumn("buckets", counts[F.col(TAG)])


def route(frame: DataFrame, tags: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per tag over a shared parent; records of other tags are in none."""
    return {tag: frame.filter(F.col(TAG) == tag) for tag in tags}


def unrouted(frame: DataFrame, tags: Sequence[str]) -> DataFrame:
    return frame.filter(F.col(TAG).isNull() | ~F.col(TAG).isin(list(tags)))


def keep_routed(frame: DataFrame, tags: Sequence[str]) -> DataFrame:
    """The records of all the tags as one frame: one pass over their parent."""
    return frame.filter(F.col(TAG).isin(list(tags)))


def union_routed(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of different parents as one, columns by name. For the tags of one
    parent use ``keep_routed``, which reads it once."""
    whole, *others = frames
    for other in others:
        whole = whole.unionByName(other)
    return whole


def table_pattern_filter(frame: DataFrame, patterns: Sequence[str], db: str = "db",
                         table: str = "table") -> DataFrame:
    """Keep physical tables whose ``db.table`` matches one of the patterns in full."""
    for pattern in patterns:
        re.compile(pattern)
    whole = "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$"
    return frame.filter(F.concat_ws(".", F.col(db), F.col(table)).rlike(whole))


def expand_tables(tables: DataFrame, postfixes: Sequence[str], name: str = "name") -> DataFrame:
    """``db.table`` names times shard postfixes, as column ``physical``:
    ``order.orders`` and ``_03`` give ``order_03.orders``.

    A name of another shape fails the job. Each row explodes the short list of
    postfixes, so no pairwise join is planned.
    """
    parts = F.split(F.col(name), r"\.")
    checked = F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(
        F.concat(F.lit("table must be written db.table: "), F.col(name))))
    shards = F.explode(F.array(*[F.lit(p) for p in postfixes]))
    named = tables.withColumn("_parts", checked)
    return (named.select("*", shards.alias("postfix"))
            .withColumn("physical", F.concat(F.get("_parts", F.lit(0)), F.col("postfix"),
                                             F.lit("."), F.get("_parts", F.lit(1))))
            .drop("_parts"))
