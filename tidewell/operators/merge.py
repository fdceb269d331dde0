"""Newest version per key, and base plus log merged at read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.changelog import AFTER, BEFORE, INSERT
from tidewell.spec import KIND, SUB

DEFAULT_ORDER = ("seq", SUB)


def newest_versions(changes: DataFrame, keys: Sequence[str],
                    order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """One row per key: the version with the greatest ``order``, deletes included.

    The maximum is an aggregate, so each map task sends one row per key and a
    key that holds a large part of all rows costs no more than any other. ``-U``
    images are never the newest of their key and are left out before the shuffle.
    Versions of equal order are told apart by their values, so the result does
    not depend on how the rows were spread.
    """
    rest = [c for c in changes.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    if any(isinstance(changes.schema[c].dataType, (T.MapType, T.VariantType)) for c in ranked):
        newest = F.max_by(F.struct(*rest), F.struct(*order))  # maps have no order
    else:
        newest = F.max(F.struct(*ranked))
    return (changes.filter(F.col(KIND) != BEFORE)
            .groupBy(*keys).agg(newest.alias("_v"))
            .select(*keys, *[F.col(f"_v.{c}") for c in rest]))


def live_rows(versions: DataFrame) -> DataFrame:
    """Drop the deleted keys."""
    return versions.filter(F.col(KIND).isin(INSERT, AFTER))


def current_state(changes: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """The table as of the last change: newest version per key, deletes removed."""
    return live_rows(newest_versions(changes, keys, order))


def merge_versions(base: DataFrame, log: DataFrame, keys: Sequence[str],
                   order: Sequence[str] = DEFAULT_ORDER, buckets: int | None = None,
                   bucket_by: Sequence[str] | None = None) -> DataFrame:
    """Newest version per key of a base (one row per key) and a log, deletes kept.

    Only the log is aggregated. The base joins on the key; one that is bucketed
    by the key into ``buckets`` is read in place, with no exchange above its
    scan, because the reduced log is brought to its layout. An equal version
    keeps the base row, so a redelivered log changes nothing.
    """
    rest = [c for c in base.columns if c not in keys]
    fresh = newest_versions(log, keys, order).select(
        *keys, F.struct(*[F.col(c) for c in rest]).alias("_new"))
    if buckets is not None:
        fresh = fresh.repartition(buckets, *(bucket_by or keys))
    stored = base.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in rest])
    newer = F.struct(*[F.col(f"_new.{c}") for c in order]) > F.struct(
        *[F.col(f"_old_{c}") for c in order])
    take = F.col(f"_old_{KIND}").isNull() | newer
    # Column by column, so that a scan of the base reads what the caller uses.
    return (stored.join(fresh, list(keys), "full_outer").withColumn("_take", take)
            .select(*keys, *[F.when(F.col("_take"), F.col(f"_new.{c}"))
                             .otherwise(F.col(f"_old_{c}")).alias(c) for c in rest]))


def merge_on_read(base: DataFrame, log: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Current rows of a base and the log entries newer than it."""
    return live_rows(merge_versions(base, log, keys, order))
