"""Hashes, buckets and partitions of record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(keys: Sequence[Column]) -> Column:
    """Hash of the key columns; pass every column for a table without a key."""
    return F.xxhash64(*keys)


def bucket_of(keys: Sequence[Column], buckets: int) -> Column:
    """The bucket number Spark's own bucketed tables use for these keys."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def portable_bucket(key_text: Column, buckets: int | Column) -> Column:
    """A bucket any SQL engine can recompute: first 32 bits of MD5, modulo ``buckets``."""
    bits = F.conv(F.substring(F.md5(key_text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(buckets) if isinstance(buckets, int) else buckets)


def key_text(keys: Sequence[Column]) -> Column:
    """The keys as one text, parts joined by ``|``; null parts are empty."""
    return F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
