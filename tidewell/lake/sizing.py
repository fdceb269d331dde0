"""Bucket counts from data size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def planned_bytes(frame: DataFrame) -> int:
    """The optimizer's size estimate of a frame; for file scans, the file sizes."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def buckets_for(frame: DataFrame, bucket_bytes: int = 256 << 20, fewest: int = 8,
                most: int = 100_000) -> int:
    """Enough buckets that one holds about ``bucket_bytes`` of ``frame``; one task
    merges one bucket. Up to ``most`` buckets (25 TB by default): beyond that buckets
    grow, so raise ``bucket_bytes`` or ``most`` knowingly. A table keeps the number it
    was made with; ``evolve`` to a spec with more as it grows."""
    return max(fewest, min(most, math.ceil(planned_bytes(frame) / bucket_bytes)))
