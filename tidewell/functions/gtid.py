"""Transaction-id sets: ``uuid:1-20:30-40,uuid:1-7``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_set(text: str) -> list[tuple[str, int, int]]:
    """A set given by the user as ``(uuid, low, high)`` rows."""
    rows = []
    for member in filter(None, (m.strip() for m in text.split(","))):
        uuid, *intervals = member.split(":")
        if not uuid or not intervals:
            raise ValueError(f"not a transaction-id set: {text!r}")
        for interval in intervals:
            low, _, high = interval.partition("-")
            rows.append((uuid, int(low), int(high or low)))
    if not rows:
        raise ValueError("empty transaction-id set")
    return rows


def member_uuid(member: Column) -> Column:
    return F.get(F.split(member, ":", 2), F.lit(0))


def member_intervals(member: Column) -> Column:
    """Everything behind the uuid; all intervals are kept."""
    return F.get(F.split(member, ":", 2), F.lit(1))


def highest(intervals: Column) -> Column:
    """Largest transaction number of ``1-20:30-40``."""
    return F.array_max(F.split(intervals, "[:-]").cast("array<bigint>"))


def id_uuid(gtid: Column) -> Column:
    """Server uuid of one transaction id ``uuid:n``."""
    return F.get(F.split(gtid, ":"), F.lit(0))


def id_number(gtid: Column) -> Column:
    return F.get(F.split(gtid, ":"), F.lit(1)).cast("bigint")
