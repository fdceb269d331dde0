"""Start options of a capture job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import gtid
from tidewell.operators.offsets import after_gtid_set, at_or_after


@dataclass(frozen=True)
class Initial:
    """Snapshot first, then changes."""


@dataclass(frozen=True)
class AtPosition:
    file: str
    pos: int


@dataclass(frozen=True)
class AfterGtid:
    gtid_set: str


StartOption = Initial | AtPosition | AfterGtid


def parse_start(text: str | None) -> StartOption:
    """``pos/<file>:<offset>``, ``gtid/<set>``, or nothing for a snapshot start."""
    if not text:
        return Initial()
    kind, slash, value = text.partition("/")
    value = value.strip()
    if kind == "pos" and slash:
        file, _, pos = value.rpartition(":")
        if file and pos.isdigit():
            return AtPosition(file, int(pos))
    elif kind == "gtid" and slash:
        gtid.parse_set(value)
        return AfterGtid(value)
    raise ValueError(f"unsupported start option {text!r}")


def start_from(feed: DataFrame, option: StartOption) -> DataFrame:
    """The part of an envelope feed that the option asks for. Snapshot records
    belong to a snapshot start only."""
    if isinstance(option, Initial):
        return feed
    changes = feed.filter(F.col("op") != "r")
    if isinstance(option, AtPosition):
        return at_or_after(changes, option.file, option.pos)
    return after_gtid_set(changes, option.gtid_set)


def wall_clock_millis(text: str, utc_offset_hours: int = 8) -> int:
    """``2023-08-19_22:00:00`` in a zone of fixed offset to epoch milliseconds."""
    zone = timezone(timedelta(hours=utc_offset_hours))
    at = datetime.strptime(text, "%Y-%m-%d_%H:%M:%S").replace(tzinfo=zone)
    return int(at.timestamp() * 1000)
