"""Keys that fall silent: state in a map per key, timers on event time."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.functions.keys import bucket_of
from tidewell.session import use_rocksdb
from tidewell.streaming.repeated import KEY_GROUPS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def joined(runs: Iterable[tuple[int, int]], gap: int) -> dict[int, int]:
    """Runs ``(first, last)`` of times; those at most ``gap`` apart become one."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return {first: last for first, last in out}


class Silence(StatefulProcessor):
    """Keeps the runs of the records of a group of keys, by key, and one timer at the first end
    of any; emits a run's last time once the watermark shows that nothing followed within the gap."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "key string", "first array<bigint>, last array<bigint>")

    def _due(self, last: int) -> int:
        return (last + self.gap) // 1000 + 1  # the first whole millisecond behind the gap

    def _stored(self) -> dict[str, dict[int, int]]:
        return {key[0]: dict(zip(first, last)) for key, (first, last) in self.runs.iterator()}

    def _keep(self, name: str, runs: dict[int, int]) -> None:
        if runs:
            self.runs.updateValue((name,), (list(runs), list(runs.values())))
        else:
            self.runs.removeKey((name,))

    def _next(self, held: dict[str, dict[int, int]]) -> int | None:
        return min((self._due(last) for runs in held.values() for last in runs.values()), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[str, list[tuple[int, int]]] = {}
        for frame in rows:
            for name, *run in zip(frame["key"].tolist(), frame["first"].tolist(), frame["last"].tolist()):
                new.setdefault(name, []).append(tuple(run))
        held = self._stored()
        before = self._next(held)
        for name, runs in new.items():
            old = held.get(name, {})
            held[name] = joined([*old.items(), *runs], self.gap)
            if held[name] != old:
                self._keep(name, held[name])
        after = self._next(held)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held, found = self._stored(), []
        for name, runs in held.items():
            ended = [(name, first, last) for first, last in runs.items() if self._due(last) <= due]
            if ended:
                found += ended
                held[name] = {first: last for first, last in runs.items() if self._due(last) > due}
                self._keep(name, held[name])
        after = self._next(held)
        if after is not None:
            self.handle.registerTimer(after)
        if found:
            yield pd.DataFrame(found, columns=["key", "first", "last"])

    def close(self) -> None:
        pass


def _runs(frames: Iterable[pd.DataFrame], gap: int) -> Iterator[pd.DataFrame]:
    """The runs of each key within an Arrow batch."""
    for frame in frames:
        frame = frame.sort_values(["key", "at"], kind="stable")
        key, at = frame["key"].to_numpy(), frame["at"].to_numpy("int64")
        if len(at):
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (np.diff(at) > gap)))
            ends = np.append(starts[1:], len(at)) - 1
            yield pd.DataFrame({"key": key[starts], "first": at[starts], "last": at[ends],
                                "until": pd.to_datetime(at[ends], unit="us", utc=True)})


def silent_keys(stream: DataFrame, key: str, time: str, gap_minutes: float, delay: str = "0 seconds",
                groups: int = KEY_GROUPS) -> DataFrame:
    """Streaming: ``key``, and ``since``, its last record before more than ``gap_minutes`` of
    event time without one; ``active_from`` is when the run of records began.

    A silence is reported once, when the watermark (the greatest time seen, less
    ``delay``) has passed its gap, in whatever order the records came. A key holds its
    runs of the last ``gap_minutes`` and ``delay`` and nothing older. Records are
    reduced to runs inside each Arrow batch before the shuffle, so a hot key moves as
    a few numbers. Records without key or time are left out. Calls into Python and timers
    are for groups of keys, by their hash; a checkpoint goes with its number of ``groups``.
    """
    use_rocksdb(stream.sparkSession)
    gap = round(gap_minutes * 60_000_000)
    rows = stream.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("at"))
    runs = (rows.filter("key IS NOT NULL AND at IS NOT NULL")
            .mapInPandas(lambda frames: _runs(frames, gap), "key string, first bigint, last bigint, until timestamp")
            .withWatermark("until", delay))
    found = (runs.withColumn("part", bucket_of([F.col("key")], groups)).groupBy("part")
             .transformWithStateInPandas(Silence(gap), "key string, first bigint, last bigint", "Append", "EventTime"))
    return found.select("key", F.timestamp_micros("first").alias("active_from"), F.timestamp_micros("last").alias("since"))


def silent_keys_batch(frame: DataFrame, key: str, time: str, gap_minutes: float) -> DataFrame:
    """Batch twin, by sessions: all silences that end before the last record of all."""
    rows = frame.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("at")).filter(
        "key IS NOT NULL AND at IS NOT NULL")
    gap = round(gap_minutes * 60_000_000)
    # A session window ends its gap after its last record, that instant excluded; one
    # microsecond more takes in a record exactly a gap later.
    sessions = rows.groupBy("key", F.session_window("at", f"{gap + 1} microseconds")).agg(
        F.min("at").alias("active_from"), F.max("at").alias("since"))
    end = rows.agg(F.unix_millis(F.max("at")).alias("_end"))
    due = F.expr(f"(unix_micros(since) + {gap}) div 1000 + 1")
    return sessions.join(F.broadcast(end)).filter(due <= F.col("_end")).select("key", "active_from", "since")


def without_redelivery(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Streaming: the first record of each key; one that comes again within ``delay`` of
    event time is dropped, and its key is forgotten once the watermark has passed it.
    A later redelivery passes, to be settled by the versions (``newest_versions``)."""
    use_rocksdb(stream.sparkSession)
    if str(stream.schema[time].dataType) != "TimestampType()":
        stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
