"""Counts of what a run accepts, rejects and cannot route, taken while it writes."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewell.operators.envelope import REJECT
from tidewell.operators.routing import TAG

REASONS = ("topic has one part", "topic has not three parts", "tombstone", "no op", "unknown op")
RECORDS, ACCEPTED, OTHER, UNROUTED = "records", "accepted", "other reason", "unrouted"


def outcome(tags: Sequence[str] | None = None, tag: str = TAG, reason: str = REJECT) -> Column:
    """``accepted``, ``unrouted`` or the reason of a reject."""
    routed = F.col(tag).isin(list(tags)) if tags is not None else F.lit(True)
    return F.when(F.col(reason).isNotNull(), F.col(reason)).when(
        F.coalesce(routed, F.lit(False)), F.lit(ACCEPTED)).otherwise(F.lit(UNROUTED))


def counts(of: Column, reasons: Sequence[str] = REASONS) -> list[Column]:
    """One count per outcome, and all records; they add up."""
    known = [ACCEPTED, UNROUTED, *reasons]
    return [F.count(F.lit(1)).alias(RECORDS), *[F.count_if(of == k).alias(k) for k in known],
            F.count_if(~of.isin(known)).alias(OTHER)]


def observed(records: DataFrame, name: str | Observation, tags: Sequence[str] | None = None,
             tag: str = TAG, reason: str = REJECT, reasons: Sequence[str] = REASONS) -> DataFrame:
    """The records, counted as they pass. Batch: give an ``Observation`` and read its
    ``get`` after the write. Stream: give a name and read it from the progress, or
    let ``Counts`` add it up."""
    return records.observe(name, *counts(outcome(tags, tag, reason), reasons))


class Counts(StreamingQueryListener):
    """Adds up the observed counts of all batches, by query run and name."""

    def __init__(self) -> None:
        self.totals: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.batches: Counter = Counter()
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.runId)
        for name, row in progress.observedMetrics.items():
            self.totals[run, name].update({k: v or 0 for k, v in row.asDict().items()})
        self.batches[run] += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, name: str, seconds: float = 60) -> dict[str, int]:
        """Counts of an ended run; the listener hears of its end after all batches."""
        run = str(query.runId)
        if not query.isActive and not self._ended[run].wait(seconds):
            raise TimeoutError("the listener was not told of the query's end")
        return dict(self.totals[run, name])


TARGET = "_target"


def start_routed(records: DataFrame, path: str, checkpoint: str, tags: Sequence[str], name: str = "routed",
                 interval: str | None = "60 seconds", tag: str = TAG, reason: str = REJECT) -> StreamingQuery:
    """Every record once, to ``path/_target=<tag>``; rejects and records of other tags to
    folders named by their outcome. One pass over the source writes and counts."""
    of = outcome(tags, tag, reason)
    placed = observed(records, name, tags, tag, reason).withColumn(
        TARGET, F.when(of == ACCEPTED, F.col(tag)).otherwise(F.concat(F.lit("_"), of)))
    writer = placed.writeStream.format("parquet").partitionBy(TARGET).option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()
