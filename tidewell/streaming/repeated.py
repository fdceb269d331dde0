"""Keys that occur more than once."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewell.functions.keys import bucket_of
from tidewell.session import use_rocksdb

# The few Python functions below travel to the executors by value, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# State written in Python is kept per group of keys, not per key: the cost of a call
# into Python and of an access to the state is mostly that of the call.
KEY_GROUPS = 1 << 14


def _key_column(frame: DataFrame, key: str) -> DataFrame:
    return frame.select(F.col(key).cast("string").alias("key")).filter(F.col("key").isNotNull())


def repeated_keys(frame: DataFrame, key: str) -> DataFrame:
    """Batch: each key with two or more rows, once, as ``key``."""
    return (_key_column(frame, key).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("key"))


def _triggered(writer, interval: str | None):
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def start_key_counts(stream: DataFrame, key: str, root: str, interval: str | None = "60 seconds") -> StreamingQuery:
    """Streaming: a count per key, kept as state under ``root/checkpoint-count``; each batch
    writes the keys it found to have reached two to ``root/touched``. A hot key costs one
    row per task and trigger."""
    use_rocksdb(stream.sparkSession)
    counts = (_key_column(stream, key).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("key"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/touched/batch_id={batch_id}")

    return _triggered(counts.writeStream.outputMode("update").foreachBatch(keep)
                      .option("checkpointLocation", f"{root}/checkpoint-count"), interval).start()


def start_repeated_keys(stream: DataFrame, key: str, root: str,
                        interval: str | None = "60 seconds") -> tuple[StreamingQuery, ...]:
    """Streaming: the same keys, each appended once to ``root/keys``.

    Two queries of built-in operators, no Python on the rows. The first keeps a
    count per key and hands on the keys that reached two (``start_key_counts``). The
    second drops the keys handed on before. With ``interval=None`` both take what is
    there and stop.
    """
    touched = f"{root}/touched"
    # The folder must exist before the second query lists it.
    empty = stream.sparkSession.createDataFrame([], "key string")
    empty.write.mode("append").parquet(f"{touched}/batch_id=-1")
    first = start_key_counts(stream, key, root, interval)
    if interval is None:
        first.awaitTermination()
    again = (stream.sparkSession.readStream.schema("key string, batch_id bigint").parquet(touched)
             .select("key").dropDuplicates(["key"]))
    second = _triggered(again.writeStream.format("parquet").option("path", f"{root}/keys")
                        .option("checkpointLocation", f"{root}/checkpoint-keys"), interval).start()
    if interval is None:
        second.awaitTermination()
    return first, second


def _shorten(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """At most one row per key and Arrow batch: the key and its count."""
    for frame in frames:
        counts = frame["key"].value_counts(sort=False)
        yield pd.DataFrame({"key": counts.index.astype(object), "n": counts.to_numpy("int64")})


class SecondSighting(StatefulProcessor):
    """Emits a key once, when it has been seen a second time. The state is one value per
    group of keys: keys seen once, and keys reported, each with the time (in milliseconds
    since the epoch) until which it is remembered; 0 where nothing is forgotten."""

    def __init__(self, ttl_millis: int | None = None):
        self.ttl_millis = ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "once map<string,bigint>, reported map<string,bigint>", self.ttl_millis)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for frame in rows:
            for name, n in zip(frame["key"].tolist(), frame["n"].tolist()):
                counts[name] += n
        once, reported = self.seen.get() or ({}, {})
        until = 0
        if self.ttl_millis:
            now = timerValues.getCurrentProcessingTimeInMs()
            until = now + self.ttl_millis
            once, reported = ({k: t for k, t in held.items() if t > now} for held in (once, reported))
        new = [(name, n) for name, n in counts.items() if name not in reported]
        if not new:
            return
        found = [name for name, n in new if n + (name in once) > 1]
        once.update((name, until) for name, n in new)
        for name in found:
            del once[name]
        reported.update((name, until) for name in found)
        self.seen.update((once, reported))
        if found:
            yield pd.DataFrame({"key": found})

    def close(self) -> None:
        pass


def repeated_keys_stateful(stream: DataFrame, key: str, ttl_millis: int | None = None,
                           groups: int = KEY_GROUPS) -> DataFrame:
    """Streaming: the same keys in one query with state of its own, for jobs that
    need ``ttl_millis``, after which an unseen key is forgotten, or the lowest
    latency; ``start_repeated_keys`` needs no Python on the rows.

    Each call into Python and each access to the state is for a whole group of keys, by
    their hash; a trigger reads and writes the groups whose keys it meets. A checkpoint
    goes with its number of ``groups``: choose about a thousandth of the keys expected.

    Equal keys are counted inside each Arrow batch before the shuffle, so a hot
    key reaches its task as a few counts, not as all its rows.
    """
    use_rocksdb(stream.sparkSession)
    counts = _key_column(stream, key).mapInPandas(_shorten, "key string, n bigint")
    parts = counts.withColumn("part", bucket_of([F.col("key")], groups))
    return parts.groupBy("part").transformWithStateInPandas(
        SecondSighting(ttl_millis), "key string", "Append",
        "ProcessingTime" if ttl_millis else "None")
