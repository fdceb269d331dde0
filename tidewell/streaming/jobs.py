"""Streaming jobs: change stream to lake tables, fan-out, resume."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions.convert import Converter
from tidewell.lake.files import newest_child, remove
from tidewell.lake.catalog import CatalogTable
from tidewell.lake.table import LakeTable, writer_of
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import REJECT
from tidewell.operators.routing import TAG
from tidewell.operators.typed import RAW, typed_records
from tidewell.session import scratch_dir

INTERVAL = "60 seconds"


def checkpoint_for(root: str, app: str) -> str:
    """One stable checkpoint folder per application: starting the same
    application again goes on where it stopped."""
    return f"{root.rstrip('/')}/{app}"


def last_progress(spark: SparkSession, root: str, app: str) -> str | None:
    """Newest commit file of an application's checkpoint, None before its first."""
    return newest_child(spark, f"{checkpoint_for(root, app)}/commits", "[0-9]*")


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Key and value rows of a stateful query's newest state."""
    return (spark.read.format("statestore").option("path", checkpoint)
            .option("operatorId", operator).load())


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
           name: str | None, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def start_upsert(changes: DataFrame, table: LakeTable | CatalogTable, checkpoint: str, name: str | None = None,
                 interval: str | None = INTERVAL) -> StreamingQuery:
    """Changelog rows into a lake table. ``interval=None`` takes what is there and
    stops. A batch replayed after a failure overwrites its own folder, so the
    table holds every change once. Each checkpoint is a writer of its own: a second
    stream, or a new checkpoint that counts from zero, adds to the table."""
    writer = writer_of(checkpoint)
    return _start(changes, lambda batch, number: table.append(batch, number, writer=writer),
                  checkpoint, name, interval)


@dataclass(frozen=True)
class Target:
    """A lake table and the projection from routed records to its changelog rows. Rows
    with a ``_reject`` reason are not for the table; ``expand`` turns the others
    into changelog rows where the projection leaves that to do."""

    table: LakeTable
    project: Callable[[DataFrame], DataFrame] = lambda rows: rows
    expand: Callable[[DataFrame], DataFrame] = lambda rows: rows


def typed_target(table: LakeTable, text: str = "value", zone: str = "UTC",
                 ordering: Mapping[str, Column] | None = None,
                 converters: Mapping[str, Converter] | None = None,
                 shard: Column | int | str | None = None) -> Target:
    """Target for flat JSON records: each table reads them with its own schema,
    by name. ``ordering`` gives the spec's ordering columns that the records
    carry beside the text, such as the Kafka offset. ``shard`` fills the shard and
    write-time columns of a spec made with ``with_shard``, the shard with the
    suffix of each record's own database. Records that cannot be converted without
    loss come out as rejects."""

    def project(records: DataFrame) -> DataFrame:
        carried = records.withColumns(dict(ordering)) if ordering else records
        return typed_records(carried.drop(TAG), table.spec, text, zone, converters, shard)

    def expand(typed: DataFrame) -> DataFrame:
        return expand_changelog(typed.drop(RAW), strict=True)

    return Target(table, project, expand)


UNROUTED = "_unrouted"
PLACE = "_place"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _unsorted_write(spark: SparkSession, files: int = 32) -> Iterator[None]:
    """A partitioned write inside keeps a task's files open side by side, instead of
    sorting all its rows by partition to write one after the other. Only a task with
    rows of more than ``files`` partitions sorts, and then what is left."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, max(files, int(before)))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def fan_out(targets: Mapping[str, Target], workers: int = 4, tag: str = TAG, rejects: str | None = None,
            writer: str = "main", staging: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each record to its tag's table.

    One job reads the batch and writes it to ``staging``, partitioned by tag, however
    many tables there are; it counts the records of each tag as they pass. No task sorts
    its records, however many a tag has (``_unsorted_write``). A table
    then reads its own folder alone, a few tables at a time, and tables without a
    record in the batch are not touched. A record is converted once: the typed rows
    are kept while rejects and changes are written from them. Records of other tags,
    and those a target rejects, go with their reason to
    ``rejects/target=<tag>/writer=W/batch_id=N`` as JSON of the whole record; without
    a folder for them, a batch that has any fails. Accepted and rejected records
    add up to the input.
    """
    names = list(targets)

    def keep(bad: DataFrame, name: str, batch_id: int) -> None:
        if rejects is None:
            raise ValueError(f"{name}: records were rejected and there is no folder for them")
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns if c != REJECT]))
        (bad.select(F.col(REJECT).alias("reason"), whole.alias("record"))
         .write.mode("overwrite").parquet(f"{rejects}/target={name}/writer={writer}/batch_id={batch_id}"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{staging or scratch_dir(spark, 'fanout')}/batch_id={batch_id}"
        place = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), F.col(tag)), F.lit(0)).cast("int")
        seen = Observation()
        counts = [F.count_if(place == i).alias(f"n{i}") for i in range(len(names) + 1)]
        placed = batch.observe(seen, *counts).withColumn(PLACE, place).hint("rebalance", PLACE)
        with _unsorted_write(spark):
            placed.write.mode("overwrite").partitionBy(PLACE).parquet(folder)

        def routed(i: int) -> DataFrame:
            return spark.read.schema(batch.schema).parquet(f"{folder}/{PLACE}={i}")

        def one(i: int) -> None:
            target = targets[names[i - 1]]
            rows = target.project(routed(i))
            if REJECT not in rows.columns:
                target.table.append(target.expand(rows), batch_id, writer=writer)
                return
            typed = rows.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                bad = typed.filter(F.col(REJECT).isNotNull())
                if not bad.isEmpty():
                    keep(bad, names[i - 1], batch_id)
                good = typed.filter(F.col(REJECT).isNull()).drop(REJECT)
                target.table.append(target.expand(good), batch_id, writer=writer)
            finally:
                typed.unpersist()

        try:
            present = [i for i in range(len(names) + 1) if seen.get[f"n{i}"]]
            if 0 in present:
                keep(routed(0).withColumn(REJECT, F.lit("unknown table")), UNROUTED, batch_id)
            run = inheritable_thread_target(spark)(one)
            with ThreadPoolExecutor(workers) as pool:
                for job in [pool.submit(run, i) for i in present if i]:
                    job.result()
        finally:
            remove(spark, folder)

    return write


def start_fan_out(records: DataFrame, targets: Mapping[str, Target], checkpoint: str,
                  name: str | None = None, interval: str | None = INTERVAL,
                  workers: int = 4, rejects: str | None = None) -> StreamingQuery:
    """Route a stream of records to their tables; ``rejects`` is by default a folder
    in the checkpoint."""
    each = fan_out(targets, workers, rejects=rejects or f"{checkpoint.rstrip('/')}/rejects",
                   writer=writer_of(checkpoint), staging=f"{checkpoint.rstrip('/')}/staging")
    return _start(records, each, checkpoint, name, interval)


def start_kafka(rows: DataFrame, brokers: str, checkpoint: str, name: str | None = None,
                interval: str = INTERVAL) -> StreamingQuery:
    """Kafka rows to the brokers, at least once. Needs the Kafka connector package."""
    writer = (rows.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
              .option("checkpointLocation", checkpoint).trigger(processingTime=interval))
    return (writer.queryName(name) if name else writer).start()


def start_console(stream: DataFrame, checkpoint: str, rows: int = 20,
                  interval: str | None = None) -> StreamingQuery:
    """Print the rows of a stream."""
    writer = (stream.writeStream.format("console").option("numRows", rows)
              .option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
