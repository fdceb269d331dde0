"""A keyed lake table: bucketed Parquet base, Parquet delta and change log.

``root/log/writer=W/batch_id=N`` holds the changes of a writer's batch N,
``root/base/v=K`` and ``root/delta/v=K`` newest versions of keys. What counts is
named by ``root/versions/K.json``, of which the greatest K holds: the table's spec
(columns, key, order, buckets, partitions), which base and delta are in force, and
the last batch of each writer they hold. Each file is created whole, under a
number nobody else can take, so readers, writers and compaction may run side by
side. A table opened with a spec that differs from the stored one is refused.

The base is bucketed and sorted by the key: reading and compacting move the log
and the delta through a shuffle, never the base. Deleted keys stay as ``-D`` rows:
a redelivered older change can then never bring a row back.

A partitioned table keeps a key once per partition it was ever in. The old image
of an update is stored as a delete in its own partition, which the new image
overrides unless the row has moved; so each partition merges by itself, in any
order of arrival, and a read of one partition reads no other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.keys import bucket_of
from tidewell.lake.files import create_text, finished_batches, is_finished, move, numbered_files, read_text, remove
from tidewell.operators.changelog import BEFORE, DELETE
from tidewell.operators.commits import archive_candidates, clean_candidates, compaction_due
from tidewell.operators.merge import live_rows, merge_versions, newest_versions
from tidewell.session import JOB_SETTINGS
from tidewell.spec import KIND, TableSpec, conform, diff, stored_schema

WRITER = "main"
Batch = tuple[str, int]


@dataclass(frozen=True)
class Version:
    """State of a table: its spec, its base and delta (by number), and the last batch
    of each writer that they hold."""

    number: int
    spec: TableSpec
    base: int | None = None
    delta: int | None = None
    folded: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"spec": self.spec.to_json(), "base": self.base, "delta": self.delta,
                           "folded": dict(self.folded)})

    @classmethod
    def from_json(cls, number: int, text: str) -> Version:
        raw = json.loads(text)
        return cls(number, TableSpec.from_json(raw["spec"]), raw["base"], raw["delta"], raw["folded"])


class LakeTable:
    """``spec`` may be left out for a table that exists."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec | None = None,
                 database: str = "default"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.aligned = False  # whether the session shuffles into the base's buckets
        stored = self._newest()
        if spec is None and stored is None:
            raise ValueError(f"no table at {self.root}; give its spec")
        self.spec = spec or stored.spec
        self._agree(stored)

    @cached_property
    def schema(self) -> T.StructType:
        return stored_schema(self.spec)

    def log_path(self, batch_id: int, writer: str = WRITER) -> str:
        return f"{self.root}/log/writer={writer}/batch_id={batch_id}"

    def base_path(self, number: int) -> str:
        return f"{self.root}/base/v={number}"

    def delta_path(self, number: int) -> str:
        return f"{self.root}/delta/v={number}"

    # -- identity ----------------------------------------------------------

    def _newest(self) -> Version | None:
        files = numbered_files(self.spark, f"{self.root}/versions")
        if not files:
            return None
        number = max(files)
        return Version.from_json(number, read_text(self.spark, files[number]))

    def _agree(self, stored: Version | None) -> Version | None:
        if stored is not None and (changed := diff(stored.spec, self.spec)):
            raise ValueError(f"{self.root} is stored under another spec ({changed}); open it without one, "
                             "or evolve it")
        return stored

    def version(self) -> Version | None:
        """The newest state; fails if the table was evolved behind this object."""
        return self._agree(self._newest())

    def _commit(self, version: Version) -> Version:
        path = f"{self.root}/versions/{version.number:08d}.json"
        if not create_text(self.spark, path, version.to_json()):
            raise RuntimeError(f"version {version.number} of {self.root} was taken by another job")
        return version

    def _known(self) -> Version:
        """The newest state, made if there is none yet."""
        stored = self.version()
        if stored is None:
            path = f"{self.root}/versions/{0:08d}.json"
            create_text(self.spark, path, Version(0, self.spec).to_json())
            stored = self.version()  # ours, or that of a writer who came first
        return stored

    # -- writing -----------------------------------------------------------

    def append(self, changes: DataFrame, batch_id: int, rebalance: bool = True,
               writer: str = WRITER) -> None:
        """Write one batch of changelog rows. The folder is named by the writer and
        the batch and overwritten, so a batch that runs twice is stored once. Each
        writer numbers its own batches, upwards; one number names one batch for
        good. A batch that a base or delta holds already is not written again, and
        one that comes after later ones were folded is refused: no read would see it.

        The key, the ordering and the kind must be there; other missing columns are
        null. ``rebalance`` lets AQE pick the number of files: few for a small
        batch, more where one part is large. Turn it off for a bulk load, whose
        tasks write large files anyway; the batch is then written without a shuffle.
        """
        have = set(changes.columns)
        needed = [*self.spec.merge_key, *self.spec.order, KIND]
        if lacking := [c for c in needed if c not in have]:
            raise ValueError(f"changes for {self.spec.name} lack {', '.join(lacking)}")
        if batch_id <= self._known().folded.get(writer, -1):
            if not is_finished(self.spark, self.log_path(batch_id, writer)):
                raise ValueError(f"batch {batch_id} of writer {writer} comes after later ones were folded; "
                                 "give another writer")
            return
        columns = [F.col(f.name).cast(f.dataType) if f.name in have
                   else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        if self.spec.partitioned_by:
            kind = F.when(F.col(KIND) == BEFORE, F.lit(DELETE)).otherwise(F.col(KIND))
            rows = changes.withColumn(KIND, kind).select(*columns)
        else:
            rows = changes.filter(F.col(KIND) != BEFORE).select(*columns)
        if rebalance:
            rows = rows.hint("rebalance")
        rows.write.mode("overwrite").parquet(self.log_path(batch_id, writer))

    def compact(self, full: bool = False, purge_below: int | None = None) -> Version | None:
        """Fold the pending batches and return the new state, None if nothing changed.

        They go into the delta, at the cost of the log and the delta; the base's
        files are left as they are. ``full`` (and the first time) writes a new base.
        ``purge_below`` then drops deleted keys whose ordering value is smaller, for
        callers who know that no older change can still arrive.
        """
        now = self.version()
        pending = self._pending(now)
        if now is None or not pending and (not full or now.delta is None and purge_below is None):
            return None
        folded = _with(now.folded, pending)
        if full or now.base is None:
            return self._write_base(self._aligned()._versions(now, pending), self.spec, now, folded, purge_below)
        number = now.number + 1
        rows = newest_versions(self._fresh(now, pending), self.spec.merge_key, self.spec.order)
        rows.write.mode("overwrite").parquet(self.delta_path(number))
        return self._commit(Version(number, self.spec, now.base, number, folded))

    def _aligned(self) -> LakeTable:
        """This table in a session of its own, with the settings of this one, that
        shuffles into as many partitions as there are buckets. Aggregating the log
        then leaves it in the base's layout: one shuffle of the log, none of the
        base, and each task writes its own bucket."""
        session = _twin_session(self.spark)
        session.conf.set("spark.sql.shuffle.partitions", self.spec.buckets)
        session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        twin = LakeTable(session, self.root, self.spec, self.database)
        twin.aligned = True
        return twin

    def evolve(self, spec: TableSpec) -> LakeTable:
        """The table under a changed spec. Added columns read as null from old files;
        a retyped or dropped column, or another number of buckets, rewrites the base.
        The key, the order and the partitions cannot change.

        Rows whose value does not survive a cast fail the job; move them aside with
        ``conform`` first.
        """
        now = self._known()
        changed = diff(self.spec, spec)
        if changed.fixed:
            raise ValueError(f"{', '.join(changed.fixed)} of {self.root} cannot change; write a new table")
        pending = self._pending(now)
        if changed.retyped or changed.dropped or changed.rebucketed:
            if now.base is not None or pending:
                rows = conform(self._aligned()._versions(now, pending), spec)
                kept = F.when(F.size("_rejects") == 0, F.col(KIND)).otherwise(F.raise_error(
                    F.concat(F.lit("value lost in retyped column "), F.array_join("_rejects", ","))))
                rows = rows.withColumn(KIND, kept).drop("_rejects")
                if changed.rebucketed:
                    rows = rows.repartition(spec.buckets, *spec.key)
                self._write_base(rows, spec, now, _with(now.folded, pending), None)
            else:
                self._commit(Version(now.number + 1, spec, None, None, now.folded))
        elif changed:
            self._commit(Version(now.number + 1, spec, now.base, now.delta, now.folded))
        return LakeTable(self.spark, self.root, spec, self.database)

    def _write_base(self, rows: DataFrame, spec: TableSpec, now: Version, folded: Mapping[str, int],
                    purge_below: int | None) -> Version:
        if purge_below is not None:
            rows = rows.filter((F.col(KIND) != DELETE) | (F.col(spec.order[0]) >= purge_below))
        number = now.number + 1
        name = self.base_table(number)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = (rows.select(*stored_schema(spec).names).write.format("parquet").mode("overwrite")
                  .bucketBy(spec.buckets, *spec.key).sortBy(*spec.key).option("path", self.base_path(number)))
        if spec.partitioned_by:
            writer = writer.partitionBy(*spec.partitioned_by)
        writer.saveAsTable(name)
        return self._commit(Version(number, spec, number, None, folded))

    # -- reading -----------------------------------------------------------

    def base_table(self, number: int) -> str:
        """Catalog name of one base; the catalog is what carries the bucketing."""
        return f"{self.database}.tidewell_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_v{number}"

    def pending(self) -> list[Batch]:
        """Committed batches that no base or delta holds. Folded ones cost no more than
        their line in the listing."""
        return self._pending(self.version())

    def _pending(self, now: Version | None) -> list[Batch]:
        """The batches pending behind one state. A read takes both from one look, or a
        compaction in between would hide what it folded."""
        folded = now.folded if now else {}
        return sorted((w, b) for w, b, _ in finished_batches(self.spark, f"{self.root}/log", folded)
                      if b > folded.get(w, -1))

    def base(self, number: int) -> DataFrame:
        """One base, with its bucketing known to the planner. It is declared when it is
        written, and once more in a catalog that does not know it."""
        name = self.base_table(number)
        if not self.spark.catalog.tableExists(name):
            self._declare(name, number)
        frame = self.spark.table(name)
        for column in self.schema.fields:  # columns added since it was written
            if column.name not in frame.columns:
                frame = frame.withColumn(column.name, F.lit(None).cast(column.dataType))
        return frame.select(*self.schema.names)

    def _declare(self, name: str, number: int) -> None:
        stored = self.spark.read.parquet(self.base_path(number)).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema if f.name in stored.names)
        key = ", ".join(f"`{k}`" for k in self.spec.key)
        parts = ", ".join(f"`{c}`" for c in self.spec.partitioned_by)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            + (f"PARTITIONED BY ({parts}) " if parts else "")
            + f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.spec.buckets} BUCKETS "
            f"LOCATION '{self.base_path(number)}'")
        if parts:
            self.spark.catalog.recoverPartitions(name)

    def log(self, batches: list[Batch] | None = None) -> DataFrame:
        """Rows of the given batches, by default the pending ones. Files of an older
        shape read by name; missing columns are null."""
        wanted = self.pending() if batches is None else batches
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.log_path(b, w) for w, b in wanted])

    def _fresh(self, now: Version | None, pending: list[Batch]) -> DataFrame:
        """Everything that is newer than the base: the delta and the pending log."""
        paths = [self.log_path(b, w) for w, b in pending]
        if now is not None and now.delta is not None:
            paths.append(self.delta_path(now.delta))
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _versions(self, now: Version | None, pending: list[Batch], columns: list[str] | None = None,
                  where: Mapping[str, object] | None = None) -> DataFrame:
        key, order = list(self.spec.merge_key), list(self.spec.order)
        names = [f.name for f in self.schema]
        if columns is not None:
            wanted = {*key, *order, KIND, *columns}
            names = [n for n in names if n in wanted]

        def part(frame: DataFrame) -> DataFrame:
            for name, value in (where or {}).items():
                frame = frame.filter(F.col(name).eqNullSafe(F.lit(value)) if value is None else F.col(name) == value)
            return frame.select(*names)

        fresh = part(self._fresh(now, pending))
        if now is None or now.base is None:
            return newest_versions(fresh, key, order)
        base = part(self.base(now.base))
        if not pending and now.delta is None:
            return base
        buckets = None if self.aligned and not self.spec.partitioned_by else self.spec.buckets
        return merge_versions(base, fresh, key, order, buckets, self.spec.key)

    def read(self, columns: list[str] | None = None, where: Mapping[str, object] | None = None) -> DataFrame:
        """Current rows: base merged with the delta and the log behind it. Name the
        ``columns`` to read only those, with the key and the ordering. ``where`` gives
        values of partition columns; other partitions are not read."""
        if where and (odd := [c for c in where if c not in self.spec.partitioned_by]):
            raise ValueError(f"not partition columns: {', '.join(odd)}")
        now = self.version()
        return live_rows(self._versions(now, self._pending(now), columns, where))

    def lookup(self, **key) -> DataFrame:
        """The current row of one key. Only the files of its bucket are read from
        the base, and within them the row groups whose range holds the key."""
        schema = {f.name: f.dataType for f in self.schema}
        literals = {k: F.lit(key[k]).cast(schema[k]) for k in self.spec.key}
        match = F.lit(True)
        for name, value in literals.items():
            match = match & (F.col(name) == value)
        now = self.version()
        fresh = self._fresh(now, self._pending(now)).filter(match)
        if now is None or now.base is None:
            return live_rows(newest_versions(fresh, self.spec.merge_key, self.spec.order))
        bucket = bucket_of(list(literals.values()), self.spec.buckets)
        number = self.spark.range(1).select(bucket).first()[0]
        base = (self.spark.read.schema(self.schema)
                .option("pathGlobFilter", f"*_{number:05d}.c*")
                .parquet(self.base_path(now.base)).filter(match))
        return live_rows(newest_versions(base.unionByName(fresh), self.spec.merge_key, self.spec.order))

    def publish(self, name: str) -> None:
        """Make the table readable by SQL, for all sessions of the application.

        ``<name>_ro`` is a view of the newest base alone: no merge, as fresh as the
        last full compaction. ``<name>_rt`` is a view of the merged rows, here and as
        ``global_temp.<name>_rt``. Call again after a compaction or a changed spec.
        """
        now = self.version()
        if now is not None and now.base is not None:
            self.base(now.base)
            stored = self.spark.table(self.base_table(now.base)).columns
            columns = ", ".join(
                f"`{f.name}`" if f.name in stored else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in self.spec.schema)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name}_ro AS SELECT {columns} "
                           f"FROM {self.base_table(now.base)} WHERE {KIND} <> '{DELETE}'")
        rows = self.read().select(*self.spec.columns)
        rows.createOrReplaceTempView(f"{name}_rt")
        rows.createOrReplaceGlobalTempView(f"{name}_rt")

    # -- maintenance -------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per committed batch, numbered by time: table, commit, ts, compacted,
        writer, batch_id."""
        now = self.version()
        folded = now.folded if now else {}
        found = sorted((millis, w, b) for w, b, millis in finished_batches(self.spark, f"{self.root}/log", folded))
        rows = [(self.spec.name, number, millis, b <= folded.get(w, -1), w, b)
                for number, (millis, w, b) in enumerate(found)]
        frame = self.spark.createDataFrame(
            rows, "table string, commit bigint, ms bigint, compacted boolean, writer string, batch_id bigint")
        return frame.withColumn("ts", F.timestamp_millis("ms")).drop("ms")

    def due(self, max_commits: int = 5, max_seconds: int = 1800) -> bool:
        state = compaction_due(self.commits(), F.current_timestamp(),
                               max_commits=max_commits, max_seconds=max_seconds)
        return not state.filter("due").isEmpty()

    def clean(self, keep: int = 10080, keep_versions: int = 2) -> list[str]:
        """Delete folded batches beyond the ``keep`` newest, and the bases and deltas
        that only older than the ``keep_versions`` newest states name; returns the
        removed paths. The list is as long as the folder listing it comes from."""
        old = clean_candidates(self.commits(), keep).select("writer", "batch_id").collect()
        paths = [self.log_path(r.batch_id, r.writer) for r in old]
        files = numbered_files(self.spark, f"{self.root}/versions")
        states = {n: Version.from_json(n, read_text(self.spark, p)) for n, p in files.items()}
        old_states = [states[n] for n in sorted(states)[:-keep_versions]]
        kept = [states[n] for n in sorted(states)[-keep_versions:]]
        for number in sorted({s.base for s in old_states} - {s.base for s in kept} - {None}):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.base_table(number)}")
            paths.append(self.base_path(number))
        for number in sorted({s.delta for s in old_states} - {s.delta for s in kept} - {None}):
            paths.append(self.delta_path(number))
        for path in [*paths, *[files[n] for n in sorted(files)[:-keep_versions]]]:
            remove(self.spark, path)
        return paths

    def archive(self, keep: int = 10080) -> list[str]:
        """Move folded batches of a long list (see ``archive_candidates``) from ``log``
        to ``archive``, where no listing of the table meets them; returns their paths."""
        old = archive_candidates(self.commits(), keep).filter("compacted").select("writer", "batch_id").collect()
        moved = []
        for row in old:
            path = self.log_path(row.batch_id, row.writer)
            if move(self.spark, path, path.replace(f"{self.root}/log/", f"{self.root}/archive/")):
                moved.append(path)
        return moved


def _with(folded: Mapping[str, int], pending: list[Batch]) -> dict[str, int]:
    found = dict(folded)
    for writer, batch in pending:
        found[writer] = max(batch, found.get(writer, -1))
    return found


def _twin_session(spark: SparkSession) -> SparkSession:
    """A new session with the settings made in this one, and the job's own."""
    session = spark.newSession()
    for row in spark.sql("SET").collect():
        if row.key.startswith("spark.sql.") and spark.conf.isModifiable(row.key):
            session.conf.set(row.key, row.value)
    for name in ("spark.sql.legacy.bucketedTableScan.outputOrdering", "spark.sql.requireAllClusterKeysForCoPartition"):
        session.conf.set(name, JOB_SETTINGS[name])
    return session


def writer_of(checkpoint: str) -> str:
    """A writer's name for a stream: one per checkpoint, since a new checkpoint counts
    its batches from zero again."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
