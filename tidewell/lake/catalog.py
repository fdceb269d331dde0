"""Keyed tables held by the catalog alone: a base, a change log, and a view that merges them.

* ``<name>_log``: Parquet, partitioned by ``writer``, ``batch_id`` and ``_bucket``; a batch that
  runs twice overwrites its own partitions.
* ``<name>_base_vN``: Parquet, partitioned by ``_bucket``, one row per key, deletes included.
* ``<name>``: a persisted view, the newest version of each key of base and log. It is the
  only thing that says which base counts: a compaction writes the next base and then
  replaces the view, in one step of the catalog. So any session, and any engine that
  reads the catalog, sees either the old files or the new ones, and the same rows.
* ``<name>_ro``: the base alone, as fresh as the last compaction, without a merge.

A batch that base and log both hold does no harm, since a version wins once. The view
leaves out folded batches by their partitions, and ``clean`` drops them. A filter on
``_bucket`` and on the key reaches both scans: ``lookup`` reads one bucket of each.
The merge is one aggregation of base and log by key; tables whose base should stay in
place while it is merged are ``LakeTable``'s.

One compaction runs at a time per table; writers may go on meanwhile.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.keys import bucket_of
from tidewell.operators.changelog import AFTER, BEFORE, DELETE, INSERT
from tidewell.spec import KIND, TableSpec, stored_schema

BUCKET = "_bucket"
WRITER = "main"
_STATE = "tidewell.state"


def _names(columns: Sequence[str], of: str = "") -> str:
    return ", ".join(f"{of}`{c}`" for c in columns)


class CatalogTable:
    """``name`` is the view's, with its database where it is not the current one."""

    def __init__(self, spark: SparkSession, name: str, spec: TableSpec, root: str):
        if spec.partitioned_by:
            raise ValueError("the buckets are the partitions of a catalog table")
        self.spark, self.name, self.spec, self.root = spark, name, spec, root.rstrip("/")
        self.columns = stored_schema(spec).names
        if not spark.catalog.tableExists(self.log_name):
            stored = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(spec))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.log_name} ({stored}, writer STRING, batch_id BIGINT, `{BUCKET}` INT) "
                      f"USING parquet PARTITIONED BY (writer, batch_id, `{BUCKET}`) LOCATION '{self.root}/log'")
        if not spark.catalog.tableExists(name):
            self._show(None, {})

    @property
    def log_name(self) -> str:
        return f"{self.name}_log"

    def base_name(self, number: int) -> str:
        return f"{self.name}_base_v{number}"

    # -- the view ----------------------------------------------------------

    def state(self) -> tuple[int | None, dict[str, int]]:
        """Number of the base and the last batch of each writer that it holds, as the view has them."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").filter(F.col("key") == _STATE).collect()
        state = json.loads(rows[0].value)
        return state["base"], state["folded"]

    def _versions_sql(self, base: int | None, folded: Mapping[str, int]) -> str:
        """Newest version per key, deletes kept. The greatest order wins, ties by the values."""
        key, order = list(self.spec.key), list(self.spec.order)
        rest = [*order, *[c for c in self.columns if c not in {*key, *order}]]
        columns = _names([*key, *rest, BUCKET])
        held = " OR ".join(f"(writer = '{w}' AND batch_id <= {b})" for w, b in sorted(folded.items())) or "false"
        parts = [f"SELECT {columns} FROM {self.log_name} WHERE NOT ({held})"]
        if base is not None:
            parts.append(f"SELECT {columns} FROM {self.base_name(base)}")
        return (f"SELECT {_names([*key, BUCKET])}, {_names(rest, '_v.')} FROM (SELECT {_names([*key, BUCKET])}, "
                f"max(struct({_names(rest)})) AS _v FROM ({' UNION ALL '.join(parts)}) GROUP BY {_names([*key, BUCKET])})")

    def _show(self, base: int | None, folded: Mapping[str, int]) -> None:
        live = f"`{KIND}` IN ('{INSERT}', '{AFTER}')"
        shown = _names([*self.spec.columns, BUCKET])
        if base is not None:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name}_ro AS SELECT {shown} FROM {self.base_name(base)} WHERE {live}")
        state = json.dumps({"base": base, "folded": dict(folded)})
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_STATE}' = '{state}') AS "
                       f"SELECT {shown} FROM ({self._versions_sql(base, folded)}) WHERE {live}")

    # -- writing -----------------------------------------------------------

    def append(self, changes: DataFrame, batch_id: int, rebalance: bool = True, writer: str = WRITER) -> None:
        """One batch of changelog rows, by its own partitions of the log. A batch that the
        base holds already is not written again."""
        have = set(changes.columns)
        if lacking := [c for c in (*self.spec.key, *self.spec.order, KIND) if c not in have]:
            raise ValueError(f"changes for {self.spec.name} lack {', '.join(lacking)}")
        if batch_id <= self.state()[1].get(writer, -1):
            return
        values = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                  for f in stored_schema(self.spec)]
        rows = changes.filter(F.col(KIND) != BEFORE).select(*values).withColumn(
            BUCKET, bucket_of([F.col(k) for k in self.spec.key], self.spec.buckets))
        if rebalance:
            rows = rows.hint("rebalance", BUCKET)  # few files per bucket, more where one is large
        self._replace(writer, batch_id, rows)

    def _replace(self, writer: str, batch_id: int, rows: DataFrame) -> None:
        """One batch's partitions, files included, by these rows."""
        # A stream's batch belongs to a session of its own.
        rows.sparkSession.sql(f"INSERT OVERWRITE {self.log_name} PARTITION (writer = '{writer}', batch_id = {int(batch_id)}, `{BUCKET}`) "
                              "SELECT * FROM {rows}", rows=rows)

    def batches(self) -> list[tuple[str, int]]:
        """Writer and number of the batches in the log, from the catalog's list of partitions."""
        parts = self.spark.sql(f"SHOW PARTITIONS {self.log_name}").select(
            F.regexp_extract("partition", "writer=([^/]*)", 1).alias("w"),
            F.regexp_extract("partition", r"batch_id=(\d+)", 1).cast("bigint").alias("b")).distinct()
        return sorted((r.w, r.b) for r in parts.collect())

    def compact(self, purge_below: int | None = None) -> int | None:
        """Fold the log into a new base; its number, or None where there is nothing to fold.
        ``purge_below`` drops deleted keys that no older change can reach any more."""
        base, folded = self.state()
        pending = [(w, b) for w, b in self.batches() if b > folded.get(w, -1)]
        if not pending and purge_below is None:
            return None
        after = dict(folded)
        for writer, batch in pending:
            after[writer] = max(batch, after.get(writer, -1))
        rows = self.spark.sql(self._versions_sql(base, folded))
        if purge_below is not None:
            rows = rows.filter((F.col(KIND) != DELETE) | (F.col(self.spec.order[0]) >= purge_below))
        number = (base or 0) + 1
        self.spark.sql(f"DROP TABLE IF EXISTS {self.base_name(number)}")
        (rows.select(*self.columns, BUCKET).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.spec.key)
         .write.format("parquet").mode("overwrite").partitionBy(BUCKET)
         .option("path", f"{self.root}/base/v={number}").saveAsTable(self.base_name(number)))
        self._show(number, after)
        return number

    def _nothing(self) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType([*stored_schema(self.spec), T.StructField(BUCKET, T.IntegerType())]))

    def clean(self) -> list[tuple[str, int]]:
        """Drop the folded batches and the bases before the one in force, with their files,
        once no running read uses them; returns the batches."""
        base, folded = self.state()
        gone = [(w, b) for w, b in self.batches() if b <= folded.get(w, -1)]
        for writer, batch in gone:
            self._replace(writer, batch, self._nothing())
        for number in range(1, base or 0):
            old = self.base_name(number)
            if self.spark.catalog.tableExists(old):
                self.spark.sql(f"INSERT OVERWRITE {old} PARTITION (`{BUCKET}`) SELECT * FROM {{rows}}", rows=self._nothing())
                self.spark.sql(f"DROP TABLE {old}")
        return gone

    # -- reading -----------------------------------------------------------

    def read(self, columns: Sequence[str] | None = None) -> DataFrame:
        return self.spark.table(self.name).select(*(columns or self.spec.columns))

    def lookup(self, **key) -> DataFrame:
        """The current row of one key, from one bucket of base and log."""
        types = {f.name: f.dataType for f in self.spec.schema}
        values = [F.lit(key[k]).cast(types[k]) for k in self.spec.key]
        bucket = self.spark.range(1).select(bucket_of(values, self.spec.buckets)).first()[0]
        match = F.col(BUCKET) == bucket
        for name, value in zip(self.spec.key, values):
            match = match & (F.col(name) == value)
        return self.spark.table(self.name).filter(match).select(*self.spec.columns)

    def drop(self) -> None:
        """Forget the table; its files stay."""
        base, _ = self.state()
        for view in (self.name, f"{self.name}_ro"):
            self.spark.sql(f"DROP VIEW IF EXISTS {view}")
        for number in range(1, (base or 0) + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.base_name(number)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.log_name}")
