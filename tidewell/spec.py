"""Table specs: columns, key, ordering and bucket count of one logical table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.types import mysql_type

SHARD_COLUMN = "_shard"
WRITE_TIME_COLUMN = "_write_time"
KIND, SUB = "_kind", "_sub"


@dataclass(frozen=True)
class TableSpec:
    """One captured table. ``order`` says which of two versions is newer.

    Name the most selective key column first: merges sort on the key in that
    order, and early differences make comparisons cheap.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    order: tuple[str, ...] = ("seq", SUB)
    buckets: int = 8
    source_types: dict[str, str] = field(default_factory=dict)
    partitioned_by: tuple[str, ...] = ()

    @property
    def merge_key(self) -> tuple[str, ...]:
        """What tells two rows of the stored table apart."""
        return self.key + tuple(c for c in self.partitioned_by if c not in self.key)

    def to_json(self) -> str:
        return json.dumps({
            "name": self.name, "schema": self.schema.jsonValue(), "key": self.key, "order": self.order,
            "buckets": self.buckets, "source_types": self.source_types, "partitioned_by": self.partitioned_by})

    @classmethod
    def from_json(cls, text: str) -> TableSpec:
        raw = json.loads(text)
        return cls(name=raw["name"], schema=T.StructType.fromJson(raw["schema"]), key=tuple(raw["key"]),
                   order=tuple(raw["order"]), buckets=raw["buckets"], source_types=raw["source_types"],
                   partitioned_by=tuple(raw["partitioned_by"]))

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def with_shard(self) -> TableSpec:
        """Add the write-time and shard columns in front; the shard joins the key."""
        extra = [T.StructField(WRITE_TIME_COLUMN, T.StringType()),
                 T.StructField(SHARD_COLUMN, T.StringType())]
        return replace(self, schema=T.StructType(extra + list(self.schema.fields)),
                       key=self.key + (SHARD_COLUMN,))


@dataclass(frozen=True)
class SpecDiff:
    added: tuple[str, ...]
    dropped: tuple[str, ...]
    retyped: tuple[str, ...]
    rebucketed: bool = False
    fixed: tuple[str, ...] = ()  # changes that no stored table can take: key, order, partitions

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped or self.retyped or self.rebucketed or self.fixed)


def diff(old: TableSpec, new: TableSpec) -> SpecDiff:
    """Changes from ``old`` to ``new``, columns by name."""
    before, after = ({f.name: f.dataType for f in s.schema} for s in (old, new))
    return SpecDiff(
        added=tuple(c for c in after if c not in before),
        dropped=tuple(c for c in before if c not in after),
        retyped=tuple(c for c in after if c in before and before[c] != after[c]),
        rebucketed=old.buckets != new.buckets,
        fixed=tuple(n for n in ("key", "order", "partitioned_by") if getattr(old, n) != getattr(new, n)),
    )


def spec_from_describe(name: str, described: DataFrame, legacy: bool = False, **more) -> TableSpec:
    """Spec from ``DESCRIBE`` output with columns Field, Type and Key.

    The frame has one row per column of one table, so it is read on the driver.
    """
    rows = described.select("Field", "Type", "Key").collect()
    fields = [T.StructField(r.Field, mysql_type(r.Type, legacy)) for r in rows]
    return TableSpec(
        name=name,
        schema=T.StructType(fields),
        key=tuple(r.Field for r in rows if r.Key == "PRI"),
        source_types={r.Field: r.Type for r in rows},
        **more,
    )


def spec_from_jdbc(spark: SparkSession, name: str, url: str, table: str, key_query: str,
                   properties: dict[str, str] | None = None, **more) -> TableSpec:
    """Spec of a live table: its JDBC schema plus a query giving the key columns in order."""
    options = {**(properties or {}), "url": url}
    schema = spark.read.format("jdbc").options(**options, dbtable=table).load().schema
    keys = spark.read.format("jdbc").options(**options, query=key_query).load()
    return TableSpec(name=name, schema=schema,
                     key=tuple(r[0] for r in keys.collect()), **more)


def stored_schema(spec: TableSpec) -> T.StructType:
    """Schema of stored rows: the table's columns, then the ordering and kind columns."""
    fields = list(spec.schema.fields)
    have = set(spec.schema.names)
    for name in spec.order:
        if name not in have:
            fields.append(T.StructField(name, T.IntegerType() if name == SUB else T.LongType()))
    return T.StructType(fields + [T.StructField(KIND, T.StringType())])


def conform(frame: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of an older or newer shape in the spec's shape.

    Missing columns are null, columns the spec lacks are cut, and a column of
    another type is cast. ``_rejects`` lists the columns whose value did not
    survive its cast, so that a caller can keep those rows aside.
    """
    have = {f.name: f.dataType for f in frame.schema}
    picked, broken = [], []
    for target in spec.schema:
        if target.name not in have:
            picked.append(F.lit(None).cast(target.dataType).alias(target.name))
        elif have[target.name] == target.dataType:
            picked.append(F.col(target.name))
        else:
            value = F.col(target.name).try_cast(target.dataType)
            picked.append(value.alias(target.name))
            broken.append(F.when(F.col(target.name).isNotNull() & value.isNull(),
                                 F.lit(target.name)))
    rest = [c for c in frame.columns if c.startswith("_") or c in spec.order]
    rest = [F.col(c) for c in rest if c not in spec.columns]
    rejects = F.filter(F.array(*broken), lambda c: c.isNotNull()) if broken \
        else F.array().cast("array<string>")
    return frame.select(*picked, *rest, rejects.alias("_rejects"))
