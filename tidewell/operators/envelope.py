"""Change envelopes: topic parts, accepted records and rejects, flat JSON, row shapes.

The envelope has ``topic, key, before, after, op, ts_ms, source``; see the
README. All functions are narrow: no shuffle, and the same on streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.convert import Converter, json_value
from tidewell.functions.temporal import write_time
from tidewell.spec import SHARD_COLUMN, WRITE_TIME_COLUMN, TableSpec

OPS = ("c", "r", "u", "d")
REJECT = "_reject"


def topic_parts(topic: Column) -> Column:
    return F.split(topic, r"\.")


def topic_db(topic: Column) -> Column:
    return F.get(topic_parts(topic), F.lit(1))


def topic_table(topic: Column) -> Column:
    return F.get(topic_parts(topic), F.lit(2))


def with_topic_parts(frame: DataFrame, topic: str = "topic") -> DataFrame:
    """Add ``db`` and ``table`` of a ``server.db.table`` topic."""
    return frame.withColumns({"db": topic_db(F.col(topic)), "table": topic_table(F.col(topic))})


def with_reject_reason(frame: DataFrame, topic: str = "topic", op: str = "op",
                       payload: Sequence[str] = ()) -> DataFrame:
    """Add ``_reject``: null for records to keep, else why the record is dropped.

    A record is a tombstone when its op and all ``payload`` columns are null.
    """
    size = F.size(topic_parts(F.col(topic)))
    code = F.col(op)
    empty = code.isNull()
    for name in payload:
        empty = empty & F.col(name).isNull()
    reason = F.when(size == 1, F.lit("topic has one part")).when(
        F.col(topic).isNull() | (size != 3), F.lit("topic has not three parts"))
    if payload:
        reason = reason.when(empty, F.lit("tombstone"))
    return frame.withColumn(REJECT, reason.when(code.isNull(), F.lit("no op")).when(
        ~code.isin(*OPS), F.lit("unknown op")))


def accepted(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col(REJECT).isNotNull())


def keep_changes(frame: DataFrame, topic: str = "topic", op: str = "op") -> DataFrame:
    """Only records with a three-part topic and a known op."""
    return accepted(with_reject_reason(frame, topic, op))


def parse_envelope(frame: DataFrame, row: T.StructType, key: T.StructType,
                   text: str = "value") -> DataFrame:
    """Envelope JSON text to columns, by name, for feeds whose values already have the
    columns' JSON types. Connector encodings (epoch days, bytes and so on), rejects
    and the raw text are the business of ``typed.typed_envelopes``."""
    schema = T.StructType([
        T.StructField("topic", T.StringType()),
        T.StructField("key", key),
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([
            T.StructField("file", T.StringType()),
            T.StructField("pos", T.LongType()),
            T.StructField("gtid", T.StringType()),
            T.StructField("lsn", T.LongType()),
        ])),
    ])
    return frame.select(F.from_json(F.col(text), schema).alias("_e")).select("_e.*")


def flat_record(produced_ms: Column | None = None) -> Column:
    """The flat JSON record of an envelope with ``db`` and ``table``.

    Absent parts are left out; both times are epoch milliseconds as text.
    """
    if produced_ms is None:
        produced_ms = F.unix_millis(F.current_timestamp())
    return F.to_json(F.struct(
        "db", "table", "key", "before", "after", "op",
        F.col("ts_ms").cast("string").alias("cdc_ts"),
        produced_ms.cast("string").alias("prd_ts"),
    ))


def parse_flat_records(frame: DataFrame, text: str = "value") -> DataFrame:
    """Flat JSON text to its envelope columns. The key and the images are maps of
    text, until the table, and with it the schema, is known."""
    pairs = T.MapType(T.StringType(), T.StringType())
    text_type = T.StringType()
    schema = T.StructType([
        T.StructField(name, pairs if name in ("key", "before", "after") else text_type)
        for name in ("db", "table", "key", "before", "after", "op", "cdc_ts", "prd_ts")])
    carried = [c for c in frame.columns if c != text]
    return frame.select(*carried, F.from_json(F.col(text), schema).alias("_e")).select(
        *carried, "_e.*")


def row_by_name(values: Column, spec: TableSpec, zone: str = "UTC",
                converters: Mapping[str, Converter] | None = None) -> Column:
    """Typed row of a map or struct of text values; columns missing from a map
    are null. Pass a plain column: it is read once per field."""
    fields = [json_value(values[f.name], f.dataType, zone, converters, f.name,
                         spec.source_types.get(f.name, "")).alias(f.name)
              for f in spec.schema]
    return F.when(values.isNotNull(), F.struct(*fields))


def row_by_position(values: Column, spec: TableSpec, zone: str = "UTC") -> Column:
    """Typed row of a list of text values in source order: extra values are cut,
    missing trailing ones are null. A column dropped in the middle of the source
    table shifts the rest, so this is for sources known to be stable."""
    fields = [
        json_value(F.get(values, F.lit(i)), f.dataType, zone).alias(f.name)
        for i, f in enumerate(spec.schema)
    ]
    return F.when(values.isNotNull(), F.struct(*fields))


def shard_id(shard: Column | int | str, db: Column) -> Column:
    """Shard number followed by the database's numeric suffix, e.g. ``0_03``."""
    number = shard if isinstance(shard, Column) else F.lit(str(shard))
    return F.concat(number.cast("string"), F.regexp_extract(db, r"_\d+$", 0))


def with_shard_columns(frame: DataFrame, shard: Column | int | str, db: str = "db",
                       at: Column | None = None) -> DataFrame:
    """Add the write-time and shard columns the lake tables start with."""
    return frame.withColumns({
        WRITE_TIME_COLUMN: write_time(at),
        SHARD_COLUMN: shard_id(shard, F.col(db)),
    })
