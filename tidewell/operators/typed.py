"""Change records as text to typed rows, with the reason where that fails.

Both record shapes, the connector's envelope and the flat JSON record, are read
with their images as text, one for each column of the table. Every column is then converted by the type it
had at the source. A record that cannot be converted without loss is not made
null: ``_reject`` says why, and the raw text stays beside it for repair.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import convert as C
from tidewell.functions.temporal import temporal_rule, write_time
from tidewell.operators.changelog import expand_changelog
from tidewell.operators.envelope import OPS, REJECT, shard_id, topic_db, topic_parts, topic_table
from tidewell.spec import SHARD_COLUMN, WRITE_TIME_COLUMN, TableSpec

Rule = Callable[[Column, T.StructField], Column]
RAW = "_raw"


def source_word(source_type: str) -> str:
    return source_type.strip().lower().split("(")[0].split(" ")[0]


def time_unit(source_type: str) -> str:
    """How an envelope counts a DATETIME: milliseconds up to three decimals, else microseconds."""
    digits = source_type.partition("(")[2].partition(")")[0].strip()
    return "micros" if digits.isdigit() and int(digits) > 3 else "millis"


def decimal_value(text: Column, to: T.DecimalType, encoding: str) -> Column:
    """A decimal as text, as base64 of its unscaled bytes, or as ``{scale, value}``;
    null beyond what 38 digits hold."""
    if encoding == "struct":
        parts = F.from_json(text, "scale int, value string")
        return C.to_decimal(parts, to.precision, to.scale, "struct")
    return C.to_decimal(text, to.precision, to.scale, encoding)


def envelope_value(text: Column, field: T.StructField, source_type: str = "", zone: str = "UTC",
                   decimals: str = "bytes") -> Column:
    """One value of an envelope's image: dates are epoch days, DATETIME counts from
    1970 by its precision, TIMESTAMP is an instant's text shown in ``zone``, TIME
    counts microseconds, booleans are 0 and 1, decimals as ``decimals`` says."""
    to, word = field.dataType, source_word(source_type)
    if isinstance(to, T.BooleanType):
        return C.to_boolean(text)
    if isinstance(to, T.DateType):
        return F.when(C.is_date_text(text), C.text_to_date(text)).otherwise(
            F.date_from_unix_date(text.try_cast("int")))
    if isinstance(to, (T.TimestampNTZType, T.TimestampType)):
        count = C.to_timestamp(text.try_cast("bigint"), time_unit(source_type))
        return F.when(C.is_date_text(text), C.text_to_timestamp(text, zone)).otherwise(count).cast(to)
    if isinstance(to, T.IntegerType) and word == "time":
        return F.when(text.contains(":"), C.to_time_millis(text, "text")).otherwise(
            C.to_time_millis(text.try_cast("bigint"), "micros"))
    if isinstance(to, T.DecimalType):
        return decimal_value(text, to, decimals)
    narrow = {"tinyint": C.to_byte, "smallint": C.to_short, "int": C.to_int}.get(to.simpleString())
    return narrow(text) if narrow else C.json_value(text, to, zone)


def profile_text(text: Column, source_type: str, profile: str, zone: str, snapshot: Column) -> Column | None:
    """A temporal value of an envelope as the profile's text; None for other types."""
    rule, word = temporal_rule(source_type, profile, zone), source_word(source_type)
    if rule is None:
        return None
    if word == "date":
        value = F.date_from_unix_date(text.try_cast("int"))
    elif word == "time":
        value = text.try_cast("bigint")
    elif word == "timestamp":
        value = C.text_to_timestamp(text, "UTC")
    else:
        value = C.to_timestamp(text.try_cast("bigint"), time_unit(source_type))
    return rule(value, snapshot)


def typed_image(values: Column, spec: TableSpec, rule: Rule, extra: Mapping[str, Column]) -> Column:
    """Typed row of an image's texts; ``extra`` gives columns that do not come from the source."""
    fields = [extra[f.name] if f.name in extra else rule(values[f.name], f) for f in spec.schema]
    return F.when(values.isNotNull(), F.struct(*[v.alias(f.name) for v, f in zip(fields, spec.schema)]))


def lost_values(values: Column, row: Column, spec: TableSpec, extra: Mapping[str, Column]) -> Column:
    """Names of the columns that had a text and have no value in the row."""
    lost = [F.when(values[n].isNotNull() & row[n].isNull(), F.lit(n)) for n in spec.columns if n not in extra]
    none = F.array().cast("array<string>")
    return F.when(values.isNotNull(), F.array_compact(F.array(*lost)) if lost else none).otherwise(none)


def shard_columns(spec: TableSpec, shard: Column | int | str, db: Column, at: Column | None = None) -> dict[str, Column]:
    """The write-time and shard columns, where the spec has them."""
    made = {WRITE_TIME_COLUMN: write_time(at), SHARD_COLUMN: shard_id(shard, db)}
    return {name: value for name, value in made.items() if name in spec.columns}


def _judged(frame: DataFrame, spec: TableSpec, rule: Rule, extra: Mapping[str, Column],
            reasons: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Images typed, and ``_reject``: the first of the reasons that holds.

    The conversions stand in a projection of their own, which is compiled piece by
    piece where it is too large for one method. A filter on the reason would be
    rewritten in their terms and do them all once more; ``_at`` keeps it above them,
    since Spark moves nothing through a projection that depends on the partition.
    """
    carried = [c for c in frame.columns if c not in ("before", "after")]
    typed = frame.select(*carried, F.col("before").alias("_b"), F.col("after").alias("_a"), F.spark_partition_id().alias("_at"),
                         *[typed_image(F.col(c), spec, rule, extra).alias(c) for c in ("before", "after")])
    op, old, new = F.col("op"), F.col("before"), F.col("after")
    needed = (op.isin("c", "r", "u") & new.isNull()) | (op.isin("u", "d") & old.isNull())
    bad = F.array_distinct(F.concat(lost_values(F.col("_b"), old, spec, extra), lost_values(F.col("_a"), new, spec, extra)))
    null_key = F.lit(False)
    for name in spec.key:
        null_key = null_key | (old.isNotNull() & old[name].isNull()) | (new.isNotNull() & new[name].isNull())
    reason = F.when(F.col("_at") < 0, F.lit(""))  # never
    for holds, text in (*reasons, (needed, F.lit("no image")),
                        (F.size(bad) > 0, F.concat(F.lit("lost value: "), F.array_join(bad, ","))),
                        (null_key, F.lit("null key"))):
        reason = reason.when(holds, text)
    return typed.withColumn(REJECT, reason).drop("_b", "_a", "_at")


def _op_reasons(whole: Column) -> list[tuple[Column, Column]]:
    op = F.col("op")
    return [(whole.isNull(), F.lit("malformed text")), (op.isNull(), F.lit("no op")),
            (~op.isin(*OPS), F.lit("unknown op"))]


def _texts(spec: TableSpec) -> T.StructType:
    """An image as read: every column as text, by name."""
    return T.StructType([T.StructField(name, T.StringType()) for name in spec.columns])


def typed_envelopes(frame: DataFrame, spec: TableSpec, text: str = "value", zone: str = "UTC",
                    decimals: str = "bytes", profile: str | None = None,
                    converters: Mapping[str, C.Converter] | None = None,
                    shard: Column | int | str | None = None) -> DataFrame:
    """Envelope text to typed records: the frame's other columns (offset, timestamp),
    ``topic, op, ts_ms, source, before, after, _raw`` and ``_reject``.

    ``profile`` writes temporal columns that are text in the spec; ``converters``
    wins by column or type name. Split with ``accepted`` and ``rejected``.
    """
    schema = T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("before", _texts(spec)), T.StructField("after", _texts(spec)),
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([
            T.StructField("file", T.StringType()), T.StructField("pos", T.LongType()),
            T.StructField("gtid", T.StringType()), T.StructField("lsn", T.LongType())]))])
    carried = [c for c in frame.columns if c != text]
    read = frame.select(*carried, F.col(text).alias(RAW), F.from_json(text, schema).alias("_e")).select(
        *carried, RAW, "_e.*")

    def rule(value: Column, field: T.StructField) -> Column:
        for choice in (field.name, field.dataType.typeName()):
            if converters and choice in converters:
                return converters[choice](value)
        source_type = spec.source_types.get(field.name, "")
        if profile and isinstance(field.dataType, T.StringType):
            written = profile_text(value, source_type, profile, zone, F.col("op") == "r")
            if written is not None:
                return written
        return envelope_value(value, field, source_type, zone, decimals)

    extra = {} if shard is None else shard_columns(spec, shard, topic_db(F.col("topic")))
    parts = F.size(topic_parts(F.col("topic")))
    reasons = [*_op_reasons(F.coalesce(F.col("topic"), F.col("op"))),
               (F.col("topic").isNull() | (parts != 3), F.lit("topic has not three parts"))]
    return _judged(read, spec, rule, extra, reasons)


def typed_records(frame: DataFrame, spec: TableSpec, text: str = "value", zone: str = "UTC",
                  converters: Mapping[str, C.Converter] | None = None,
                  shard: Column | int | str | None = None) -> DataFrame:
    """Flat JSON records of one table to typed records: the frame's other columns,
    ``op, before, after, _raw`` and ``_reject``. The shard comes from the record's
    own database name, so one table may take records of many shards."""
    schema = T.StructType([
        T.StructField("db", T.StringType()), T.StructField("op", T.StringType()),
        T.StructField("before", _texts(spec)), T.StructField("after", _texts(spec))])
    carried = [c for c in frame.columns if c != text]
    read = frame.select(*carried, F.col(text).alias(RAW), F.from_json(text, schema).alias("_e")).select(
        *carried, RAW, F.col("_e.db").alias("_db"), "_e.op", "_e.before", "_e.after")
    narrow = {"tinyint": C.to_byte, "smallint": C.to_short, "int": C.to_int}

    def rule(value: Column, field: T.StructField) -> Column:
        source_type = spec.source_types.get(field.name, "")
        kind = field.dataType.simpleString()
        chosen = converters and (field.name in converters or field.dataType.typeName() in converters)
        if kind in narrow and not chosen and source_word(source_type) != "time":
            return narrow[kind](value)
        return C.json_value(value, field.dataType, zone, converters, field.name, source_type)

    extra = {} if shard is None else shard_columns(spec, shard, F.col("_db"))
    whole = F.coalesce(F.col("op"), F.to_json("before"), F.to_json("after"))
    return _judged(read, spec, rule, extra, _op_reasons(whole)).drop("_db")


def topic_tag(topic: Column) -> Column:
    """``db.table`` of a topic."""
    return F.concat_ws(".", topic_db(topic), topic_table(topic))


def expand_flat_records(frame: DataFrame, spec: TableSpec, text: str = "value", zone: str = "UTC", strict: bool = True,
                        converters: Mapping[str, C.Converter] | None = None) -> DataFrame:
    """Flat JSON records of one table to typed changelog rows, columns by name.

    A record that cannot be converted without loss, or whose key is null, fails the
    job with its reason; with ``strict=False`` it is left out, and ``flat_rejects`` has it.
    """
    judged = typed_records(frame, spec, text, zone, converters)
    if strict:
        failed = F.raise_error(F.concat(F.lit("record rejected: "), F.col(REJECT), F.lit(": "), F.coalesce(RAW, F.lit(""))))
        judged = judged.withColumn("op", F.when(F.col(REJECT).isNull(), F.col("op")).otherwise(failed.cast("string")))
    else:
        judged = judged.filter(F.col(REJECT).isNull())
    return expand_changelog(judged.drop(REJECT, RAW))


def flat_rejects(frame: DataFrame, spec: TableSpec, text: str = "value", zone: str = "UTC",
                 converters: Mapping[str, C.Converter] | None = None) -> DataFrame:
    """The records that ``expand_flat_records`` leaves out: the frame's other columns, ``_raw``, ``_reject``."""
    judged = typed_records(frame, spec, text, zone, converters)
    return judged.filter(F.col(REJECT).isNotNull()).drop("op", "before", "after")
