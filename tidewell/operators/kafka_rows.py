"""Records in the shape of Kafka rows: topic, key, value, partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.keys import portable_bucket
from tidewell.operators.envelope import flat_record


def topic_name(db: Column, table: Column, lowercase: bool = False) -> Column:
    """``t_<db>_<table>``."""
    name = F.concat(F.lit("t_"), db, F.lit("_"), table)
    return F.concat(F.lit("t_"), F.lower(db), F.lit("_"), F.lower(table)) if lowercase else name


def record_key(key: Column, fields: Sequence[str]) -> Column:
    """Text of the first key column; empty for a table without a key."""
    if not fields:
        return F.lit("")
    return F.coalesce(key.getField(fields[0]).cast("string"), F.lit(""))


def key_partition(key: Column, partitions: Column | int, portable: bool = False) -> Column:
    """Partition of a key; never negative."""
    count = F.lit(partitions) if isinstance(partitions, int) else partitions
    return portable_bucket(key, count).cast("int") if portable else F.pmod(F.hash(key), count)


def kafka_rows(frame: DataFrame, key_fields: Sequence[str], partitions: int,
               tag_db: str = "db", tag_table: str = "table", lowercase: bool = False,
               produced_ms: Column | None = None, portable: bool = False,
               carried: Sequence[str] = ()) -> DataFrame:
    """Envelope records with ``db`` and ``table`` as Kafka rows, UTF-8 bytes in
    ``key`` and ``value``. Write them with ``writeStream.format("kafka")``.
    ``carried`` columns are kept beside them."""
    key = record_key(F.col("key"), key_fields)
    return frame.select(
        topic_name(F.col(tag_db), F.col(tag_table), lowercase).alias("topic"),
        key.cast("binary").alias("key"),
        flat_record(produced_ms).cast("binary").alias("value"),
        key_partition(key, partitions, portable).alias("partition"),
        *carried,
    )


SEPARATOR = "###"


def keyed_text(value: Column) -> Column:
    """``key###json`` of a flat record; the key part is empty when absent."""
    key = F.get_json_object(value, "$.key")
    return F.concat(F.coalesce(key, F.lit("")), F.lit(SEPARATOR), value)


def digit_key(text: Column) -> tuple[Column, Column]:
    """Key and record of ``key###json``: the key's first run of digits, or the
    whole key without one. Text of another shape gives two empty parts."""
    # A trailing empty part does not count, so drop separators at the end first.
    parts = F.split(F.regexp_replace(text, f"(?:{SEPARATOR})+$", ""), SEPARATOR)
    whole = F.size(parts) == 2
    key = F.get(parts, F.lit(0))
    digits = F.regexp_extract(key, r"\d+", 0)
    return (F.when(whole & (digits != ""), digits).when(whole, key).otherwise(F.lit("")),
            F.when(whole, F.get(parts, F.lit(1))).otherwise(F.lit("")))


def keep_keys(frame: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is in the one-column frame ``keys``."""
    listed = keys.toDF(column).distinct()
    return frame.join(listed, column, "left_semi")
