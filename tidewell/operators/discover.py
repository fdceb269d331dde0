"""Columns found in the data: images as variants, before a table's spec is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.spec import TableSpec


def as_variant(text: Column) -> Column:
    """JSON text as a variant; malformed text is null."""
    return F.try_parse_json(text)


def variant_column(image: Column, name: str, to: T.DataType) -> Column:
    """A column of an image by its name, null where it is absent or of another type."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"no path can name the column {name!r}")
    return F.try_variant_get(image, f"$[{quote}{name}{quote}]", to.simpleString())


def discovered_columns(frame: DataFrame, image: str) -> DataFrame:
    """``column``, ``type``, ``n`` records that name it and ``n_null`` of them with null.

    The type is the narrowest that all its values have, as ``schema_of_variant_agg``
    finds it. Each record gives a row per column, counted before the shuffle.
    """
    at = frame.select(F.col(image).alias("_v")).filter("_v IS NOT NULL AND NOT is_variant_null(_v)")
    spark = frame.sparkSession
    pairs = at.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
    return pairs.filter("key IS NOT NULL").groupBy(F.col("key").alias("column")).agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("n"),
        F.count_if(F.is_variant_null("value")).alias("n_null"))


_SAME = {"BIGINT": "bigint smallint int tinyint double float decimal boolean date timestamp timestamp_ntz",
         "DOUBLE": "double float decimal", "STRING": "string binary date timestamp timestamp_ntz decimal",
         "BOOLEAN": "boolean", "DECIMAL": "decimal double float"}


def drift_in_data(found: DataFrame, spec: TableSpec) -> DataFrame:
    """``column`` and ``drift``: ``added`` in the data, ``dropped`` from it, or ``retyped``,
    where the values found do not convert to the column's type. A row per column."""
    known = frame_of(found, spec)
    word = F.regexp_extract("type", r"^[A-Z]+", 0)
    fits = F.lit(False)
    for name, kinds in _SAME.items():
        fits = fits | ((word == name) & F.col("of").isin(kinds.split()))
    drift = F.when(F.col("of").isNull(), F.lit("added")).when(F.col("type").isNull(), F.lit("dropped")).when(
        ~(fits | (word == "VOID")), F.lit("retyped"))
    return found.join(known, "column", "full_outer").select("column", drift.alias("drift"), "type").filter("drift IS NOT NULL")


def frame_of(found: DataFrame, spec: TableSpec) -> DataFrame:
    rows = [(f.name, f.dataType.typeName()) for f in spec.schema]
    names = {"long": "bigint", "short": "smallint", "integer": "int", "byte": "tinyint"}
    return found.sparkSession.createDataFrame([(c, names.get(k, k)) for c, k in rows], "column string, of string")
