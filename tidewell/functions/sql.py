"""The converters for SQL, and user table functions.

``register_converters`` makes each converter a temporary SQL function of the session.
Spark puts such a function's text in place of its call, so it costs what the
expression costs: no Python, no row at a time. The functions follow ``convert``,
``temporal`` and ``keys``; a bad value gives null.

``register_table_function`` is the hook for code of the user's own that turns a row
into several. It is Python, called once per row; a built-in such as ``explode`` is
the better choice wherever one can say it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?Z$"

#: Name, parameters, result type and text; later ones use earlier ones.
FUNCTIONS = (
    ("to_boolean", "v STRING", "BOOLEAN", "CASE WHEN v IS NOT NULL THEN lower(trim(v)) IN ('1', 'true') END"),
    ("to_byte", "v STRING", "TINYINT", "try_cast(try_cast(v AS BIGINT) AS TINYINT)"),
    ("to_short", "v STRING", "SMALLINT", "try_cast(try_cast(v AS BIGINT) AS SMALLINT)"),
    ("to_int", "v STRING", "INT", "try_cast(try_cast(v AS BIGINT) AS INT)"),
    ("to_long", "v STRING", "BIGINT", "try_cast(v AS BIGINT)"),
    ("narrow_to_int", "v BIGINT", "INT", "CAST(shiftright(shiftleft(v, 32), 32) AS INT)"),
    ("to_float", "v STRING", "FLOAT", "try_cast(v AS FLOAT)"),
    ("to_double", "v STRING", "DOUBLE", "try_cast(v AS DOUBLE)"),
    ("to_date", "epoch_day INT", "DATE", "date_from_unix_date(epoch_day)"),
    ("floor_div", "v BIGINT, step BIGINT", "BIGINT", "(v - pmod(v, step)) div step"),
    ("time_millis", "v BIGINT, unit STRING", "INT",
     "CAST(CASE unit WHEN 'millis' THEN v WHEN 'micros' THEN {p}floor_div(v, 1000)"
     " WHEN 'nanos' THEN {p}floor_div(v, 1000000) END AS INT)"),
    ("to_timestamp", "v BIGINT, unit STRING", "TIMESTAMP_NTZ",
     f"CASE unit WHEN 'millis' THEN timestampadd(MILLISECOND, v, {EPOCH})"
     f" WHEN 'micros' THEN timestampadd(MICROSECOND, v, {EPOCH})"
     f" WHEN 'nanos' THEN timestampadd(MICROSECOND, {{p}}floor_div(v, 1000), {EPOCH}) END"),
    ("epoch_millis_local", "v BIGINT, zone STRING", "TIMESTAMP_NTZ",
     "convert_timezone('UTC', zone, {p}to_timestamp(v, 'millis'))"),
    ("local_timestamp", "v STRING, zone STRING", "TIMESTAMP_NTZ",
     f"convert_timezone('UTC', zone, CASE WHEN v RLIKE '{INSTANT}'"
     " THEN try_cast(replace(rtrim('Z', v), 'T', ' ') AS TIMESTAMP_NTZ) END)"),
    ("to_binary", "v STRING", "BINARY", "unbase64(v)"),
    ("integer_of_bytes", "v BINARY", "DECIMAL(20,0)",
     "CASE WHEN octet_length(v) <= 8 THEN CAST(conv(lpad(hex(v), 16, CASE WHEN left(hex(v), 1) >= '8' THEN 'F' ELSE '0' END),"
     " 16, -10) AS DECIMAL(20,0)) END"),
    ("date_plain", "v TIMESTAMP_NTZ", "STRING", "CAST(CAST(v AS DATE) AS STRING)"),
    ("duration_plain", "v BIGINT", "STRING",
     "concat(CASE WHEN v < 0 THEN '-' ELSE '' END,"
     " CASE WHEN abs(v) div 3600000000 < 100 THEN lpad(CAST(abs(v) div 3600000000 AS STRING), 2, '0')"
     " ELSE CAST(abs(v) div 3600000000 AS STRING) END, ':',"
     " lpad(CAST(abs(v) div 60000000 % 60 AS STRING), 2, '0'), ':',"
     " lpad(CAST(abs(v) div 1000000 % 60 AS STRING), 2, '0'),"
     " rtrim('.', rtrim('0', concat('.', lpad(CAST(abs(v) % 1000000 AS STRING), 6, '0')))))"),
    ("datetime_plain", "v TIMESTAMP_NTZ", "STRING", "CAST(v AS STRING)"),
    ("timestamp_plain", "v TIMESTAMP_NTZ, snapshot BOOLEAN, zone STRING", "STRING",
     "CAST(CASE WHEN snapshot THEN convert_timezone(zone, 'UTC', v) ELSE convert_timezone('UTC', zone, v) END AS STRING)"),
    ("date_zulu", "v TIMESTAMP_NTZ", "STRING", "concat({p}date_plain(v), 'Z')"),
    ("duration_zulu", "v BIGINT", "STRING", "concat({p}duration_plain(v), 'Z')"),
    ("datetime_zulu", "v TIMESTAMP_NTZ, zone STRING", "STRING",
     "concat(replace(CAST(convert_timezone(zone, 'UTC', v) AS STRING), ' ', 'T'), 'Z')"),
    ("portable_bucket", "v STRING, buckets INT", "BIGINT",
     "pmod(CAST(conv(left(md5(v), 8), 16, 10) AS BIGINT), buckets)"),
)


def register_converters(spark: SparkSession, prefix: str = "cdc_") -> list[str]:
    """Make the converters temporary functions of the session; returns their names."""
    for name, parameters, result, text in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) "
                  f"RETURNS {result} RETURN {text.replace('{p}', prefix)}")
    return [prefix + f[0] for f in FUNCTIONS]


def register_table_function(spark: SparkSession, name: str, handler: type, returns: str) -> None:
    """A user's table function for SQL: ``handler`` is a class whose ``eval`` takes the
    arguments and yields tuples of the ``returns`` columns; called as
    ``FROM t, LATERAL name(t.column)``."""
    spark.udtf.register(name, F.udtf(handler, returnType=returns))
