"""Type mapping, value conversion and temporal text over ``part``, ``events`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import convert, temporal
from tidewell.functions.sql import register_converters
from tidewell.functions.types import mysql_type_column
from tidewell.operators.envelope import row_by_name
from tidewell.plans.registry import query, table
from tidewell.spec import TableSpec

ZONE = "Asia/Shanghai"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "micros", temporal.epoch_micros(F.col("ts"))).withColumn(
        "millis", F.expr("micros div 1000"))


TYPE_TEXT = """
CASE p_partkey % 16
 WHEN 0 THEN concat('decimal(', 12 + p_size % 20, ',', p_size % 9, ')')
 WHEN 1 THEN concat('numeric(', 12 + p_size % 20, ')')
 WHEN 2 THEN concat('bigint(', p_size, ')')
 WHEN 3 THEN concat('varchar(', p_size, ')')
 WHEN 4 THEN concat('datetime(', p_size % 7, ')')
 WHEN 5 THEN 'date'
 WHEN 6 THEN concat('time(', p_size % 7, ')')
 WHEN 7 THEN concat('int(', p_size, ') unsigned')
 WHEN 8 THEN concat('varbinary(', p_size, ')')
 WHEN 9 THEN 'point'
 WHEN 10 THEN 'enum(''update'',''x'')'
 WHEN 11 THEN concat('tinyint(', p_size, ')')
 WHEN 12 THEN concat('mediumint(', p_size, ')')
 WHEN 13 THEN 'bigint unsigned'
 WHEN 14 THEN 'double'
 ELSE 'json' END"""


@query("mysql_type_map", f"""
SELECT p_partkey, {TYPE_TEXT} AS source_type,
CASE p_partkey % 16
 WHEN 0 THEN concat('decimal(', 12 + p_size % 20, ',', p_size % 9, ')')
 WHEN 1 THEN concat('decimal(', 12 + p_size % 20, ',0)') WHEN 2 THEN 'bigint' WHEN 3 THEN 'string'
 WHEN 4 THEN 'timestamp_ntz' WHEN 5 THEN 'date' WHEN 6 THEN 'time' WHEN 7 THEN 'bigint' WHEN 8 THEN 'binary'
 WHEN 9 THEN 'string' WHEN 10 THEN 'string' WHEN 11 THEN 'tinyint' WHEN 12 THEN 'int'
 WHEN 13 THEN 'decimal(20,0)' WHEN 14 THEN 'double' ELSE 'string' END AS type,
CASE p_partkey % 16
 WHEN 0 THEN concat('decimal(', 12 + p_size % 20, ',', p_size % 9, ')')
 WHEN 1 THEN concat('decimal(', 12 + p_size % 20, ',0)') WHEN 2 THEN 'bigint' WHEN 3 THEN 'string'
 WHEN 4 THEN 'timestamp_ntz' WHEN 5 THEN 'date' WHEN 6 THEN 'time' WHEN 7 THEN 'int' WHEN 8 THEN 'string'
 WHEN 9 THEN 'int' WHEN 10 THEN 'date' WHEN 11 THEN 'tinyint' WHEN 12 THEN 'int'
 WHEN 13 THEN 'bigint' WHEN 14 THEN 'double' ELSE 'string' END AS legacy_type
FROM part""")
def mysql_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(TYPE_TEXT).alias("source_type"))
    text = F.col("source_type")
    return named.select("p_partkey", "source_type", mysql_type_column(text).alias("type"),
                        mysql_type_column(text, legacy=True).alias("legacy_type"))


JSON_SPEC = TableSpec(name="web.events", key=("k",), schema=T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("flag", T.BooleanType()),
    T.StructField("price", T.DecimalType(10, 2)), T.StructField("at", T.TimestampNTZType()),
    T.StructField("day", T.DateType()), T.StructField("gone", T.StringType())]))


@query("coerce_json", """
SELECT event_id, CAST(regexp_extract(props, '\\d+', 0) AS INTEGER) AS k, event_id % 2 = 1 AS flag,
       CAST(CAST(event_id * 3 AS DECIMAL(10,2)) AS VARCHAR) AS price,
       CAST(date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS VARCHAR) AS at,
       CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS gone
FROM events""")
def coerce_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(
        F.lit("flag"), (F.col("event_id") % 2).cast("string"),
        F.lit("price"), (F.col("event_id") * 3).cast("string"),
        F.lit("at"), F.col("millis").cast("string"),
        F.lit("day"), F.col("millis").cast("string")))
    rows = events(spark, sf_dir).select("event_id", pairs.alias("pairs")).select(
        "event_id", row_by_name(F.col("pairs"), JSON_SPEC, ZONE).alias("row"))
    return rows.select("event_id", "row.k", "row.flag", F.col("row.price").cast("string").alias("price"),
                       F.col("row.at").cast("string").alias("at"),
                       F.col("row.day").cast("string").alias("day"), "row.gone")


@query("epoch_ms_local", """
SELECT event_id, CAST(date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS VARCHAR) AS local_time,
       CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS local_date FROM events""")
def epoch_ms_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.col("millis")
    return events(spark, sf_dir).select(
        "event_id", convert.epoch_millis_local(millis, ZONE).cast("string").alias("local_time"),
        convert.epoch_millis_local_date(millis, ZONE).cast("string").alias("local_date"))


@query("conv_boolean", """
SELECT event_id, event_id % 7 IN (0, 1, 2) AS from_text, event_id % 3 = 1 AS from_number,
       CASE WHEN event_id % 5 > 0 THEN value > 20 END AS from_boolean FROM events""")
def conv_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in ("1", "true", "TRUE", "0", "false", "yes", "2")])
    return table(spark, sf_dir, "events").select(
        "event_id",
        convert.to_boolean(F.get(words, (F.col("event_id") % 7).cast("int"))).alias("from_text"),
        convert.to_boolean((F.col("event_id") % 3).cast("tinyint")).alias("from_number"),
        convert.to_boolean(F.when(F.col("event_id") % 5 > 0, F.col("value") > 20)).alias("from_boolean"))


@query("conv_small_ints", """
WITH e AS (SELECT event_id, event_id * 3 - 300 AS n, event_id * 100000300007 AS big FROM events)
SELECT event_id, TRY_CAST(n AS TINYINT) AS as_byte, TRY_CAST(n * 10 AS SMALLINT) AS as_short,
       TRY_CAST(big AS INTEGER) AS as_int, big AS as_long,
       CAST((big + 2147483648) % 4294967296 - 2147483648 AS INTEGER) AS narrowed FROM e""")
def conv_small_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = (F.col("event_id") * 3 - 300)
    big = (F.col("event_id") * 100000300007).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", convert.to_byte(small.cast("string")).alias("as_byte"),
        convert.to_short((small * 10).cast("string")).alias("as_short"),
        convert.to_int(big).alias("as_int"), convert.to_long(big).alias("as_long"),
        convert.narrow_to_int(convert.to_long(big)).alias("narrowed"))


@query("conv_floats", """
SELECT event_id, value AS as_double, CAST(CAST(value AS FLOAT) AS DOUBLE) AS as_float,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS lenient FROM events""")
def conv_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", convert.to_double(text, strict=True).alias("as_double"),
        convert.to_float(text).cast("double").alias("as_float"),
        convert.to_double(F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(text)).alias("lenient"))


@query("conv_date", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       CAST(DATE '1970-01-01' - CAST(o_orderkey % 40000 AS INTEGER) AS VARCHAR) AS before_epoch FROM orders""")
def conv_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", convert.to_date(day).cast("string").alias("day"),
        convert.to_date(-(F.col("o_orderkey") % 40000)).cast("string").alias("before_epoch"))


CLOCK = "(epoch_us(ts) - epoch_us(date_trunc('day', ts)))"


@query("conv_time", f"""
SELECT event_id, CAST({CLOCK} // 1000 AS INTEGER) AS from_micros, CAST({CLOCK} // 1000 AS INTEGER) AS from_nanos,
       CAST({CLOCK} // 1000 AS INTEGER) AS from_millis, CAST({CLOCK} // 1000000 * 1000 AS INTEGER) AS from_text
FROM events""")
def conv_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.col("micros") % 86400000000
    return events(spark, sf_dir).select(
        "event_id", convert.to_time_millis(clock, "micros").alias("from_micros"),
        convert.to_time_millis(clock * 1000, "nanos").alias("from_nanos"),
        convert.to_time_millis(F.col("millis") % 86400000, "millis").alias("from_millis"),
        convert.to_time_millis(F.substring(F.col("ts").cast("string"), 12, 15), "text").alias("from_text"))


@query("conv_timestamp", """
SELECT event_id, CAST(date_trunc('millisecond', ts) AS VARCHAR) AS from_millis, CAST(ts AS VARCHAR) AS from_micros,
       CAST(ts AS VARCHAR) AS from_nanos,
       CAST(TIMESTAMP '1970-01-01' - to_microseconds(epoch_us(ts) - 1600000000000000) AS VARCHAR) AS before_epoch
FROM events""")
def conv_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.col("micros")
    text = lambda c, unit: convert.to_timestamp(c, unit).cast("string")
    return events(spark, sf_dir).select(
        "event_id", text(F.col("millis"), "millis").alias("from_millis"),
        text(micros, "micros").alias("from_micros"),
        text(micros * 1000 + 999, "nanos").alias("from_nanos"),
        text(-(micros - 1600000000000000), "micros").alias("before_epoch"))


@query("conv_instant", """
SELECT event_id, CASE WHEN event_id % 6 > 0 THEN CAST(ts + INTERVAL 8 HOUR AS VARCHAR) END AS local_time FROM events""")
def conv_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    text = F.when(F.col("event_id") % 6 == 0, F.lit("2024-01-01 00:00:00")).otherwise(iso)
    return table(spark, sf_dir, "events").select(
        "event_id", convert.to_local_timestamp(text, ZONE).cast("string").alias("local_time"))


@query("conv_text", """
SELECT doc_id, CAST(n_chars AS VARCHAR) AS number_text, md5(text) AS bytes_md5 FROM documents""")
def conv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = F.base64(F.encode("text", "UTF-8"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", convert.to_text(F.col("n_chars")).alias("number_text"),
        F.md5(convert.to_binary(encoded)).alias("bytes_md5"))


@query("conv_decimal", """
WITH c AS (SELECT o_orderkey, CAST(floor(o_totalprice * 100) AS BIGINT) - 20000000 AS cents FROM orders)
SELECT o_orderkey, CAST(CAST(CAST(cents AS DECIMAL(20,2)) / 1 AS DECIMAL(20,2)) AS VARCHAR) AS from_text,
       CAST(CAST(CAST(cents AS HUGEINT) AS DECIMAL(38,0)) AS VARCHAR) AS from_bytes,
       CAST(CAST(cents AS DECIMAL(20,3)) * CAST(0.001 AS DECIMAL(4,3)) AS VARCHAR) AS from_struct,
       CAST(CAST(cents / 4 AS DECIMAL(20,2)) AS VARCHAR) AS from_double FROM c""")
def conv_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.floor(F.col("o_totalprice") * 100).cast("bigint") - 20000000
    raw = F.base64(F.unhex(F.lpad(F.hex(cents), 16, "0")))
    own = F.struct(F.lit(3).alias("scale"), raw.alias("value"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        convert.to_decimal(cents.cast("string"), 20, 2).cast("string").alias("from_text"),
        convert.to_decimal(raw, 38, 0, "bytes").cast("string").alias("from_bytes"),
        convert.to_decimal(own, 38, 6, "struct").cast("string").alias("from_struct"),
        convert.to_decimal(cents / 4, 20, 2, "double").cast("string").alias("from_double"))


@query("temporal_plain", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, substr(CAST(ts AS VARCHAR), 12) AS clock,
       CAST(ts AS VARCHAR) AS moment FROM events""")
def temporal_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", temporal.date_plain(F.col("ts")).alias("day"),
        temporal.duration_plain(F.col("micros") % 86400000000).alias("clock"),
        temporal.datetime_plain(F.col("ts")).alias("moment"))


@query("temporal_phase_shift", """
SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 8 HOUR ELSE ts + INTERVAL 8 HOUR END AS VARCHAR)
       AS moment FROM events""")
def temporal_phase_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = F.col("event_id") % 2 == 0
    return table(spark, sf_dir, "events").select(
        "event_id", temporal.timestamp_plain(F.col("ts"), snapshot, ZONE).alias("moment"))


@query("temporal_zulu", """
SELECT event_id, concat(CAST(CAST(ts AS DATE) AS VARCHAR), 'Z') AS day, concat(substr(CAST(ts AS VARCHAR), 12), 'Z') AS clock,
       concat(replace(CAST(ts - INTERVAL 8 HOUR AS VARCHAR), ' ', 'T'), 'Z') AS moment,
       CASE WHEN event_id % 2 = 0 THEN concat(replace(CAST(ts - INTERVAL 8 HOUR AS VARCHAR), ' ', 'T'), 'Z')
            ELSE concat(replace(CAST(ts + INTERVAL 8 HOUR AS VARCHAR), ' ', 'T'), '+08:00') END AS instant FROM events""")
def temporal_zulu(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id", temporal.date_zulu(ts).alias("day"),
        temporal.duration_zulu(F.col("micros") % 86400000000).alias("clock"),
        temporal.datetime_zulu(ts, ZONE).alias("moment"),
        temporal.timestamp_zulu(ts, F.col("event_id") % 2 == 0, ZONE).alias("instant"))


@query("sql_converters", f"""
WITH e AS (SELECT *, event_id * 3 - 300 AS n, event_id * 100000300007 AS big FROM events)
SELECT event_id, event_id % 7 IN (0, 1, 2) AS flag, TRY_CAST(n AS TINYINT) AS as_byte, TRY_CAST(n * 10 AS SMALLINT) AS as_short,
       TRY_CAST(big AS INTEGER) AS as_int, big AS as_long,
       CAST((big + 2147483648) % 4294967296 - 2147483648 AS INTEGER) AS narrowed,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS lenient,
       CAST(DATE '1970-01-01' - CAST(event_id % 40000 AS INTEGER) AS VARCHAR) AS before_epoch,
       CAST({CLOCK} // 1000 AS INTEGER) AS clock_millis, CAST(ts AS VARCHAR) AS from_nanos,
       CAST(date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS VARCHAR) AS local_time,
       CASE WHEN event_id % 6 > 0 THEN CAST(ts + INTERVAL 8 HOUR AS VARCHAR) END AS from_instant,
       CAST(CAST(n AS HUGEINT) AS VARCHAR) AS from_bytes,
       concat(CAST(CAST(ts AS DATE) AS VARCHAR), 'Z') AS day, concat(substr(CAST(ts AS VARCHAR), 12), 'Z') AS clock,
       concat(replace(CAST(ts - INTERVAL 8 HOUR AS VARCHAR), ' ', 'T'), 'Z') AS moment,
       CAST(CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 8 HOUR ELSE ts + INTERVAL 8 HOUR END AS VARCHAR) AS shifted,
       CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 16 AS bucket
FROM e""")
def sql_converters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The converters as SQL functions."""
    register_converters(spark)
    return spark.sql(f"""
        SELECT event_id,
               cdc_to_boolean(array('1', 'true', 'TRUE', '0', 'false', 'yes', '2')[event_id % 7]) AS flag,
               cdc_to_byte(n) AS as_byte, cdc_to_short(n * 10) AS as_short, cdc_to_int(big) AS as_int,
               cdc_to_long(CAST(big AS STRING)) AS as_long, cdc_narrow_to_int(big) AS narrowed,
               cdc_to_double(CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END) AS lenient,
               CAST(cdc_to_date(CAST(-(event_id % 40000) AS INT)) AS STRING) AS before_epoch,
               cdc_time_millis(micros % 86400000000, 'micros') AS clock_millis,
               CAST(cdc_to_timestamp(micros * 1000 + 999, 'nanos') AS STRING) AS from_nanos,
               CAST(cdc_epoch_millis_local(millis, '{ZONE}') AS STRING) AS local_time,
               CAST(cdc_local_timestamp(CASE WHEN event_id % 6 = 0 THEN '2024-01-01 00:00:00'
                   ELSE concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z') END, '{ZONE}') AS STRING) AS from_instant,
               CAST(cdc_integer_of_bytes(unhex(lpad(hex(n), 16, '0'))) AS STRING) AS from_bytes,
               cdc_date_zulu(ts) AS day, cdc_duration_zulu(micros % 86400000000) AS clock,
               cdc_datetime_zulu(ts, '{ZONE}') AS moment,
               cdc_timestamp_plain(ts, event_id % 2 = 0, '{ZONE}') AS shifted,
               cdc_portable_bucket(CAST(event_id AS STRING), 16) AS bucket
        FROM (SELECT *, event_id * 3 - 300 AS n, event_id * 100000300007 AS big FROM {{e}})""",
                     e=events(spark, sf_dir))
