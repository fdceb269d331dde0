"""Snapshot, change-feed, Kafka-shaped and text-line readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.envelope import parse_envelope

# The columns a Kafka source gives; readers below work on any frame of them.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def as_snapshot(rows: DataFrame, topic: Column | str, position: int = 0) -> DataFrame:
    """Existing rows as ``r`` records with the row as new image."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return rows.select(
        name.alias("topic"), F.lit("r").alias("op"), F.lit(position).cast("bigint").alias("seq"),
        F.struct(*rows.columns).alias("after"))


def snapshot_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                  partitions: int, properties: dict[str, str] | None = None,
                  fetch_size: int = 10000) -> DataFrame:
    """A table read over JDBC in ``partitions`` ranges of a numeric column."""
    return (spark.read.format("jdbc")
            .options(**(properties or {}), url=url, dbtable=table, partitionColumn=column,
                     lowerBound=lower, upperBound=upper, numPartitions=partitions,
                     fetchsize=fetch_size)
            .load())


def read_feed_text(spark: SparkSession, path: str, row: T.StructType, key: T.StructType) -> DataFrame:
    """Envelope JSON lines under ``path``, typed."""
    return parse_envelope(spark.read.text(path), row, key)


def stream_feed_text(spark: SparkSession, path: str, row: T.StructType, key: T.StructType,
                     files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_envelope(reader.load(path), row, key)


def stream_kafka(spark: SparkSession, brokers: str, topics: str, start_millis: int | None = None,
                 per_trigger: int | None = None) -> DataFrame:
    """Kafka stream. Committed progress lives in the query's checkpoint; the start
    time matters only for a new checkpoint. Needs the Kafka connector package."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topics).option("failOnDataLoss", "true"))
    if start_millis is not None:
        reader = reader.option("startingTimestamp", str(start_millis))
    else:
        reader = reader.option("startingOffsets", "earliest")
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def from_offsets(frame: DataFrame, committed: DataFrame) -> DataFrame:
    """Kafka-shaped rows at or behind the committed ``(topic, partition, next_offset)``;
    partitions without a committed offset start at their first row."""
    joined = frame.join(committed.select("topic", "partition", "next_offset"),
                        ["topic", "partition"], "left")
    return joined.filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")


def from_time(frame: DataFrame, start_millis: int) -> DataFrame:
    """Kafka-shaped rows from a point in time on. The bound is a literal, so it
    is pushed to a file scan."""
    return frame.filter(F.col("timestamp") >= F.timestamp_millis(F.lit(start_millis)))


def value_text(frame: DataFrame) -> DataFrame:
    """Kafka-shaped rows with ``key`` and ``value`` decoded."""
    return frame.withColumns({"key": F.col("key").cast("string"),
                              "value": F.col("value").cast("string")})


def split_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One lowercased word per comma-separated part; empty parts at the end of a
    line do not count."""
    line = F.col(column)
    parts = F.split(F.regexp_replace(line, ",+$", ""), ",")
    words = F.when(line.rlike("^,+$"), F.array().cast("array<string>")).otherwise(parts)
    return lines.select(F.explode(words).alias("word")).select(F.lower("word").alias("word"))
