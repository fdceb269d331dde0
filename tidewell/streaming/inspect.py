"""What a stateful query keeps, read from its checkpoint: the operators, the rows of
their state, and the changes each batch made to it.

Changes are read from the changelog files that ``session.JOB_SETTINGS`` turns on; a
key written by a batch is one change, whether or not its value is another one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import use_rocksdb


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store: its name, partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """``key`` and ``value`` as they stood after a batch (the last one unless given)."""
    use_rocksdb(spark)
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def state_changes(spark: SparkSession, checkpoint: str, operator: int = 0, first: int = 0,
                  last: int | None = None) -> DataFrame:
    """``batch_id``, ``change_type``, ``key`` and ``value`` of the changes that the
    batches ``first`` to ``last`` (the last one unless given) made."""
    use_rocksdb(spark)
    reader = (spark.read.format("statestore").option("operatorId", operator)
              .option("readChangeFeed", True).option("changeStartBatchId", first))
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load(checkpoint)
