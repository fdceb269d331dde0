"""A text corpus from raw documents to shards, stage by stage.

Each stage takes all that its predecessor kept, as it was written and read again,
and gives documents with their own columns; the last adds where each row goes.

1. ``quality``: the classifier's score decides; what it rejects goes.
2. ``near_duplicates``: one document of each SimHash group stays.
3. ``decontaminate``: documents that hold too much of a benchmark item go.
4. ``mix``: domains, languages and sources are brought to their target weights.
5. ``shard``: every row gets its ``slot`` and ``shard``.

Null texts count as empty, repeated rows are kept or left out by the rules of the
operators, an empty table stays empty, and extra columns pass through untouched.
A column of the documents named ``slot`` or ``shard`` keeps its values; the
stage's own then has underscores added to its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import classifier, decontaminate, mixing, sharding, simhash
from tidewell.llm.components import stored
from tidewell.llm.registry import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.good_only(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    placed = sharding.sharded(docs)
    return placed.select(*[F.col("doc")[c].alias(c) for c in docs.columns],
                         F.col("slot").alias(free("slot")), F.col("shard").alias(free("shard")))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("mix", mix),
    ("shard", shard),
]

# The classifier and the groups of near duplicates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
