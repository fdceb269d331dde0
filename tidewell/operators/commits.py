"""Decisions over commit frames ``(table, commit, ts, ...)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_commit(commits: DataFrame, group: Sequence[str] = (), path: str = "path",
                  modified: str = "mtime") -> DataFrame:
    """Path with the latest modification time; equal times take the greater path."""
    pick = F.max(F.struct(modified, path)).getField(path).alias(path)
    return commits.groupBy(*group).agg(pick)


def compaction_due(commits: DataFrame, now: Column, table: str = "table",
                   max_commits: int = 5, max_seconds: int = 1800) -> DataFrame:
    """Per table, whether its uncompacted commits are many or old enough."""
    age = F.timestamp_diff("SECOND", F.min("ts"), now)
    return (commits.filter(~F.col("compacted")).groupBy(table)
            .agg(F.count(F.lit(1)).alias("pending"), age.alias("age_seconds"))
            .withColumn("due", (F.col("pending") >= max_commits)
                        | (F.col("age_seconds") >= max_seconds)))


def _kth_newest(commits: DataFrame, table: str, keep: int, salts: int) -> DataFrame:
    """Per table, the ``keep``-th newest commit.

    A table's commits are ranked in salted parts first; only the top of each
    part goes on, so no task ranks more than ``salts * keep`` rows at the end
    and none holds a whole table.
    """
    salted = Window.partitionBy(table, "_salt").orderBy(F.desc("commit"))
    whole = Window.partitionBy(table).orderBy(F.desc("commit"))
    parts = (commits.select(table, "commit")
             .withColumn("_salt", F.pmod(F.hash("commit"), F.lit(salts)))
             .withColumn("_rank", F.row_number().over(salted))
             .filter(F.col("_rank") <= keep))
    return (parts.withColumn("_rank", F.row_number().over(whole))
            .filter(F.col("_rank") == keep)
            .select(table, F.col("commit").alias("_oldest_kept")))


def clean_candidates(commits: DataFrame, keep: int = 10080, table: str = "table",
                     salts: int = 32) -> DataFrame:
    """Commits that may be deleted: folded into a base, and not among the
    ``keep`` newest of their table."""
    limit = _kth_newest(commits, table, keep, salts)
    return (commits.join(limit, table)
            .filter(F.col("compacted") & (F.col("commit") < F.col("_oldest_kept")))
            .drop("_oldest_kept"))


def archive_bounds(keep: int = 10080) -> tuple[int, int]:
    """Fewest and most commits the active list may hold."""
    return keep + 10, keep + 20


def archive_candidates(commits: DataFrame, keep: int = 10080, table: str = "table",
                       salts: int = 32) -> DataFrame:
    """Commits to archive: in tables over the upper bound, all but the newest
    of the lower bound."""
    fewest, most = archive_bounds(keep)
    over = (commits.groupBy(table).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > most).select(table))
    limit = _kth_newest(commits, table, fewest, salts).join(over, table, "left_semi")
    return (commits.join(limit, table)
            .filter(F.col("commit") < F.col("_oldest_kept"))
            .drop("_oldest_kept"))
