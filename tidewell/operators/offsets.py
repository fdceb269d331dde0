"""Where to start, resume and replay: positions, transaction-id sets, phases."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import gtid
from tidewell.operators import chunks, intervals


POSITION_BITS = 40


RANK_BITS = 48


def source_sequence(by: str, source: str = "source", servers: Sequence[str] = ()) -> Column:
    """One rising number per log entry, for the ordering column ``seq``.

    ``position`` packs the log file's number above its offset and tells apart
    two changes of one row in one transaction; it holds on one server only.
    ``gtid`` packs the rank of the server in ``servers``, the servers in the order
    in which they led, above the transaction's number; after a change of server
    the new one must be listed, or the job fails. Without ``servers`` it is the
    bare number, for sources that never change. Changes of one row in one
    transaction share it: order them by ``position`` too (``gtid_order``).
    ``lsn`` is a write-ahead log's own number.
    """
    field = lambda name: F.col(f"{source}.{name}")
    if by == "position":
        file = F.regexp_extract(field("file"), r"(\d+)$", 1).cast("bigint")
        return F.shiftleft(file, POSITION_BITS) + field("pos")
    if by == "gtid":
        number = gtid.id_number(field("gtid"))
        if not servers:
            return number
        uuid = gtid.id_uuid(field("gtid"))
        ranks = F.create_map(*[F.lit(x) for i, s in enumerate(servers) for x in (s, i)])
        rank = F.coalesce(ranks[uuid], F.when(uuid.isNotNull(), F.raise_error(
            F.concat(F.lit("server without a rank: "), uuid)).cast("int")))
        return F.shiftleft(rank.cast("bigint"), RANK_BITS) + number
    if by == "lsn":
        return field("lsn")
    raise ValueError(f"unknown sequence {by!r}")


def gtid_order(servers: Sequence[str], source: str = "source") -> dict[str, Column]:
    """Ordering columns that survive a change of server: ``seq`` by server and
    transaction, then ``log_seq`` by the place in the log."""
    return {"seq": source_sequence("gtid", source, servers), "log_seq": source_sequence("position", source)}


def file_number(file: Column) -> Column:
    """The number a log file's name ends in; null without one."""
    return F.regexp_extract(file, r"(\d+)$", 1).try_cast("bigint")


def at_or_after(frame: DataFrame, file: str, pos: int, file_col: str = "source.file",
                pos_col: str = "source.pos") -> DataFrame:
    """Records from a log position on, ``(file, pos)`` compared as a pair. Files
    compare by the number their name ends in, which may grow by a digit; names
    without one compare as text.
    """
    f, p = F.col(file_col), F.col(pos_col)
    digits = re.search(r"\d+$", file)
    later = f > file
    if digits:
        later = F.coalesce(file_number(f) > int(digits[0]), later)
    return frame.filter(later | ((f == file) & (p >= pos)))


def intervals_of(spark: SparkSession, gtid_set: str) -> DataFrame:
    """A transaction-id set as rows ``(_uuid, _low, _high)``."""
    return spark.createDataFrame(gtid.parse_set(gtid_set), "_uuid string, _low bigint, _high bigint")


def in_gtid_set(gtid_set: str, transaction: Column) -> Column:
    """Whether a transaction id is in a set. The set is text given by the caller, so it
    becomes part of the expression: no join, the same on streams. A server's
    intervals are two sorted lists and a binary search, however many there are."""
    uuid, number = gtid.id_uuid(transaction), gtid.id_number(transaction)
    by_server: dict[str, list[list[int]]] = {}
    for server, low, high in sorted(gtid.parse_set(gtid_set)):
        runs = by_server.setdefault(server, [])
        if runs and low <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    inside = F.lit(False)
    for server, runs in by_server.items():
        lows, highs = (F.split(F.lit(",".join(str(r[i]) for r in runs)), ",").cast("array<bigint>") for i in (0, 1))
        below = chunks.at_or_below(lows, F.lit(len(runs)), number)
        inside = inside | ((uuid == server) & (F.get(highs, below - 1) >= number))
    return F.coalesce(inside, F.lit(False))


def after_gtid_set(frame: DataFrame, gtid_set: str, gtid_col: str = "source.gtid") -> DataFrame:
    """Records whose transaction is not in the set; records without one are kept."""
    return frame.filter(~in_gtid_set(gtid_set, F.col(gtid_col)))


def snapshot_plus_changes(snapshot: DataFrame, changes: DataFrame, position: Column | int,
                          seq: str = "seq") -> DataFrame:
    """Snapshot records and the changes after its position. Overlap is harmless:
    the newest version per key wins."""
    return snapshot.unionByName(changes.filter(F.col(seq) > position))


def low_water_members(offsets: DataFrame, gtid_set: str = "gtid_set") -> DataFrame:
    """Per server uuid, the intervals of the task that is furthest behind.

    A task is judged by the top of its intervals. Servers missing on some tasks
    are kept, and equal tops take the smaller text, so the result is one.
    """
    members = (offsets.filter(F.col(gtid_set).isNotNull() & (F.col(gtid_set) != ""))
               .select(F.explode(F.split(F.col(gtid_set), ",")).alias("_m"))
               .select(gtid.member_uuid(F.trim("_m")).alias("uuid"),
                       gtid.member_intervals(F.trim("_m")).alias("intervals")))
    ranked = members.withColumn("top", gtid.highest(F.col("intervals")))
    return (ranked.groupBy("uuid")
            .agg(F.min(F.struct("top", "intervals")).alias("_low"))
            .select("uuid", F.col("_low.intervals").alias("intervals"),
                    F.col("_low.top").alias("top")))


def gtid_low_water(offsets: DataFrame, gtid_set: str = "gtid_set") -> DataFrame:
    """One row, ``gtid_set``: the set every task has reached. Fails when no task
    reported a set."""
    text = F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", "uuid", "intervals"))))
    return low_water_members(offsets, gtid_set).agg(
        F.when(F.count(F.lit(1)) > 0, text)
        .otherwise(F.raise_error(F.lit("no task reported a transaction-id set")))
        .alias("gtid_set"))


def source_offsets(feed: DataFrame, group: Sequence[str], gtid_col: str = "source.gtid",
                   op: str = "op") -> DataFrame:
    """Last transaction per group and server; ``snapshot_only`` marks sources
    that have not left their snapshot and cannot be resumed from yet."""
    number = gtid.id_number(F.col(gtid_col))
    return (feed.groupBy(*group, gtid.id_uuid(F.col(gtid_col)).alias("uuid"))
            .agg(F.max(number).alias("txn"), F.min(F.col(op) == "r").alias("snapshot_only")))


def source_gtid_set(feed: DataFrame, group: Sequence[str], gtid_col: str = "source.gtid") -> DataFrame:
    """Per group, the transactions seen as a ``gtid_set`` that the low-water mark, a
    reset and the start after a set accept. Sets too large for a text stay rows:
    ``intervals.seen_intervals``."""
    return intervals.sets_as_text(intervals.seen_intervals(feed, group, gtid_col), group)


def reset_offsets(offsets: DataFrame, given: str | None = None, gtid_set: str = "gtid_set") -> DataFrame:
    """Offsets of every task set to ``given``, or to the low-water mark."""
    if given:
        gtid.parse_set(given)
        return offsets.withColumn(gtid_set, F.lit(given))
    return offsets.withColumn(gtid_set, gtid_low_water(offsets, gtid_set).scalar())


def reset_tables(processed: DataFrame, reset: DataFrame, table: str = "table") -> DataFrame:
    """Tables still counted as snapshotted after some were reset."""
    return processed.join(reset.select(table).distinct(), table, "left_anti")


def new_tables(feed: DataFrame, processed: DataFrame, table: str = "table") -> DataFrame:
    """Records of tables that have no finished snapshot yet."""
    return feed.join(processed.select(table).distinct(), table, "left_anti")


def capture_phase(feed: DataFrame, table: str, op: str = "op") -> DataFrame:
    """``snapshot``, ``incremental`` or ``hybrid`` per table, by the ops seen."""
    snapshot = F.max(F.col(op) == "r")
    changes = F.max(F.col(op) != "r")
    return feed.groupBy(table).agg(
        F.when(snapshot & changes, F.lit("hybrid"))
        .when(changes, F.lit("incremental"))
        .otherwise(F.lit("snapshot")).alias("phase"))


def incremental_offsets(offsets: DataFrame, kind: str = "kind") -> DataFrame:
    """Offsets without the entries of unfinished snapshots."""
    return offsets.filter(F.col(kind) == "incremental")
