"""Sharding through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size. The shards take turns, each claiming its best free slot, until none is
left; so all own the same number of slots, to within one, and a shard that is
added or removed moves few of the others' slots. A key's slot is its hash modulo
the table's size, and its shard is looked up there: one broadcast join with a
table whose size depends on the number of shards alone, no row moves.

Rows of equal keys share a shard. A null key says nothing about its row, so such
rows are placed by a hash of the whole row and spread like any others. An empty
table gives no rows; repeated rows go to one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.registry import query, table

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS_PER_SHARD = 100


def prime_from(least: int) -> int:
    n = max(2, least)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _number(text: str) -> int:
    """60 bits of a hash; the same in every engine that has MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] = SHARDS, size: int | None = None) -> list[int]:
    """The shard number of each slot."""
    size = size or prime_from(SLOTS_PER_SHARD * len(shards))
    start = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    step = [0] * len(shards)
    slots = [-1] * size
    for turn in range(size):
        shard = turn % len(shards)
        while True:
            slot = (start[shard] + step[shard] * skip[shard]) % size
            step[shard] += 1
            if slots[slot] < 0:
                slots[slot] = shard
                break
    return slots


def slot_of(key: Column, size: int) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint") % F.lit(size)


def sharded(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS,
            size: int | None = None) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with ``slot`` and ``shard``."""
    slots = lookup_table(shards, size)
    content = F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    own = F.coalesce(F.concat(F.lit("key:"), F.col(f"`{key}`").cast("string")), F.concat(F.lit("row:"), content))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       slot_of(own, len(slots)).alias("slot"))
    # One number a slot: the table's size is set by the number of shards.
    names = F.array(*[F.lit(s) for s in shards])
    owners = docs.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(",".join(map(str, slots))), ",")).alias("slot", "owner")).select(
        F.col("slot").cast("bigint").alias("slot"), F.get(names, F.col("owner").cast("int")).alias("shard"))
    return rows.join(F.broadcast(owners), "slot")


OP6_SQL = """
WITH RECURSIVE shards AS (
  SELECT i AS shard, printf('shard-%02d', i) AS name,
         ('0x' || substr(md5('offset:' || printf('shard-%02d', i)), 1, 15))::BIGINT % 1601 AS start,
         ('0x' || substr(md5('skip:' || printf('shard-%02d', i)), 1, 15))::BIGINT % 1600 + 1 AS skip
  FROM range(16) t(i)
), fill AS (
  SELECT 0::BIGINT AS turn, NULL::BIGINT AS slot, [false FOR x IN range(1601)] AS taken
  UNION ALL
  SELECT turn + 1, picked, taken[1:picked] || [true] || taken[picked + 2:1601]
  FROM (
    SELECT turn, taken, start, skip,
           (start + skip * (list_position([taken[(start + j * skip) % 1601 + 1] FOR j IN range(1601)],
                                          false) - 1)) % 1601 AS picked
    FROM fill JOIN shards ON shard = turn % 16
    WHERE turn < 1601)
), owners AS (
  SELECT slot, name AS shard FROM fill JOIN shards ON shards.shard = (turn - 1) % 16 WHERE slot IS NOT NULL
)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5('key:' || doc_id), 1, 15))::BIGINT % 1601 AS slot FROM documents)
JOIN owners USING (slot)
"""


@query("op6_sharding", OP6_SQL)
def op6(spark, sf_dir: str) -> DataFrame:
    placed = sharded(table(spark, sf_dir, "documents").select("doc_id"))
    return placed.select(F.col("doc")["doc_id"].alias("doc_id"), "slot", "shard")
