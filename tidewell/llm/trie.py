"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns. It is known by its depth and a 128-bit
key, the exclusive or of one hash per turn (of place, role and text), so a prefix sum
over a conversation's turns gives the keys of all its nodes and no text moves.

Totals flow from the leaves up. A node's *weight* is the number of turns below it in
all its members; it bounds the subtree's nodes and falls on every step down. Nodes
heavier than a limit are the crown, the topmost lighter ones are shard roots. So a
shard is a whole subtree of bounded size, however many conversations share its first
turn, and the tasks take several shards each:

1. Within a task, nodes come in reverse level order, by Spark's external sort. Each
   node takes the messages of its children from a priority queue that spills sorted
   runs, and sends its own totals to its parent (``passed_up``).
2. The totals of shard roots are summed by parent, with a map-side combine.
3. The same pass runs over the crown. The limit is a ``PIECES``-th of all turns (at
   most ``HEAVIEST``), so a level of the crown has ``PIECES`` nodes at most; its size
   depends on the depth of shared conversations and not on the number of rows.

Conversations are numbered and summed in chunks of ``CHUNK`` turns, so one very long
conversation is spread too. The ids that end at a node are hashed as a stream of
sorted chunks: a list of any length is never held.

Defined results: a null role or text is empty. Turns of equal number (null comes
first) are ordered by an MD5 of role and text; repeated rows are turns of their own.
Rows without a conversation id belong to no conversation and are left out. Without
conversations there are no nodes, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table

CHUNK = 4096
PIECES, HEAVIEST, LIGHTEST = 1024, 4_000_000, 64
QUEUED = 500_000  # messages of a queue in memory; more are spilled
SMALL = 300_000  # rows of the crown that are sent to every task
ENDS = 1024  # ids a chunk of a node's members
NODE = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_hash(role: str = "role", text: str = "text") -> Column:
    """The same for equal turns only; the role's length keeps the two apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``turn_hash`` and ``bytes`` of each turn's text."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.select("conv_id", "turn", F.expr(f"coalesce(turn div {CHUNK} - int(turn < 0), -9223372036854775808)")
                       .alias("chunk"), turn_hash().alias("turn_hash"), F.octet_length("text").cast("long").alias("bytes"))
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "chunk").count().select(
        "conv_id", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "turn_hash")
    return rows.withColumn("i", F.row_number().over(within)).join(starts, ["conv_id", "chunk"]).select(
        "conv_id", (F.col("start") + F.col("i") - 1).alias("place"), "turn_hash", "bytes")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per conversation and depth (0: the root) with the node's key ``k1``, ``k2``
    and its parent's ``p1``, ``p2``.

    ``turns`` has ``conv_id``, ``depth`` from 1, ``turn_hash``, ``bytes``; ``lengths``
    has every ``conv_id`` with its ``len``, also those without turns.
    """
    hashes = {"e1": F.xxhash64("depth", "turn_hash"), "e2": F.xxhash64("turn_hash", "depth", F.lit(2))}
    rows = turns.withColumns(hashes).withColumn("chunk", F.expr(f"depth div {CHUNK}"))
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2")).select(
        "conv_id", "chunk", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("s1", "s2")])
    so_far = W.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    keyed = rows.withColumns({f"x{i}": F.bit_xor(f"e{i}").over(so_far) for i in (1, 2)}).join(
        starts, ["conv_id", "chunk"])
    keyed = keyed.select("conv_id", "depth", "bytes", *[F.col(f"x{i}").bitwiseXOR(F.col(f"s{i}")).alias(f"k{i}") for i in (1, 2)],
                         "e1", "e2").join(lengths, "conv_id")
    keyed = keyed.select("conv_id", "depth", "len", "bytes", "k1", "k2",
                         *[F.col(f"k{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in (1, 2)])
    zero = F.lit(0).cast("long")
    return keyed.union(lengths.select("conv_id", zero, "len", *[zero] * 5))


class SpillingQueue:
    """A priority queue of fixed-length tuples of integers; beyond ``most`` of them
    it writes sorted runs to files of its task, which go with it."""

    def __init__(self, most: int = QUEUED, width: int = 5):
        self.most, self.row = most, struct.Struct(f"<{width}q")
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (next item, run number, iterator)
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self.heap.sort()
            file = tempfile.TemporaryFile()
            for i in range(0, len(self.heap), 4096):
                file.write(b"".join(self.row.pack(*x) for x in self.heap[i:i + 4096]))
            self.heap = []
            file.seek(0)
            self.spilled += 1
            self._next(self.spilled, self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while block := file.read(self.row.size * 4096):
                yield from self.row.iter_unpack(block)

    def _next(self, number: int, items: Iterator[tuple]) -> None:
        item = next(items, None)
        if item is not None:
            heapq.heappush(self.runs, (item, number, items))

    def pop(self, key: tuple) -> Iterator[tuple]:
        """Take the items that start with ``key``, which must be the least there is."""
        while True:
            from_run = self.runs and (not self.heap or self.runs[0][0] < self.heap[0])
            least = self.runs[0][0] if from_run else self.heap[0] if self.heap else None
            if least is None or least[:len(key)] != key:
                assert least is None or least > key, "a message was passed over"
                return
            if from_run:
                _, number, items = heapq.heappop(self.runs)
                self._next(number, items)
            else:
                heapq.heappop(self.heap)
            yield least


NODE_FIELDS = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, bytes long, top boolean"
TOTALS = "n_children long, n_leaves long, saved_tokens long"


def _pass_up(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    queue = SpillingQueue(most)
    for batch in batches:
        read = batch.to_pydict()
        totals = []
        for depth, k1, k2, p1, p2, n, size, top, children, leaves, saved in zip(*(read[c] for c in (
                "depth", "k1", "k2", "p1", "p2", "n_convs", "bytes", "top", "n_children", "n_leaves", "saved_tokens"))):
            for message in queue.pop((-depth, k1, k2)):
                children += 1
                leaves += message[3]
                saved += message[4]
            leaves = leaves if children else 1
            saved += (n - 1) * size
            totals.append((children, leaves, saved))
            if not top:
                queue.push((1 - depth, p1, p2, leaves, saved))
        done = [pa.array(x, pa.int64()) for x in zip(*totals)] or [pa.array([], pa.int64())] * 3
        names = batch.schema.names[:-3]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *done], names=[*names, "n_children", "n_leaves", "saved_tokens"])


def passed_up(nodes: DataFrame, most: int = QUEUED) -> DataFrame:
    """Nodes with their totals; what they have of them already is added to. Every
    partition holds whole subtrees, up to nodes whose ``top`` is set."""
    fields = [f.name for f in T.StructType.fromDDL(f"{NODE_FIELDS}, {TOTALS}")]
    ordered = nodes.select(fields).sortWithinPartitions(F.desc("depth"), "k1", "k2")
    return ordered.mapInArrow(lambda batches: _pass_up(batches, most), f"{NODE_FIELDS}, {TOTALS}")


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha = None, None
    for batch in batches:
        done = []
        read = batch.to_pydict()
        for *node, ids in zip(*(read[c] for c in [*NODE, "ids"])):
            if node != now:
                if now is not None:
                    done.append((*now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip([*NODE, "ends_sha256"], map(list, zip(*done)))))
    if now is not None:
        yield pa.RecordBatch.from_pydict(dict(zip([*NODE, "ends_sha256"], [[x] for x in (*now, sha.hexdigest())])))


def ends(paths: DataFrame) -> DataFrame:
    """``ends_sha256`` of the nodes at which conversations end: their ids in order,
    joined by commas, a chunk of at most ``ENDS`` ids a row."""
    chunks = (paths.filter("depth = len").groupBy(*NODE, F.shiftright("conv_id", ENDS.bit_length() - 1).alias("chunk"))
              .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .select(*NODE, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").mapInArrow(
        _hash_ends, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(spark: SparkSession, turns: DataFrame, lengths: DataFrame, pieces: int = PIECES,
                lightest: int = LIGHTEST, queued: int = QUEUED) -> DataFrame:
    """All nodes: their key, ``conv_id`` (least member), ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    paths = stored(spark, prefixes(turns, lengths), "trie-paths")
    nodes = stored(spark, paths.groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "conv_id", "bytes")], F.count("*").alias("n_convs"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight")), "trie-nodes")
    total = nodes.filter("depth = 0").agg(F.max("weight")).first()[0] or 0
    limit = max(lightest, min(HEAVIEST, -(-total // pieces)))
    crown = nodes.filter(F.col("weight") > limit)
    n_crown = crown.count()

    # The first node of a conversation below the crown is the root of its shard.
    keys = crown.select(*NODE)
    steps = paths.join(F.broadcast(keys) if n_crown <= SMALL else keys, NODE, "left_semi").groupBy("conv_id").agg(
        F.count("*").alias("depth"))
    starts = lengths.select("conv_id").join(steps, "conv_id", "left").select(
        "conv_id", F.coalesce("depth", F.lit(0)).alias("depth"))
    roots = paths.join(starts, ["conv_id", "depth"]).select(
        "conv_id", F.col("depth").alias("root"), F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    none = {c.split()[0]: F.lit(0).cast("long") for c in TOTALS.split(", ")}
    sharded = nodes.filter(F.col("weight") <= limit).join(roots, "conv_id").withColumns(
        {"top": F.col("depth") == F.col("root"), **none}).repartition("root", "r1", "r2")
    low = stored(spark, passed_up(sharded, queued), "trie-shards")

    arrived = low.filter("top AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    met = crown.join(arrived, NODE, "left").withColumns(
        {"top": F.col("depth") == 0, **{c: F.coalesce(c, F.lit(0)).alias(c) for c in none}})
    every = low.union(passed_up(met.repartition(1), queued))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return every.join(ends(paths), NODE, "left").join(parents, ["depth", "p1", "p2"], "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


HEAD, FAMILY = 9, 5


def rebuilt(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after each conversation's first turns (their number is a
    hash of its id) were replaced by those of the first of its family of ``FAMILY``."""
    own = stored(spark, numbered(conversations), "trie-turns")
    head = F.crc32(F.col("conv_id").cast("string")) % HEAD
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    sizes = sizes.join(first, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("given"), "n")
    sizes = stored(spark, sizes.select("*", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")),
                   "trie-lengths")
    heads = own.filter((F.col("place") < HEAD - 1) & (F.col("conv_id") % FAMILY == 0)).select(
        F.col("conv_id").alias("base"), "place", "turn_hash", "bytes")
    given = sizes.select("conv_id", "base", "h").join(heads, "base").filter("place < h").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "turn_hash", "bytes")
    kept = own.join(sizes.select("conv_id", "h", "given"), "conv_id").filter("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("given") + 1).alias("depth"), "turn_hash", "bytes")
    return given.union(kept), sizes.select("conv_id", "len")


OP12_SQL = """
WITH turns AS (
  SELECT conv_id AS c, text, md5(concat(length(role), ':', role, text)) AS g,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, text))) - 1 AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, c - c % 5 AS b, xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')],
    lambda crc, x: list_reduce([xor(crc, x)] || [0::BIGINT FOR i IN range(8)],
      lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT c, g, strlen(text) AS bytes, row_number() OVER (PARTITION BY c ORDER BY part, p) AS depth
  FROM (SELECT convs.c, 0 AS part, p, g, text FROM convs JOIN turns t ON t.c = b AND p < h
        UNION ALL SELECT convs.c, 1, p, g, text FROM convs JOIN turns t ON t.c = convs.c AND p >= h)
), paths AS (
  SELECT c, depth, bytes, md5(string_agg(g, '') OVER (PARTITION BY c ORDER BY depth)) AS key FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), steps AS (
  SELECT *, lag(key) OVER (PARTITION BY c ORDER BY depth) AS parent, lead(key) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ending
  FROM paths
), nodes AS (
  SELECT depth, key, any_value(parent) AS parent, min(c) AS c, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ending), '')) AS ends_sha256
  FROM steps GROUP BY depth, key
), children AS (
  SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes GROUP BY ALL
), totals AS (
  -- Every node counts for the nodes on the path of its least member down to it.
  SELECT s.depth, s.key, count(*) FILTER (k.n IS NULL)::BIGINT AS n_leaves, sum((u.n_convs - 1) * u.bytes)::BIGINT AS saved_tokens
  FROM nodes u LEFT JOIN children k ON k.depth = u.depth AND k.key = u.key JOIN steps s ON s.c = u.c AND s.depth <= u.depth
  GROUP BY s.depth, s.key
)
SELECT v.c AS conv_id, v.depth, p.c AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, t.n_leaves, t.saved_tokens, v.ends_sha256
FROM nodes v JOIN totals t ON t.depth = v.depth AND t.key = v.key
LEFT JOIN children k ON k.depth = v.depth AND k.key = v.key LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.key = v.parent
"""


@query("op12_conversation_trie", OP12_SQL)
def op12(spark, sf_dir: str) -> DataFrame:
    turns, lengths = rebuilt(spark, table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return prefix_trie(spark, turns, lengths).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
