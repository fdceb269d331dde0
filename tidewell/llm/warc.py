"""WARC archives of web pages, and their captures in one global order.

Writing: payloads are compared by digest; of equal ones of at least
``REVISIT_BYTES`` the capture with the greatest id is stored in full and the
others become revisit records that refer to it. Each task streams its rows into
archive files of its own (one gzip member per record) in a shared folder, and the
list of files that count is written by Spark: files of a task that was lost or
repeated are in no list.

Reading: each archive is read record by record, which gives one run of captures,
sorted locally by URL key and time. The runs are then merged: the keys are cut
into ranges (by URL key, time and id, so that a URL with very many captures is
cut too), each range meets the part of every run that falls into it, and a loser
tree merges these parts. The ranges in order hold the capture history of every
URL, in order. Their number follows the number of records (``RANGE_RECORDS`` to a
range, as Spark's sample of the keys cuts them), so a range stays as large as it is.

Defined results: a null payload is empty, a null URL has an empty key. Rows with
a null id are captures like others but never stand for equal ones. Of equal
payloads every row with the greatest id is stored in full. Equal keys and times
are ordered by id, null first. No pages give no files and no rows.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.session import scratch_dir

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
RANGE_RECORDS = 500_000
SALTS = 1024
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = ("url_key string, captured long, page_id long, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string")
_ARROW = pa.schema([("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string())])


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: the host reversed, no scheme, ``www`` or fragment."""
    rest = re.sub(r"^[^:/?#]*://", "", url or "").partition("#")[0]
    host, tail = re.match(r"([^/?]*)(.*)", rest, re.S).groups()
    host = re.sub(r"^www\d*\.", "", host.lower())
    return f"{','.join(reversed(host.split('.')))}){tail or '/'}" if rest else ""


# -- records ---------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"<urn:x-capture:{'none' if page_id is None else page_id}>"


def _id(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-capture:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, captured: int, payload: bytes, digest: str,
           refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record."""
    head = HTTP % len(payload)
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", datetime.fromtimestamp(captured, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
              ("Content-Length", str(len(block)))]
    if url is not None:
        # Control characters would end the header line.
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def _header(stream: io.BufferedIOBase) -> dict[str, str]:
    """Header lines up to the empty one."""
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        key, _, value = line.decode().partition(":")
        found[key.strip().lower()] = value.strip()
    return found


class Members(io.RawIOBase):
    """The decompressed bytes of a file of gzip members."""

    def __init__(self, source: Any):
        self.source, self.inflate, self.rest = source, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while True:
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            piece = self.rest or self.source.read(1 << 16)
            if not piece:
                return 0
            out = self.inflate.decompress(piece, len(target))
            self.rest = self.inflate.unconsumed_tail
            if out:
                target[:len(out)] = out
                return len(out)


def captures(source: Any) -> Iterator[dict]:
    """The captures in an archive, one record at a time. Lengths and digests come from
    the stored payloads; a revisit has those it was written with."""
    stream = io.BufferedReader(Members(source), 1 << 16)
    while stream.readline():  # the version line
        warc = _header(stream)
        block = io.BytesIO(stream.read(int(warc["content-length"])))
        stream.readline(), stream.readline()
        block.readline()
        http = _header(block)
        payload = block.read()
        revisit = warc["warc-type"] == "revisit"
        yield {
            "url_key": url_key(warc.get("warc-target-uri")),
            "captured": int(datetime.fromisoformat(warc["warc-date"]).timestamp()),
            "page_id": _id(warc["warc-record-id"]),
            "record_type": warc["warc-type"],
            "refers_to": _id(warc.get("warc-refers-to")),
            "payload_bytes": int(http["content-length"]) if revisit else len(payload),
            "payload_digest": warc["warc-payload-digest"].partition(":")[2] if revisit
            else hashlib.sha1(payload).hexdigest(),
        }


# -- writing ---------------------------------------------------------------


def _writer(root: str, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        out, name, size, count = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]}, pa.schema(
                [("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, captured, html, digest, refers_to, revisit = (c[row].as_py() for c in batch.columns)
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, url, captured, (html or "").encode(), digest,
                                            refers_to, revisit)) + pack.flush()
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_archives(pages: DataFrame, root: str, captured: Column, page_id: str = "page_id", url: str = "url",
                   payload: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages as WARC files under ``root``; returns the list of ``file``,
    ``records`` and ``bytes``. ``captured`` is the time in seconds."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        captured.cast("long").alias("captured"), body.alias("html"), F.sha1(body).alias("digest"))
    # Copies of a page are spread by a salt. A digest has a row for each salt that occurs with
    # it, so there are never more such rows than pages, and none for a digest that occurs once.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    of_digest = Window.partitionBy("of")
    leads = (rows.filter(F.octet_length("html") >= REVISIT_BYTES)
             .groupBy(F.col("digest").alias("of"), F.col("salt").alias("part"))
             .agg(F.max("page_id").alias("most"), F.count("*").alias("n"))
             .select("of", "part", F.max("most").over(of_digest).alias("lead"), F.sum("n").over(of_digest).alias("all"))
             .filter("all > 1").drop("all"))
    revisit = F.col("lead").isNotNull() & ~F.col("lead").eqNullSafe(F.col("page_id"))
    marked = rows.join(leads, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("part")), "left").select(
        "page_id", "url", "captured", "html", "digest", F.when(revisit, F.col("lead")).alias("refers_to"),
        revisit.alias("revisit"))
    files = marked.mapInArrow(_writer(root, file_bytes), "file string, records long, bytes long")
    return stored(spark, files, "warc-files")


# -- reading and merging ---------------------------------------------------


def _order(row: dict) -> tuple:
    return (row["url_key"].encode(), row["captured"], row["page_id"] is not None, row["page_id"] or 0)


def read_runs(files: DataFrame, root: str) -> DataFrame:
    """The captures in the listed archives: each file is a ``run``, and ``place`` is a
    capture's place in it, by URL key, time and id. A run's captures (not payloads)
    are held while they are sorted; a run is one file of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{folder}/{name}", compression=None) as source:
                    rows = sorted(captures(source), key=_order)
                held = pa.RecordBatch.from_pylist(rows, _ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array(range(len(rows)), pa.int64()), *held.columns],
                    names=["run", "place", *_ARROW.names])

    spread = files.select("file").repartition(max(1, files.count()), "file")
    return spread.mapInArrow(run, f"run string, place long, {CAPTURE}")


class LoserTree:
    """Merges sorted sources: each inner node keeps the loser of its match, so the
    next row costs one match per level on the winner's way up."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * len(sources)
        for i in range(len(sources)):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x < y or (x == y and a < b))

    def _play(self, winner: int) -> None:
        node = (winner + len(self.sources)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # still filling: wait here for the opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.sources and (winner := self.losers[0]) >= 0 and self.heads[winner] is not None:
            yield self.heads[winner]
            self.heads[winner] = next(self.sources[winner], None)
            self._play(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one range, which come run by run, in one order."""
    filled = [b for b in batches if b.num_rows]
    if not filled:
        return
    held = pa.Table.from_batches(filled)
    names = held.column("run").combine_chunks()
    keys = list(zip((k.encode() for k in held.column("url_key").to_pylist()), held.column("captured").to_pylist(),
                    *zip(*((i is not None, i or 0) for i in held.column("page_id").to_pylist())),
                    range(held.num_rows)))
    edges = [0] + [i for i in range(1, len(names)) if names[i] != names[i - 1]] + [len(names)]
    tree = LoserTree([iter(keys[a:b]) for a, b in zip(edges, edges[1:])])
    order = pa.array([key[-1] for key in tree], pa.int64())
    yield from held.select(_ARROW.names).take(order).combine_chunks().to_batches(max_chunksize=10_000)


def ranges_for(files: DataFrame, range_records: int = RANGE_RECORDS) -> int:
    """How many ranges the records of the listed archives are cut into."""
    return max(1, -(-(files.agg(F.sum("records")).first()[0] or 0) // range_records))


def capture_histories(runs: DataFrame, partitions: int | None = None) -> DataFrame:
    """All captures in one order over the partitions: URL key, time, id. A partition
    holds one range of keys; ``partitions`` bounds its size (Spark's setting if unset)."""
    by = ["url_key", "captured", "page_id"]
    ranged = runs.repartitionByRange(partitions, *by) if partitions else runs.repartitionByRange(*by)
    return ranged.sortWithinPartitions("run", "place").mapInArrow(_merge, CAPTURE)


OP7_SQL = r"""
WITH hashed AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), led AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS lead FROM hashed
), keyed AS (
  SELECT *, lead IS NOT NULL AND lead IS DISTINCT FROM page_id AS revisit,
         regexp_extract(regexp_replace(array_to_string(list_transform(string_split(url, ''), lambda c:
           CASE WHEN ord(c) BETWEEN 0 AND 32 OR ord(c) = 127 THEN printf('%%%02X', ord(c)) ELSE c END), ''),
           '^[^:/?#]*://', ''), '^[^#]*') AS rest
  FROM led
), split AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS host FROM keyed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN lead END AS refers_to,
       CASE WHEN rest = '' THEN '' ELSE array_to_string(list_reverse(string_split(
           regexp_replace(lower(host), '^www[0-9]*\.', ''), '.')), ',') || ')'
         || coalesce(nullif(substr(rest, length(host) + 1), ''), '/') END AS url_key,
       1704067200 + coalesce(page_id, 0) % 1000000000 AS captured
FROM split
"""


@query("op7_warc", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = scratch_dir(spark, "warc")
    # The tables have no capture time; it follows the id.
    captured = F.lit(1_704_067_200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    files = write_archives(pages, root, captured)
    runs = stored(spark, read_runs(files, root), "warc-runs")
    return capture_histories(runs, ranges_for(files)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")
