"""Archives: round trip, revisits, and one order over all runs."""

import hashlib
import io
import random
import zlib

from pyspark.sql import functions as F
import pytest

from tidewell.llm import warc as X
from tidewell.session import scratch_dir

SF = "/root/testdata/sf0.001"


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    lead = {}
    for r in pages.values():
        body = (r.html or "").encode()
        if len(body) >= 1000:
            digest = hashlib.sha1(body).hexdigest()
            lead[digest] = max(lead.get(digest, -1), r.page_id)
    rows = X.op7(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = (pages[r.page_id].html or "").encode()
        digest = hashlib.sha1(body).hexdigest()
        first = lead.get(digest, r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(body), digest)
        assert (r.record_type, r.refers_to) == (("response", None) if first == r.page_id else ("revisit", first))
        assert r.url_key == X.url_key(pages[r.page_id].url)
    keys = [(r.url_key.encode(), r.captured, r.page_id) for r in rows]
    assert keys == sorted(keys)


def test_records_round_trip():
    r = random.Random(2)
    wanted, out = [], b""
    for i in range(60):
        payload = r.choice([b"", b"\r\n\r\nWARC/1.1\r\n", "é😀".encode() * 300, bytes(r.randrange(256) for _ in range(200_000))])
        digest = hashlib.sha1(payload).hexdigest()
        revisit, page = r.random() < 0.3, r.choice([None, -5, i])
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += pack.compress(X.record(page, r.choice([None, "http://a.b/ c\r\nX: y"]), 1_700_000_000 + i, payload, digest, 9 if revisit else None, revisit)) + pack.flush()
        wanted.append((page, 1_700_000_000 + i, "revisit" if revisit else "response", 9 if revisit else None, len(payload), digest))
    got = [(c["page_id"], c["captured"], c["record_type"], c["refers_to"], c["payload_bytes"], c["payload_digest"])
           for c in X.captures(io.BytesIO(out))]
    assert got == wanted


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(count):
    r = random.Random(count)
    runs = [sorted((r.randrange(20), i) for _ in range(r.randrange(0, 30))) for i in range(count)]
    assert list(X.LoserTree([iter(x) for x in runs])) == sorted(x for run in runs for x in run)


def test_url_key():
    assert X.url_key("https://www.A.example.com/x?y#z") == "com,example,a)/x?y"
    assert X.url_key("http://b.org") == "org,b)/" and X.url_key(None) == X.url_key("") == ""


def test_odd_rows_and_many_small_files(spark):
    big = "x" * 1000
    rows = [(1, "http://a", big), (2, "http://a", big), (2, "http://b", big), (None, None, big), (3, "", None), (4, "u", ""),
            (5, "http://a\r\nWARC-Type: x", "x" * 999), (6, "http://z", "x" * 999), (None, "http://q", "y" * 2000),
            (None, "http://q", "y" * 2000), (7, "http://l", "long " * 400_000), (8, "http://é/", "é" * 500), (9, "http://h", "é" * 500)]
    pages = spark.createDataFrame([(*x, "c") for x in rows], "page_id long, url string, html string, captured string")
    root = scratch_dir(spark, "warc-test")
    files = X.write_archives(pages.repartition(3), root, F.lit(5), file_bytes=1)
    assert files.count() == len(rows) and files.agg(F.sum("records")).first()[0] == len(rows)
    got = X.capture_histories(X.read_runs(files, root), 4).collect()
    keys = [(r.url_key.encode(), r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    found = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=str)
    want = [(1, "revisit", 2, 1000), (2, "response", None, 1000), (2, "response", None, 1000), (None, "revisit", 2, 1000),
            (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 999), (6, "response", None, 999),
            (None, "response", None, 2000), (None, "response", None, 2000), (7, "response", None, 2_000_000),
            (8, "revisit", 9, 1000), (9, "response", None, 1000)]
    assert found == sorted(want, key=str)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    root = scratch_dir(spark, "warc-test")
    files = X.write_archives(pages, root, F.lit(0))
    assert files.count() == 0
    assert X.capture_histories(X.read_runs(files, root)).count() == 0


def test_ranges_follow_the_records(spark):
    files = spark.range(100).selectExpr("10000L AS records")
    assert X.ranges_for(files) == 2 and X.ranges_for(files.union(files).union(files)) == 6
    assert X.ranges_for(files, 1000) == 1000 and X.ranges_for(files.limit(0)) == 1


def test_many_copies_are_spread_over_tasks(spark):
    pages = spark.range(5000).selectExpr("id AS page_id", "'http://a' AS url", "repeat('x', 1000) AS html")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        root = scratch_dir(spark, "warc-test")
        files = X.write_archives(pages, root, F.lit(5))
        assert max(r.records for r in files.collect()) < 5000 / 8 * 2
        got = X.capture_histories(X.read_runs(files, root), 3).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {
        *((i, "revisit", 4999) for i in range(4999)), (4999, "response", None)}
