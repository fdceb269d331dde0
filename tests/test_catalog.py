"""Tables of the catalog against plain Python, from this and other sessions."""

import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import brute_state, plan
from tidewell.lake.catalog import BUCKET, CatalogTable
from tidewell.session import scratch_dir
from tidewell.spec import TableSpec
from tidewell.streaming.jobs import start_upsert

SPEC = TableSpec(name="t", key=("id", "shard"), buckets=4, schema=T.StructType([
    T.StructField("shard", T.StringType()), T.StructField("id", T.LongType()), T.StructField("v", T.StringType())]))
SCHEMA = "shard string, id long, v string, seq long, _sub int, _kind string"


@pytest.fixture
def table(spark):
    made = CatalogTable(spark, f"cat_{uuid.uuid4().hex}", SPEC, scratch_dir(spark, "catalog"))
    yield made
    made.drop()


def changes(seed, n=300):
    r, out = random.Random(seed), []
    for seq in range(n):
        key = (r.choice("ab"), r.randrange(40))
        kind = r.choice(["+I", "+U", "-U", "-D"])
        out.append((*key, f"v{seq}" if r.random() < 0.9 else None, seq, r.randrange(2), kind))
    return out


def want(rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted((k[1], k[0], r["v"]) for k, r in brute_state([dict(zip(names, x)) for x in rows], ("id", "shard")).items())


def rows_of(frame):
    return sorted((r.shard, r.id, r.v) for r in frame.collect())


@pytest.mark.parametrize("seed", range(4))
def test_any_batches_compactions_and_cleanings(spark, table, seed):
    rows, r = changes(seed), random.Random(seed)
    r.shuffle(rows)  # late and early alike
    for batch in range(6):
        part = spark.createDataFrame(rows[batch * 50:batch * 50 + 50], SCHEMA)
        writer = "main" if batch % 2 else "other"
        table.append(part, batch, rebalance=batch % 3 > 0, writer=writer)
        if r.random() < 0.5:
            table.append(part, batch, writer=writer)  # once more: it replaces itself
        if r.random() < 0.6:
            before = table.read()
            table.compact()
            assert rows_of(before) == rows_of(table.read())  # a read begun before still holds
            if r.random() < 0.5:
                table.clean()
        assert rows_of(table.read()) == want(rows[:batch * 50 + 50])
    assert rows_of(spark.newSession().table(table.name)) == want(rows)
    table.compact()
    assert rows_of(spark.table(f"{table.name}_ro")) == want(rows)
    assert rows_of(CatalogTable(spark, table.name, SPEC, table.root).read()) == want(rows)


def test_folded_batches_are_neither_read_nor_written_again(spark, table):
    table.append(spark.createDataFrame(changes(1), SCHEMA), 0)
    assert table.compact() == 1 and table.compact() is None
    table.append(spark.createDataFrame(changes(2), SCHEMA), 0)
    assert table.batches() == [("main", 0)] and rows_of(table.read()) == want(changes(1))
    assert table.clean() == [("main", 0)] and table.batches() == []
    assert rows_of(table.read()) == want(changes(1)) and table.state() == (1, {"main": 0})
    table.append(spark.createDataFrame(changes(2), SCHEMA), 1)
    table.compact()
    table.clean()
    left = [x for _, _, files in os.walk(table.root.removeprefix("file:")) for x in files if x.endswith(".parquet")]
    assert not spark.catalog.tableExists(table.base_name(1)) and len(left) == len(spark.table(table.base_name(2)).inputFiles())


def test_lookup_reads_one_bucket_of_base_and_log(spark, table):
    rows = changes(5)
    table.append(spark.createDataFrame(rows[:200], SCHEMA), 0)
    table.compact()
    table.append(spark.createDataFrame(rows[200:], SCHEMA), 1)
    whole = {(s, i): v for s, i, v in want(rows)}
    for shard in "ab":
        for number in (0, 7, 39, 999):
            frame = table.lookup(id=number, shard=shard)
            assert [r.v for r in frame.collect()] == ([whole[shard, number]] if (shard, number) in whole else [])
    text = plan(table.lookup(id=999, shard="b"))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert len(filters) == 2 and all(re.search(rf"{BUCKET}#\d+ = \d", x) for x in filters)
    assert text.count("EqualTo(id,999)") == 2


def test_purge_and_deletes(spark, table):
    gone = [("a", 1, "x", 1, 0, "+I"), ("a", 1, None, 5, 0, "-D"), ("a", 2, "y", 2, 0, "+I")]
    table.append(spark.createDataFrame(gone, SCHEMA), 0)
    table.compact()
    table.append(spark.createDataFrame([("a", 1, "late", 3, 0, "+U")], SCHEMA), 1)
    assert rows_of(table.read()) == [("a", 2, "y")]
    table.compact(purge_below=6)
    assert spark.table(table.base_name(2)).count() == 1


def test_a_stream_and_what_is_refused(spark, table):
    root = scratch_dir(spark, "catalog-stream")
    rows = changes(9)
    for part in (rows[:100], rows[100:]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        start_upsert(stream, table, f"{root}/c", interval=None).awaitTermination()
    assert rows_of(table.read()) == want(rows)
    with pytest.raises(ValueError, match="lack seq"):
        table.append(spark.createDataFrame(rows, SCHEMA).drop("seq"), 99)
    with pytest.raises(ValueError):
        CatalogTable(spark, "x", TableSpec(name="t", key=("id",), schema=SPEC.schema, partitioned_by=("v",)), root)
    assert rows_of(spark.sql(f"SELECT * FROM {table.name} WHERE id < 5")) == [x for x in want(rows) if x[1] < 5]
    assert table.read(["v"]).columns == ["v"] and table.read().filter(F.col("id") < 0).count() == 0
