"""Columns found in images of unknown tables."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import discover as D
from tidewell.spec import TableSpec

IMAGES = [{"id": 1, "name": "a", "pay": 1.5}, {"id": 2, "name": None, "pay": 2, "extra": {"x": 1}}, {"id": 3, "odd key's": "z", "mixed": 1},
          {"mixed": "text"}, {}, None]


def images(spark):
    texts = [json.dumps(x) for x in IMAGES] + ["{broken", None]
    return spark.createDataFrame([(t,) for t in texts], "t string").select(D.as_variant(F.col("t")).alias("v"))


def test_columns_types_and_counts(spark):
    got = {r.column: (r.type, r.n, r.n_null) for r in D.discovered_columns(images(spark), "v").collect()}
    assert got.pop("pay")[0].startswith("DECIMAL")
    assert got == {"id": ("BIGINT", 3, 0), "name": ("STRING", 2, 1), "extra": ("OBJECT<x: BIGINT>", 1, 0),
                   "odd key's": ("STRING", 1, 0), "mixed": ("VARIANT", 2, 0)}
    assert D.discovered_columns(images(spark).limit(0), "v").count() == 0


def test_values_by_name(spark):
    rows = images(spark).select(D.variant_column(F.col("v"), "id", T.LongType()).alias("id"),
                                D.variant_column(F.col("v"), "odd key's", T.StringType()).alias("odd"),
                                D.variant_column(F.col("v"), "mixed", T.IntegerType()).alias("mixed")).collect()
    assert [r.id for r in rows] == [1, 2, 3] + [None] * 5 and rows[2].odd == "z"
    assert [r.mixed for r in rows][2:4] == [1, None]


def test_drift_from_the_data(spark):
    spec = TableSpec(name="t", key=("id",), schema=T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", T.IntegerType()), T.StructField("gone", T.StringType()),
        T.StructField("pay", T.DoubleType())]))
    drift = {r.column: r.drift for r in D.drift_in_data(D.discovered_columns(images(spark), "v"), spec).collect()}
    assert drift == {"name": "retyped", "gone": "dropped", "extra": "added", "odd key's": "added", "mixed": "added"}
