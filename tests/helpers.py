"""Small helpers shared by the tests."""

from pyspark.sql import functions as F


def values(spark, expression, data, schema):
    """The expression evaluated over one column ``v`` of Python values, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {schema}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def brute_state(changes, keys):
    """Newest version per key in plain Python; rows are dicts with seq, _sub and _kind."""
    newest = {}
    for row in changes:
        if row["_kind"] == "-U":
            continue
        key = tuple(row[k] for k in keys)
        if key not in newest or (row["seq"], row["_sub"]) > (newest[key]["seq"], newest[key]["_sub"]):
            newest[key] = row
    return {k: r for k, r in newest.items() if r["_kind"] in ("+I", "+U")}
