"""Sets of transaction numbers as rows ``uuid``, ``low``, ``high`` (both included).

Union, intersection and difference are one sweep. An interval adds 1 at its low end
and takes 1 away behind its high end; the sums of equal places are taken first, so
neighbours that touch vanish there. Depths are prefix sums over fixed chunks of the
numbers: within a chunk by a window, from chunk to chunk over their totals. An edge
is where the rule over the depths turns true or false; edges are counted in the same
two steps, and the first two, the next two and so on are the result's intervals. So
no task holds more of a server than a chunk, and a row for each of its chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import gtid
from tidewell.operators.chunks import located

CHUNK = 1 << 20
MOST_IN_TEXT = 100_000

Rule = Callable[[Column, Column], Column]


def _sofar(rows: DataFrame, part: Sequence[str], place: str, values: Sequence[str]) -> DataFrame:
    """``<value>_before``: the sum of all rows of ``part`` at smaller places, chunk by chunk."""
    chunked = rows.withColumn("_chunk", F.floor(F.col(place) / CHUNK))
    earlier = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(*part, "_chunk").agg(*[F.sum(v).alias(v) for v in values]).select(
        *part, "_chunk", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_chunks") for v in values])
    within = Window.partitionBy(*part, "_chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (chunked.withColumns({f"_{v}_within": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
            .join(totals, [*part, "_chunk"])
            .withColumns({f"{v}_before": F.col(f"_{v}_chunks") + F.col(f"_{v}_within") for v in values})
            .drop("_chunk", *[f"_{v}_{x}" for v in values for x in ("chunks", "within")]))


def _edges(intervals: DataFrame, part: Sequence[str], left: int, right: int) -> DataFrame:
    ends = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("d")),
                             F.struct((F.col("high") + 1).alias("at"), F.lit(-1).alias("d"))))
    return intervals.filter("low <= high").select(*part, ends.alias("e")).select(
        *part, "e.at", (F.col("e.d") * left).alias("a"), (F.col("e.d") * right).alias("b"))


def combine(a: DataFrame, b: DataFrame | None, rule: Rule, part: Sequence[str] = ("uuid",)) -> DataFrame:
    """Intervals where ``rule`` holds of how many intervals of ``a`` and of ``b`` cover a number."""
    events = _edges(a, part, 1, 0)
    if b is not None:
        events = events.union(_edges(b, part, 0, 1))
    events = events.groupBy(*part, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a <> 0 OR b <> 0")
    depth = _sofar(events, part, "at", ["a", "b"])
    was = rule(F.col("a_before"), F.col("b_before"))
    now = rule(F.col("a_before") + F.col("a"), F.col("b_before") + F.col("b"))
    turns = depth.filter(was != now).select(*part, "at", F.lit(1).alias("n"))
    return (_sofar(turns, part, "at", ["n"]).groupBy(*part, F.floor(F.col("n_before") / 2).alias("_pair"))
            .agg(F.min("at").alias("low"), (F.max("at") - 1).alias("high")).drop("_pair"))


def union(a: DataFrame, b: DataFrame | None = None, part: Sequence[str] = ("uuid",)) -> DataFrame:
    """Disjoint intervals of both, none touching; of one set, its normal form."""
    return combine(a, b, lambda x, y: (x > 0) | (y > 0), part)


def intersection(a: DataFrame, b: DataFrame, part: Sequence[str] = ("uuid",)) -> DataFrame:
    return combine(a, b, lambda x, y: (x > 0) & (y > 0), part)


def difference(a: DataFrame, b: DataFrame, part: Sequence[str] = ("uuid",)) -> DataFrame:
    return combine(a, b, lambda x, y: (x > 0) & (y <= 0), part)


def seen_intervals(feed: DataFrame, group: Sequence[str] = (), gtid_col: str = "source.gtid") -> DataFrame:
    """The transactions of a feed, per ``group`` and server; records without one are left out."""
    number = gtid.id_number(F.col(gtid_col))
    rows = feed.select(*group, gtid.id_uuid(F.col(gtid_col)).alias("uuid"), number.alias("low"), number.alias("high"))
    return union(rows.filter("low IS NOT NULL"), part=[*group, "uuid"])


def sets_as_text(intervals: DataFrame, group: Sequence[str] = (), most: int = MOST_IN_TEXT) -> DataFrame:
    """``gtid_set`` per group, where no server has more than ``most`` intervals; a larger set
    fails the job, and stays rows (``covered``)."""
    text = F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.concat_ws("-", "low", "high"))
    size = F.size("i")
    fits = F.when(size > most, F.raise_error(F.lit(f"a set of more than {most} intervals is kept as rows, not as text")).cast("string"))
    # A server's list is cut off behind one interval too many, which fails the job.
    first = F.row_number().over(Window.partitionBy(*group, "uuid").orderBy("low"))
    members = intervals.withColumn("_i", first).filter(F.col("_i") <= most + 1).groupBy(*group, "uuid").agg(
        F.array_sort(F.collect_list(F.struct("low", text.alias("t")))).alias("i"))
    member = fits.otherwise(F.concat_ws(":", F.col("uuid"), F.array_join(F.transform("i", lambda x: x["t"]), ":")))
    return members.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_list(member)), ",").alias("gtid_set"))


def covered(frame: DataFrame, intervals: DataFrame, transaction: Column) -> DataFrame:
    """``frame`` with ``_covered``: whether a set of any size, given as disjoint rows, holds
    each record's transaction. Binary searches and two joins, as for snapshot chunks."""
    starts = intervals.select(F.col("uuid").alias("table"), F.col("low").alias("start"), F.lit(1).alias("chunk"),
                              F.col("high").alias("mark")).persist()
    number = gtid.id_number(transaction)
    found = located(frame, starts, gtid.id_uuid(transaction), number)
    return found.withColumn("_covered", F.coalesce(number <= F.col("_mark"), F.lit(False))).drop("_chunk", "_mark")
