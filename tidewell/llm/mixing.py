"""Mixing sources to target weights, by hierarchical budgets.

The leaves of a tree domain - language - source hold the documents. A node's
budget of tokens is shared among its children by weight. A child whose documents
(each used up to ``max_epochs`` times) cannot fill its share gets what it can
use, and its siblings share the rest by weight; only when all of them are full
does the rest go back to the node's own siblings. That is what filling each
level to a common level of ``tokens per weight`` gives, from the root down, with
the capacities added up from the leaves. All of it is integer arithmetic on a
table with one row per leaf.

Within a leaf, whole epochs take every document; of the next epoch a prefix is
taken, in an order seeded by the epoch, as long as its tokens fit. A row's place comes
from its id and its text, and from its other columns where it has any; so only rows
that are equal in all of them share one, and of those as many are taken as fit. The
prefix ends at one value per leaf. It is found without sorting a leaf: tokens are added up
per leaf and slice of the order (1,024 of them), then within the slice in which the
budget ends (1,024 again), and only the part left is looked at by value. A leaf that holds most rows is spread like any
other, and each row is then decided on by a comparison with its leaf's value.

Defined results: a null or empty text has no tokens, costs nothing, and is in
whenever its place in the order is. Null names of nodes count as the empty name.
Names without a weight have weight 1; weight 0 takes nothing. A null id is like an
empty one: such rows are told apart by their text. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table

WORDS = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "language", "source")
BITS, STEPS = 60, (50, 40, 0)
MOST_LEAVES = 50_000  # more leaves than this are joined by a shuffle instead of a broadcast


@dataclass(frozen=True)
class Mix:
    """Weights of the nodes by name, and how many tokens to take: ``percent`` of all."""

    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"web": 5, "books": 3, "news": 2},
        "language": {"en": 4, "de": 2, "es": 2, "fr": 2},
        "source": {},
    })
    percent: int = 60
    max_epochs: int = 4
    seed: int = 1


def number(text: Column) -> Column:
    """60 bits of a hash; the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def domain_of(source: Column) -> Column:
    """The registered query's domains: sources are dealt to three of them."""
    at = (number(F.coalesce(source, F.lit(""))) % 3).cast("int")
    return F.get(F.array(F.lit("web"), F.lit("books"), F.lit("news")), at)


def _weight(mix: Mix, level: str) -> Column:
    given = mix.weights.get(level, {})
    weight = F.lit(1)
    if given:
        pairs = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
        weight = F.coalesce(pairs[F.col(level)], F.lit(1))
    return weight.cast("decimal(38,0)")


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``budget`` of each child, from ``weight``, ``cap`` and the parent's ``given``."""
    over = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    ordered = over.orderBy("ratio", name)
    sofar = ordered.rowsBetween(W.unboundedPreceding, 0)
    after = F.sum("weight").over(over) - F.sum("weight").over(sofar)
    ranked = children.withColumn("ratio", F.when(
        F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double")).otherwise(F.lit(0.0)))
    # A child is full if all up to it fit and the rest can be as full as it is.
    full = ranked.withColumn("full", F.col("weight") * (F.col("given") - F.sum("cap").over(sofar))
                             >= F.col("cap") * after)
    left = F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(over)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(over)
    return full.select("*", left.alias("left"), open_weight.alias("open_weight")).select(
        *parent, name, F.when(F.col("full"), F.col("cap")).otherwise(
            F.expr("(weight * left) div nullif(open_weight, 0)").cast("decimal(38,0)")).alias("budget"))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``budget``, whole ``epochs`` and the ``rest`` in tokens, per leaf of ``leaves``
    (the three levels and ``tokens``)."""
    whole = F.lit(1).cast("decimal(38,0)")
    caps = leaves.select(*LEVELS, "tokens", (F.col("tokens").cast("decimal(38,0)") * mix.max_epochs).alias("cap"))
    for level in LEVELS:
        whole = whole * F.when(_weight(mix, level) > 0, F.lit(1)).otherwise(F.lit(0))
    caps = caps.withColumn("cap", F.when(whole > 0, F.col("cap")).otherwise(F.lit(0)).cast("decimal(38,0)"))
    total = caps.agg(F.sum("tokens").cast("decimal(38,0)").alias("all"), F.sum("cap").alias("cap")).select(
        F.least(F.expr(f"(all * {mix.percent}) div 100").cast("decimal(38,0)"), F.col("cap")).alias("given"))
    given = total
    for depth, level in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        children = (caps.groupBy(*parent, level).agg(F.sum("cap").cast("decimal(38,0)").alias("cap"))
                    .withColumn("weight", _weight(mix, level)))
        # The first level meets one row; the others their parents' budgets.
        joined = children.join(given, parent) if parent else children.join(F.broadcast(given))
        given = _share(joined, parent, level).withColumnRenamed("budget", "given")
    done = caps.join(given, list(LEVELS))
    return done.select(
        *LEVELS, "tokens", F.col("given").cast("bigint").alias("budget"),
        F.coalesce(F.expr("given div nullif(cast(tokens as decimal(38,0)), 0)"), F.lit(0)).cast("int").alias("epochs")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def identity(docs: DataFrame, doc_id: str, text: str, names: list[str]) -> Column:
    """What tells a row from others of its leaf; ``names`` are the leaf's columns."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    own = F.concat(empty(doc_id), F.lit(":"), F.md5(empty(text)))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text, *names)]
    return F.concat(own, F.lit(":"), F.hex(F.xxhash64(*others))) if others else own


def order_value(mix: Mix, own: Column, epoch: Column) -> Column:
    """A row's place in an epoch's order."""
    return number(F.concat(F.lit(f"{mix.seed}:"), epoch.cast("string"), F.lit(":"), own))


def _small(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= MOST_LEAVES else leaves


def plan(spark: SparkSession, docs: DataFrame, domain: Column, mix: Mix, text: str = "text",
         language: str = "lang", source: str = "source", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """What is taken of each leaf (``epochs`` and, of the next one, order values up to
    ``upto``, and of the equal rows at ``edge`` as many as ``fit``), and the stored sizes:
    doc_id, ``own``, the levels and ``tokens`` of every row."""
    names = [F.coalesce(x.cast("string"), F.lit("")).alias(n)
             for x, n in zip((domain, F.col(language), F.col(source)), LEVELS)]
    sizes = stored(spark, docs.select(
        F.col(doc_id).alias("doc_id"), identity(docs, doc_id, text, [language, source]).alias("own"), *names,
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint").alias("tokens")), "mixing-sizes")
    leaves = stored(spark, budgets(sizes.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), mix),
                    "mixing-budgets")
    leaf = W.partitionBy(*LEVELS)
    ends = leaves.filter("rest > 0").select(*LEVELS, "epochs", "rest", F.lit(0).cast("bigint").alias("slice"),
                                            F.lit(0).cast("bigint").alias("before"))
    upto, above = None, BITS
    for below in STEPS:
        # Of each leaf only the slice that holds the end is divided further.
        placed = (sizes.join(_small(ends), list(LEVELS))
                  .withColumn("at", order_value(mix, F.col("own"), F.col("epochs")))
                  .filter(F.shiftright("at", above) == F.col("slice")))
        held = (placed.withColumn("slice", F.shiftright("at", below))
                .groupBy(*LEVELS, "epochs", "rest", "before", "slice").agg(F.sum("tokens").alias("n"), F.count("*").alias("m")))
        used = held.withColumn("used", F.col("before") + F.sum("n").over(
            leaf.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)))
        if below:
            ends = stored(spark, used.filter("used - n <= rest AND used > rest").select(
                *LEVELS, "epochs", "rest", "slice", (F.col("used") - F.col("n")).alias("before")), "mixing-ends")
            above = below
        else:
            upto = used.groupBy(*LEVELS).agg(
                F.max(F.when(F.col("used") <= F.col("rest"), F.col("slice"))).alias("last"),
                F.min(F.when(F.col("used") > F.col("rest"), F.struct(
                    "slice", F.expr("((rest - used + n) * m) div n").alias("fit")))).alias("cut"))
    ends = ends.select(*LEVELS, "slice")
    taken = (leaves.join(ends, list(LEVELS), "left").join(upto, list(LEVELS), "left")
             .select(*LEVELS, "tokens", "budget", "epochs", F.col("cut.slice").alias("edge"), F.col("cut.fit").alias("fit"), F.when(F.col("rest") <= 0, F.lit(-1)).otherwise(
                 F.coalesce("last", F.shiftleft("slice", above) - 1, F.lit(1 << BITS))).alias("upto")))
    return stored(spark, taken, "mixing-taken"), sizes


def copies(mix: Mix, own: Column) -> Column:
    """How often a row is used, where its leaf's ``epochs`` and ``upto`` stand beside it."""
    return (F.col("epochs") + (order_value(mix, own, F.col("epochs")) <= F.col("upto")).cast("int"))


def of_equal_rows(rows: DataFrame, taken: DataFrame, mix: Mix, columns: list[str]) -> DataFrame:
    """One of the equal rows in which a leaf's prefix ends, with ``fit``: how many of them
    are used once more. Most leaves have no such rows."""
    ends = taken.filter("fit > 0").select(*LEVELS, "epochs", "edge", "fit")
    there = rows.join(_small(ends), list(LEVELS)).filter(order_value(mix, F.col("own"), F.col("epochs")) == F.col("edge"))
    return there.groupBy(*LEVELS, "fit").agg(F.first(F.struct(*columns)).alias("row")).select(*LEVELS, "fit", "row.*")


def mixed(docs: DataFrame, domain: Column | None = None, mix: Mix = Mix()) -> DataFrame:
    """The documents taken, once for each epoch that uses them, with their own columns."""
    spark = docs.sparkSession
    domain = domain_of(F.col("source")) if domain is None else domain
    taken, _ = plan(spark, docs, domain, mix)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       identity(docs, "doc_id", "text", ["lang", "source"]).alias("own"), *[
        F.coalesce(x.cast("string"), F.lit("")).alias(n)
        for x, n in zip((domain, F.col("lang"), F.col("source")), LEVELS)])
    used = rows.join(_small(taken), list(LEVELS)).withColumn("copies", copies(mix, F.col("own")))
    again = used.filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), "copies")).alias("epoch"))
    # Many equal rows are written by many tasks.
    more = (of_equal_rows(rows, taken, mix, ["doc"])
            .select("doc", "fit", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(fit - 1) div 1000"))).alias("part"))
            .repartition("part")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(1000), F.col("fit") - F.col("part") * 1000))).alias("epoch")))
    return again.select("doc").union(more.select("doc")).select(*[F.col("doc")[c].alias(c) for c in docs.columns])


OP1_SQL = r"""
WITH sizes AS (
  SELECT doc_id, ['web', 'books', 'news'][('0x' || substr(md5(coalesce(source, '')), 1, 15))::BIGINT % 3 + 1] AS domain,
         coalesce(lang, '') AS language, coalesce(source, '') AS source,
         coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS own,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::HUGEINT AS tokens
  FROM documents
), leaves AS (
  SELECT domain, language, source, sum(tokens)::HUGEINT AS tokens, (4 * sum(tokens))::HUGEINT AS cap,
         CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END::HUGEINT AS dw,
         CASE language WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'es' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::HUGEINT AS lw
  FROM sizes GROUP BY domain, language, source
), root AS (
  SELECT least(sum(tokens)::HUGEINT * 60 // 100, sum(cap)::HUGEINT)::HUGEINT AS given FROM leaves
), d1 AS (
  SELECT *, sum(cap) OVER u::HUGEINT AS c, (sum(w) OVER () - sum(w) OVER u)::HUGEINT AS wa
  FROM (SELECT domain, any_value(dw) AS w, sum(cap)::HUGEINT AS cap, any_value(given) AS given
        FROM leaves, root GROUP BY domain)
  WINDOW u AS (ORDER BY cap::DOUBLE / w::DOUBLE, domain ROWS UNBOUNDED PRECEDING)
), d2 AS (SELECT *, w * (given - c) >= cap * wa AS sat FROM d1
), d AS (
  SELECT domain, CASE WHEN sat THEN cap ELSE
      w * (given - coalesce(sum(cap) FILTER (sat) OVER (), 0)::HUGEINT) // (sum(w) FILTER (NOT sat) OVER ())::HUGEINT END AS given
  FROM d2
), l1 AS (
  SELECT *, sum(cap) OVER u::HUGEINT AS c,
         (sum(w) OVER (PARTITION BY domain) - sum(w) OVER u)::HUGEINT AS wa
  FROM (SELECT domain, language, any_value(lw) AS w, sum(cap)::HUGEINT AS cap, any_value(d.given) AS given
        FROM leaves JOIN d USING (domain) GROUP BY domain, language)
  WINDOW u AS (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE, language ROWS UNBOUNDED PRECEDING)
), l2 AS (SELECT *, w * (given - c) >= cap * wa AS sat FROM l1
), l AS (
  SELECT domain, language, CASE WHEN sat THEN cap ELSE
      w * (given - coalesce(sum(cap) FILTER (sat) OVER p, 0)::HUGEINT) // (sum(w) FILTER (NOT sat) OVER p)::HUGEINT END AS given
  FROM l2 WINDOW p AS (PARTITION BY domain, 1)
), s1 AS (
  SELECT *, sum(cap) OVER u::HUGEINT AS c,
         (count(*) OVER (PARTITION BY domain, language) - count(*) OVER u)::HUGEINT AS wa
  FROM (SELECT leaves.*, l.given FROM leaves JOIN l USING (domain, language))
  WINDOW u AS (PARTITION BY domain, language ORDER BY cap::DOUBLE, source ROWS UNBOUNDED PRECEDING)
), s2 AS (SELECT *, given - c >= cap * wa AS sat FROM s1
), s AS (
  SELECT domain, language, source, tokens, CASE WHEN sat THEN cap ELSE
      (given - coalesce(sum(cap) FILTER (sat) OVER p, 0)::HUGEINT) // (count(*) FILTER (NOT sat) OVER p)::HUGEINT END AS budget
  FROM s2 WINDOW p AS (PARTITION BY domain, language)
), placed AS (
  SELECT sizes.*, s.budget, CASE WHEN s.tokens > 0 THEN s.budget // s.tokens ELSE 0 END AS epochs, s.tokens AS total
  FROM sizes JOIN s USING (domain, language, source)
), ordered AS (
  SELECT *, ('0x' || substr(md5('1:' || epochs || ':' || own), 1, 15))::BIGINT AS place,
         budget - epochs * total AS rest
  FROM placed
), cut AS (
  SELECT *, sum(tokens) OVER (w RANGE UNBOUNDED PRECEDING) <= rest AND rest > 0 AS whole,
         sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) <= rest AND rest > 0 AS fits
  FROM ordered WINDOW w AS (PARTITION BY domain, language, source ORDER BY place)
)
SELECT doc_id, domain, language, source, tokens::BIGINT AS tokens, (epochs + whole::INTEGER)::BIGINT AS copies
FROM cut WHERE epochs + whole::INTEGER > 0
UNION ALL
-- Of equal rows that do not all fit, one more row says how many do.
SELECT any_value(doc_id), domain, language, source, any_value(tokens)::BIGINT, count(*) FILTER (fits)
FROM cut WHERE tokens > 0 GROUP BY domain, language, source, place HAVING NOT bool_and(whole) AND bool_or(fits)
"""


@query("op1_mixing", OP1_SQL)
def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mix = Mix()
    taken, sizes = plan(spark, docs, domain_of(F.col("source")), mix)
    leaf = taken.drop("tokens", "budget")
    used = sizes.join(_small(leaf), list(LEVELS)).withColumn("copies", copies(mix, F.col("own")).cast("long"))
    columns = ["doc_id", *LEVELS, "tokens", "copies"]
    more = of_equal_rows(sizes, leaf, mix, ["doc_id", "tokens"]).withColumnRenamed("fit", "copies")
    return used.filter("copies > 0").select(columns).union(more.select(columns))
