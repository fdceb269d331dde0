"""Quality rules whose cutoffs are set under a bound on false rejection.

Counts per text (repeats, symbols, shouting, equal lines) give a few ratios, each
a rule that rejects a document at or above its cutoff. The cutoffs come from a
fixed ladder. In each stratum, for each rule, the ladder is tried from the
loosest rung down on the documents labelled good, which were not used for
anything else: a rung stands if the exact binomial test refutes, at the level
left by the correction, that the rule rejects more than its share of good
documents. The tests of one rule go in a fixed order and end at the first that
does not hold, so the ladder's length costs nothing; strata and rules share the
error ``delta`` evenly (Bonferroni). With a probability of ``1 - delta``, in no
stratum do the rules together reject more than ``risk`` of the good documents.

A stratum with too few good labels to prove any rung has no cutoffs and keeps all.

Defined results: null and empty texts have zero words and ratios of zero. Null
labels are ignored; a document with several labels is good if one says so. A
null stratum is a stratum of its own. Repeated rows are judged one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.components import stored
from tidewell.llm.registry import query, table
from tidewell.llm.texts import INK, Slice, gram_hashes, map_texts, mix, run_hashes

RISK, DELTA = 0.05, 0.05
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "shouting": ("n_upper", "word_chars"),
    "equal_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
LADDER = tuple(round(0.02 * i, 2) for i in range(1, 51))
WINDOW = 8
MOST_STRATA = 10_000  # more strata than this are joined by a shuffle instead of a broadcast
COUNTS = ("n_words long, word_chars long, n_symbols long, n_upper long, n_lines long, "
          "n_dup_lines long, n_repeat_words long")

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated(words: np.ndarray, bounds: np.ndarray, window: int) -> np.ndarray:
    """Words per text that lie in a window which the text holds twice or more."""
    grams = gram_hashes(words, window)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(grams)]
    inside = np.flatnonzero(np.arange(len(grams)) + window <= bounds[text + 1])
    keys = mix(grams[inside] ^ mix(text[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    at = inside[twice]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return sums(np.cumsum(cover[:-1]) > 0, bounds)


def equal_lines(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those among them that equal an earlier one, per text."""
    starts, ends, bounds = part.lines()
    ink = np.concatenate([[0], np.cumsum(INK[part.data], dtype=np.int64)])
    worded = np.flatnonzero(ink[ends] > ink[starts])
    text = np.repeat(np.arange(len(part)), np.diff(bounds))[worded]
    lines = run_hashes(part.data, starts[worded], ends[worded])
    count = np.bincount(text, minlength=len(part))
    keys = mix(lines ^ mix(text.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    return count, count - np.bincount(text[first], minlength=len(part))


def _counts(part: Slice) -> list[np.ndarray]:
    starts, ends, bounds = part.runs(INK)
    words = run_hashes(part.data, starts, ends)
    letters = INK[part.data] & ((part.data & 0xC0) != 0x80)  # the first byte of each code point
    lines, dup_lines = equal_lines(part)
    found = [np.diff(bounds), sums(letters, part.offsets), sums(_SYMBOLS[part.data], part.offsets),
             sums(_UPPER[part.data], part.offsets), lines, dup_lines, repeated(words, bounds, WINDOW)]
    return [x.astype(np.int64) for x in found]


def counts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with the counts that the rules use."""
    return map_texts(docs, COUNTS, lambda: _counts, keep=keep)


def ratio(rule: str) -> Column:
    above, below = RULES[rule]
    return F.coalesce(F.col(above) / F.nullif(F.col(below), F.lit(0)), F.lit(0.0))


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly in blocks."""
    if k >= n:
        return 1.0
    log_term, total = n * math.log1p(-p), 0.0
    total = math.exp(log_term)
    for low in range(1, k + 1, 1 << 20):
        i = np.arange(low, min(low + (1 << 20), k + 1), dtype=np.float64)
        terms = log_term + np.cumsum(np.log((n - i + 1) / i) + math.log(p) - math.log1p(-p))
        total += float(np.exp(terms).sum())
        log_term = float(terms[-1])
    return min(1.0, total)


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA,
            ladder: tuple[float, ...] = LADDER) -> DataFrame:
    """``stratum``, ``rule``, ``cutoff`` with ``n`` good labels and ``k`` of them rejected.

    ``measured`` has ``doc_id``, the stratum and a column per rule. Only counts by
    rung leave the tasks; what is decided on has a row per stratum, rule and rung.
    """
    good = labels.filter("quality = 1").select("doc_id").distinct()
    rungs = F.array(*[F.lit(float(x)) for x in ladder])
    tried = (measured.join(good, "doc_id").select(
        F.col(stratum).alias("stratum"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])).alias("x"))
        .select("stratum", "x.rule", F.size(F.filter(rungs, lambda c: c <= F.col("x.value"))).alias("rung"))
        .groupBy("stratum", "rule", "rung").count())
    strata = tried.agg(F.expr("count(distinct coalesce(concat('=', stratum), ''))")).first()[0]
    level = delta / max(1, strata * len(RULES))
    share = risk / len(RULES)

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        total = int(group["count"].sum())
        by_rung = group.groupby("rung")["count"].sum()
        best, rejected = None, 0
        for rung in range(len(ladder), 0, -1):  # the highest cutoff first
            k = rejected + int(by_rung.get(rung, 0))
            if at_most(k, total, share) > level:
                break
            best, rejected = rung, k
        return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "rule": [group["rule"].iloc[0]],
                             "cutoff": [None if best is None else float(ladder[best - 1])],
                             "n": [total], "k": [rejected]})

    return tried.groupBy("stratum", "rule").applyInPandas(
        decide, "stratum string, rule string, cutoff double, n long, k long").filter("cutoff IS NOT NULL")


def verdicts(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str = "lang",
             risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``doc_id``, the stratum, the counts, and ``broken``: the rules that reject the row."""
    found = counts(docs, keep=["doc_id", stratum]).select(
        F.col("doc")["doc_id"].alias("doc_id"), F.col("doc")[stratum].cast("string").alias("stratum"),
        *[c.split()[0] for c in COUNTS.split(", ")])
    measured = stored(spark, found.select("*", *[ratio(r).alias(r) for r in RULES]), "quality-counts")
    by_stratum = stored(spark, cutoffs(measured, labels, "stratum", risk, delta).groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"{r}_cutoff") for r in RULES]), "quality-cutoffs")
    small = by_stratum.count() <= MOST_STRATA
    side = F.broadcast(by_stratum) if small else by_stratum
    own = side.withColumnRenamed("stratum", "of")
    broken = F.filter(F.array(*[F.when(F.col(r) >= F.col(f"{r}_cutoff"), F.lit(r)) for r in RULES]),
                      lambda r: r.isNotNull())
    return measured.join(own, F.col("stratum").eqNullSafe(F.col("of")), "left").select(
        *measured.columns, broken.alias("broken"))


OP10_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, stratum, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n
  FROM (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
        FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM split))
), repeats AS (
  SELECT r, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM windows WHERE n > 1) GROUP BY r
), counts AS (
  SELECT r, doc_id, stratum, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (r)
), measured AS (
  SELECT r, doc_id, stratum, unnest([
    {'place': 1, 'rule': 'symbols', 'value': coalesce(n_symbols / nullif(word_chars, 0), 0)},
    {'place': 2, 'rule': 'shouting', 'value': coalesce(n_upper / nullif(word_chars, 0), 0)},
    {'place': 3, 'rule': 'equal_lines', 'value': coalesce(n_dup_lines / nullif(n_lines, 0), 0)},
    {'place': 4, 'rule': 'repeats', 'value': coalesce(n_repeat_words / nullif(n_words, 0), 0)}], recursive := true)
  FROM counts
), good AS (
  SELECT stratum, rule, value FROM measured
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)
), tried AS (
  SELECT stratum, rule, rung, count(*) AS n, count(*) FILTER (value >= rung::DOUBLE / 50) AS k,
         0.05 / (4 * (SELECT count(*) FROM (SELECT DISTINCT stratum FROM good))) AS level
  FROM good, range(1, 51) t(rung) GROUP BY stratum, rule, rung
), tested AS (
  SELECT stratum, rule, rung, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.0125) + (n - i) * ln(1 - 0.0125)))) END
    <= level AS stands
  FROM tried
), cutoffs AS (
  -- The ladder is walked from the top and ends at the first rung that does not stand.
  SELECT stratum, rule, min(rung)::DOUBLE / 50 AS cutoff
  FROM (SELECT *, bool_and(stands) OVER (PARTITION BY stratum, rule ORDER BY rung DESC) AS kept FROM tested)
  WHERE kept GROUP BY stratum, rule
), broken AS (
  SELECT r, string_agg(m.rule, ',' ORDER BY place) AS rules
  FROM measured m JOIN cutoffs c ON m.rule = c.rule AND m.stratum IS NOT DISTINCT FROM c.stratum
  WHERE value >= cutoff GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND rules IS NULL AS kept, coalesce(rules, '') AS broken_rules
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM counts) LEFT JOIN broken USING (r)
"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = verdicts(spark, docs, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.size("broken") == 0)).alias("kept"),
        F.array_join("broken", ",").alias("broken_rules"))
