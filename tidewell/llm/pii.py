"""Personal data: proposed by pattern, confirmed by checksum, scored by context.

Regular expressions propose spans. Validators confirm them: digit counts, ranges,
the Luhn sum of card numbers, the mod-97 sum of account numbers. Each kind has a
base score; a context word nearby raises it, and only spans that reach
``MIN_SCORE`` are kept. The base kinds (email, ip, card, phone) stand on their own;
the added ones (iban, ssn, secret) are ``proposed`` more freely, and some need
their context.

An account number is as long as its country says, so what follows it, a bank's code
or the next column, is not read as part of it. Where the country has no length here,
or the text has no word end there, the longest run is taken instead.

The patterns are written so that they never go back over what they have read
(possessive repeats, and starts only where a run begins), so a text is read once
per kind however long its runs are. Positions count code points. Everything is a
built-in function; rows stay where they are.

Defined results: a null or empty text has no spans. Overlapping spans of
different kinds are all kept. Repeated rows are searched one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.registry import query, table

MIN_SCORE, NEAR = 0.5, 40
_STEP = 128


@dataclass(frozen=True)
class Kind:
    """``valid`` judges a matched text; ``score`` is for a span without context,
    ``more`` is added when one of the ``context`` words stands nearby. Every text with
    a valid span has a match of ``needs``, a plainer pattern that spares the others."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str = ""
    more: float = 0.0
    base: bool = False
    needs: str = ""


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits_of(text)), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        d * 2 - F.when(d > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether the letters and digits, the first four moved to the end, are 1 modulo 97."""
    plain = F.regexp_replace(text, "[^A-Z0-9]", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(
        F.when(value_of(c) > 9, a * 100 + value_of(c)).otherwise(a * 10 + value_of(c)) % 97))
    return rest == 1


def value_of(c: Column) -> Column:
    """0 to 9 for digits, 10 to 35 for letters."""
    return F.when(c < "A", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)


_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_HERE = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
#: Length of the account numbers of each country (ISO 13616).
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


_KNOWN = "|".join(rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?+[A-Z0-9]){{{size - 4}}}+(?![A-Za-z0-9])"
                  for size, names in LENGTHS.items())
ACCOUNT = (rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_KNOWN}"
           r"|[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9]))")


KINDS = (
    Kind("email", _HERE + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: F.lit(True),
         0.9, "mail|contact|write", 0.1, base=True, needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
         0.6, r"\bip\b|address|host|server", 0.3, base=True, needs=r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++",
         lambda t: F.length(digits_of(t)).between(12, 19) & luhn(t), 0.7, "card|visa|credit|payment", 0.3, base=True,
         needs=r"(?:[0-9][\x20-]?+){11}[0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.length(digits_of(t)).between(9, 15),
         0.6, r"phone|tel|call|mobile|fax", 0.3, base=True, needs=r"\+[0-9]"),
    Kind("iban", ACCOUNT, mod97, 0.8, "iban|account|konto|bank", 0.2, needs="[A-Z]{2}[0-9]{2}"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda t: F.lit(True),
         0.4, "ssn|social|security", 0.4, needs="[0-9]-[0-9]{2}-[0-9]"),
    Kind("secret", r"(?i)(?<![a-z])(?:token|secret|passw(?:or)?d|api[_-]?key)\x20?[=:]\x20?[\x22']?[a-z0-9+/_-]{16,}+",
         lambda t: F.lit(True), 0.7, "key|login|access", 0.2, needs=r"[=:]\x20?+[\x22']?+[A-Za-z0-9\u017F\u212A+/_-]{16}"),
)


def _starts(gaps: Column, sizes: Column) -> Column:
    """Start of each match, from the lengths of the texts between the matches and of
    the matches. Sums are taken in steps, so many matches cost little more each."""
    both = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, n: F.struct(g.alias("g"), n.alias("n")))
    steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _STEP).cast("int")),
                        lambda k: F.slice(both, k * _STEP + 1, F.lit(_STEP)))
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x["g"] + x["n"])
    totals = F.transform(steps, add)
    offsets = F.transform(totals, lambda t, k: F.aggregate(F.slice(totals, F.lit(1), k), F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(steps, offsets, lambda xs, o: F.transform(
        xs, lambda x, i: o + add(F.slice(xs, F.lit(1), i)) + x["g"])))


def _kind_spans(text: Column, kind: Kind, found: Column, order: int) -> Column:
    """Spans of one kind, given its matches."""
    sizes = F.transform(found, F.length)
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    spans = F.zip_with(found, _starts(gaps, sizes), lambda m, s: F.struct(s.alias("s"), m.alias("m")))
    spans = F.filter(spans, lambda x: kind.valid(x["m"]))

    def scored(x: Column) -> Column:
        start, end = x["s"], x["s"] + F.length(x["m"])
        score = F.lit(kind.score)
        if kind.context:
            before = F.substring(text, F.greatest(start - NEAR, F.lit(0)) + 1, start - F.greatest(start - NEAR, F.lit(0)))
            near = F.concat(before, F.lit("\n"), F.substring(text, end + 1, F.lit(NEAR)))
            score = score + F.when(F.lower(near).rlike(kind.context), F.lit(kind.more)).otherwise(F.lit(0.0))
        return F.struct(start.cast("long").alias("start"), F.lit(order).alias("rank"), end.cast("long").alias("end"),
                        F.lit(kind.name).alias("kind"), x["m"].alias("text"), F.round(score, 3).alias("score"))

    kept = F.transform(spans, scored)
    return kept if kind.base else F.filter(kept, lambda x: x["score"] >= MIN_SCORE)


SPAN = "array<struct<start: bigint, rank: int, `end`: bigint, kind: string, text: string, score: double>>"


def personal_data(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS,
                  keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with ``spans``: start, end, kind, text and score of
    each piece of personal data, by start and then by the order of the kinds."""
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    # Three steps, so that no search is written out more than once.
    rows = rows.select("doc", "text", *[
        F.when(F.col("text").rlike(k.needs), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)))
        .otherwise(F.array().cast("array<string>")).alias(f"m{i}") for i, k in enumerate(kinds)])
    none = F.array().cast(SPAN)
    rows = rows.select("doc", *[
        F.when(F.size(f"m{i}") > 0, _kind_spans(F.col("text"), k, F.col(f"m{i}"), i)).otherwise(none).alias(f"s{i}")
        for i, k in enumerate(kinds)])
    return rows.select("doc", F.array_sort(F.concat(*[F.col(f"s{i}") for i in range(len(kinds))])).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


_MATCHES = r"""
  SELECT r, {rank} AS rank, '{kind}' AS kind, m, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY j) - length(m) AS s
  FROM (SELECT r, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(len(ms))) AS j
        FROM (SELECT r, regexp_extract_all({text}, '{pattern}') AS ms, string_split_regex({text}, '{pattern}') AS gs
              FROM docs))
"""
# Plain patterns, without the look-around that SQL's expressions lack: a number that is
# a whole run of its characters, a key word with what stands before it, an account's start.
OP8_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), matches AS (MATCHES
), judged AS (
  SELECT r, rank, kind, s + (kind = 'secret' AND NOT regexp_matches(m, '^[a-z]'))::INTEGER AS s, s + length(m) AS z, CASE kind
      WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
                                     OR lpad(ltrim(p, '0'), 3, '0') > '255')) = 0
      WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(list_reverse(string_split(d, '')),
          lambda c, i: CASE WHEN i % 2 = 1 THEN c::INTEGER WHEN c > '4' THEN 2 * c::INTEGER - 9 ELSE 2 * c::INTEGER END)) % 10 = 0
      WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
      WHEN 'ssn' THEN regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')
        AND regexp_matches(lower(substr(text, greatest(s - 40, 0)::BIGINT + 1, least(s, 40)::BIGINT) || chr(10)
                                 || substr(text, (s + length(m) + 1)::BIGINT, 40)), 'ssn|social|security')
      ELSE kind <> 'iban' END AS good
  FROM (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM matches) JOIN docs USING (r)
), accounts AS (
  -- As long as the country says, or else the longest run.
  SELECT r, s, s + length(m) AS z, m
  FROM (SELECT r, s, text, CASE
          WHEN known <> '' AND NOT regexp_matches(substr(text, (s + length(known) + 1)::BIGINT, 1), '[A-Za-z0-9]') THEN known
          ELSE regexp_extract(substr(text, s::BIGINT + 1), '^[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}') END AS m
        FROM (SELECT r, s, text, regexp_extract(substr(text, s::BIGINT + 1), '^(KNOWN)') AS known
              FROM matches JOIN docs USING (r) WHERE kind = 'iban' AND NOT regexp_matches(substr(text, s::BIGINT, (s > 0)::BIGINT), '[A-Za-z0-9]')))
  WHERE m <> '' AND NOT regexp_matches(substr(text, (s + length(m) + 1)::BIGINT, 1), '[A-Za-z0-9]')
), apart AS (
  SELECT r, list_reduce(list({'s': s::BIGINT, 'z': z::BIGINT, 'kept': []::BIGINT[]} ORDER BY s), lambda a, x:
      CASE WHEN x.s >= a.z THEN {'s': x.s, 'z': x.z, 'kept': list_append(a.kept, x.s)} ELSE a END,
      {'s': 0::BIGINT, 'z': 0::BIGINT, 'kept': []::BIGINT[]}).kept AS kept
  FROM accounts GROUP BY r
), plain AS (
  SELECT r, s, z, regexp_replace(m, '[^A-Z0-9]', '', 'g') AS p FROM accounts JOIN apart USING (r) WHERE list_contains(kept, s::BIGINT)
), spans AS (
  SELECT r, rank, kind, s::BIGINT AS s, z::BIGINT AS z FROM judged WHERE good
  UNION ALL
  SELECT r, 4, 'iban', s::BIGINT, z::BIGINT FROM plain
  WHERE list_reduce(list_transform(string_split(array_to_string(list_transform(string_split(substr(p, 5) || substr(p, 1, 4), ''),
      lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ord(c) - 55)::VARCHAR END), ''), ''), lambda c: c::BIGINT),
      lambda a, c: (a * 10 + c) % 97) = 1
), listed AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || s || ':' || z, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || s || ':' || z, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
""".replace("MATCHES", "  UNION ALL".join(
    _MATCHES.replace("{rank}", str(rank)).replace("{kind}", kind).replace("{text}", text).replace("{pattern}", pattern)
    for rank, kind, text, pattern in (
        (0, "email", "text", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        (1, "ip", "text", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        (2, "card", "text", r"[0-9]([\x20-]?[0-9])+"),
        (3, "phone", "text", r"\+[0-9][\x20().0-9-]+[0-9]"),
        (4, "iban", "text", "[A-Z]{2}[0-9]{2}"),
        (5, "ssn", "text", "[0-9-]+"),
        (6, "secret", "low", r"(^|[^a-z])(token|secret|passw(or)?d|api[_-]?key)\x20?[=:]\x20?[\x22\x27]?[a-z0-9+/_-]{16,}"),
    ))).replace("KNOWN", "|".join(
        f"({'|'.join(names.split())})[0-9]{{2}}( ?[A-Z0-9]){{{size - 4}}}" for size, names in LENGTHS.items()))


@query("op8_pii", OP8_SQL)
def op8(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = [k.name for k in KINDS if k.base]
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        F.col("doc")["doc_id"].alias("doc_id"), *[count(n).alias(f"n_{n}") for n in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
