"""URL filter: rules indexed by their rarest literal token.

A rule is a host (with its subdomains) and a path prefix, or a pattern with
wildcards; either way it becomes one regular expression with literal tokens that
every matching URL must contain. Each rule is filed under the token that the
fewest URLs of the table hold, counted over all of them. A URL's own tokens then
fetch the candidate rules, and only those run their expression. A token that a
wildcard touches may be part of a longer one in the URL, so each ``GRAM`` characters
of it stand for it, and a URL looks up those of its tokens too.

Of the fitting host rules the longest wins (an equal length goes to ``allow``).
URLs without one are blocked if a pattern fits, else allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path
and fits no host rule; a null URL is allowed. Rules without a whole token or
``GRAM`` literal characters in a row are tried on every URL. Repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.registry import query, table

#: The host rules of the registered query.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Patterns over the whole lower-cased URL; ``*`` stands for anything, ``^`` for a
#: character that ends a name, or the end.
PATTERNS = (
    "://*spam-farm.", "://*casino^", "://*viagra^", "://*.porn^", "://*xxx^",
    "/wp-login.php", "/adclick^", "/phishing/", "*free-download*crack^", "://*malware.",
)
#: Length of the pieces that stand for an open token; their keys begin with ``*``.
GRAM = 3
_TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Rule:
    """``name`` is null for patterns; ``tokens`` (or pieces of them) stand in every URL that fits."""

    verdict: str
    name: str | None
    expression: str
    tokens: tuple[str, ...]


def host_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """A host with its subdomains, and the start of the path (which keeps its case)."""
    # Nothing stands before the scheme's end but what holds no earlier "://".
    expression = (r"(?s)(?:(?!://).)*://(?:[^/?#]*\.)?(?ai:" + re.escape(host) + r")(?=[/?#]|\Z)" + re.escape(path))
    tokens = _TOKEN.findall(host.lower())
    # A path's last token may go on in the URL, unless something ends it.
    inner = _TOKEN.findall(_lowered(path))
    if inner and _TOKEN.match(_lowered(path[-1])):
        inner = inner[:-1]
    return Rule(verdict, host + path, expression, tuple(tokens + inner))


def pattern_rule(pattern: str) -> Rule:
    """A pattern to block. A token with an end on both sides is literal as a whole, one that
    touches ``*`` or an end of the pattern by its pieces."""
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%\x80-\U0010FFFF-]|\Z)"}
    expression = "(?s).*" + "".join(parts.get(c, re.escape(c)) for c in pattern)
    keys = []
    for m in _TOKEN.finditer(pattern):
        if m.start() and pattern[m.start() - 1] != "*" and m.end() < len(pattern) and pattern[m.end()] != "*":
            keys.append(m[0])
        else:
            keys += sorted(grams(m[0]))
    return Rule("block", None, expression, tuple(keys))


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(p) for p in PATTERNS]


def _lowered(url: str) -> str:
    return url if url.islower() else re.sub("[A-Z]", lambda m: m[0].lower(), url)


def parts(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return _lowered(host), path


def tokens(url: str) -> set[str]:
    return set(_TOKEN.findall(_lowered(url)))


def grams(token: str) -> set[str]:
    return {f"*{token[i:i + GRAM]}" for i in range(len(token) - GRAM + 1)}


def keys(url: str, open_tokens: bool) -> set[str]:
    """What rules a URL may fit are filed under."""
    found = tokens(url)
    return found.union(*map(grams, found)) if open_tokens else found


def token_counts(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[str, int]:
    """Number of URLs that hold each literal token of the rules, over all rows.
    Every task adds up its own rows; the result is as long as the token list."""
    wanted = sorted({t for r in rules for t in r.tokens})
    open_tokens = any(t[0] == "*" for t in wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for token in keys(text or "", open_tokens) & total.keys():
                    total[token] += 1
        yield pa.RecordBatch.from_pydict({"token": list(total), "n": list(total.values())},
                                         pa.schema([("token", pa.string()), ("n", pa.int64())]))

    rows = urls.select(F.col(f"`{url}`").cast("string")).mapInArrow(count, "token string, n long")
    return {r.token: r.n for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Index:
    """Rules under their rarest token; ``rest`` has none."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.filed: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.rest: list[tuple[Rule, re.Pattern]] = []
        for rule in rules:
            compiled = (rule, re.compile(rule.expression))
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
            if rarest is None:
                self.rest.append(compiled)
            else:
                self.filed.setdefault(rarest, []).append(compiled)
        self.open_tokens = any(t[0] == "*" for t in self.filed)

    def judge(self, url: str | None) -> tuple[str | None, str]:
        """The winning host rule, if any, and the verdict."""
        if url is None:
            return None, "allow"
        lowered, best, verdict = _lowered(url), None, "allow"
        held = keys(url, self.open_tokens) & self.filed.keys()
        candidates = [c for t in held for c in self.filed[t]] + self.rest
        for rule, expression in candidates:
            if rule.name is None:
                if best is None and verdict == "allow" and expression.match(lowered):
                    verdict = "block"
            elif (best is None or (len(rule.name), rule.verdict == "allow", rule.name)
                  > (len(best.name), best.verdict == "allow", best.name)) and expression.match(url):
                best = rule
        return (best.name, best.verdict) if best else (None, verdict)


def judged(pages: DataFrame, rules: Sequence[Rule] | None = None, url: str = "url",
           keep: list[str] | None = None) -> DataFrame:
    """Rows of ``pages`` as ``doc``, with ``host``, ``path``, ``rule`` and ``verdict``."""
    rules = default_rules() if rules is None else list(rules)
    counts = token_counts(pages, rules, url)
    fields = [pages.schema[c] for c in (pages.columns if keep is None else keep)]
    schema = T.StructType([T.StructField("doc", T.StructType(fields), False)])
    for name in ("host", "path", "rule", "verdict"):
        schema.add(name, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules, counts)
        for batch in batches:
            found = [(*parts(u), *index.judge(u)) for u in batch.column(1).to_pylist()]
            columns = [pa.array(c, pa.string()) for c in zip(*found)] or [pa.array([], pa.string())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                             names=["doc", "host", "path", "rule", "verdict"])

    rows = pages.select(F.struct(*[F.col(f"`{f.name}`") for f in fields]).alias("doc"),
                        F.col(f"`{url}`").cast("string").alias("url"))
    return rows.mapInArrow(run, schema)


OP4_SQL = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id, url, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), parts AS (
  SELECT page_id, path,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM split
), ruled AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN regexp_matches(low, '(?s)://.*spam-farm\.|://.*casino([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)|://.*viagra([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)'
         || '|://.*\.porn([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)|://.*xxx([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)|/wp-login\.php|/adclick([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)'
         || '|/phishing/|free-download.*crack([^A-Za-z0-9_.%\x{80}-\x{10FFFF}-]|$)|://.*malware\.') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op4_url_filter", OP4_SQL)
def op4(spark, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "pages").select("page_id", "url"), keep=["page_id"])
    return found.select(F.col("doc")["page_id"].alias("page_id"), "host", "path", "rule", "verdict")
