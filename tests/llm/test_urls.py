"""URL rules: the index finds what trying every rule finds."""

import random

import pytest

from tidewell.llm import urls as U

SF = "/root/testdata/sf0.001"


def every_rule(url, rules):
    """The verdict without an index, by the words of the contract."""
    if url is None:
        return None, "allow"
    host, path = U.parts(url)
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    if best:
        return best
    import re
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url)
    return None, "block" if any(re.match(U.pattern_rule(x).expression, low) for x in U.PATTERNS) else "allow"


URLS = [None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "http://a.net?x", "http://a.net/?x",
        "http://example.net/en/", "http://x.Example.NET/en/a/b#c", "http://example.net/EN/", "http://notexample.net/en/",
        "https://example.com/de/1", "https://a.org/fr/", "https://a.org/fr", "https://org/fr/x://y", "x://y://net/",
        "https://spam-farm.example.org/", "http://x.com/wp-login.php?a", "http://my.casino/", "http://my.casinoé/",
        "http://a.porn:80/", "http://é.com/adclick?x", "http://a/free-download-now-crack", "HTTP://A.ORG/FR/",
        "http://user@net/", "http://net:80/", "http://e.ne\u212a/", "http://example.com/de/" + "a/" * 50_000]


def test_same_as_trying_every_rule():
    index = U.Index(U.default_rules(), {"net": 5, "en": 3, "example": 9})
    r = random.Random(3)
    pieces = ["http", "://", "net", "example", ".", "/", "en", "org", "fr", "?", "#", "com", "de", "casino", "É"]
    made = ["".join(r.choices(pieces, k=r.randint(1, 12))) for _ in range(4000)]
    for url in URLS + made:
        assert index.judge(url) == every_rule(url, U.HOST_RULES), url


def test_parts():
    assert U.parts("ht://A.É.b:1/p/Q?x#y") == ("a.É.b:1", "/p/Q")
    assert U.parts("a://b?c/d") == ("b", "") and U.parts("a:/b") == ("", "") and U.parts(None) == ("", "")


def test_rarest_token_files_the_rule():
    index = U.Index([U.host_rule("block", "example.net", "/en/")], {"net": 7, "example": 9, "en": 8})
    assert set(index.filed) == {"net"}
    assert not U.Index([U.pattern_rule("*x*")], {}).filed


def test_open_tokens_are_filed_by_their_pieces():
    index = U.Index(U.default_rules(), {})
    assert not index.rest
    assert [r.expression for r, _ in U.Index([U.pattern_rule("*xy*"), U.pattern_rule("/a/")], {}).rest] == ["(?s).*.*xy.*"]
    for url in ["http://mycasino/", "http://a.b/freexx-downloads-crack", "http://a/free-downloadable-xcrack", "http://qmalware.x",
                "http://axxx", "http://axxxb/", "http://vxspam-farm.", "http://a/%free-download", "http://éviagra?x"]:
        assert index.judge(url) == every_rule(url, U.HOST_RULES), url


def test_counts_cover_all_rows(spark):
    pages = spark.createDataFrame([("http://net/net",), ("http://a.net/",), (None,), ("x",)] * 10, "url string")
    assert U.token_counts(pages, [U.host_rule("block", "net")]) == {"net": 20}


def test_odd_rows_and_clashing_names(spark):
    frame = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)] + [(1, "", "h", "v")],
                                  "page_id long, url string, host string, verdict string")
    rows = U.judged(frame).collect()
    assert len(rows) == len(URLS) + 1 and all(r.doc.host == "h" for r in rows)
    for r in rows:
        assert (r.rule, r.verdict) == every_rule(r.doc.url, U.HOST_RULES)
    assert U.judged(frame.limit(0)).count() == 0
