"""Spans against the contract's expressions in Python."""

import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import plan
from tidewell.llm import pii as P

SF = "/root/testdata/sf0.001"


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(digits(text))):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


CHECKS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and luhn(t)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
)


def base(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, pattern, good) in enumerate(CHECKS)
             for m in re.finditer(pattern, text or "") if good(m[0])]
    return [(k, a, z) for a, _, z, k in sorted(found)]


def test_query_is_the_brute_force_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = P.op8(spark, SF).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
    for r in rows:
        spans = base(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in spans) for n, _, _ in CHECKS]


def spans_of(spark, texts):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = sorted(P.personal_data(frame).collect(), key=lambda r: r.doc.doc_id)
    assert len(rows) == len(texts) and all(r.doc.spans == "x" for r in rows)
    return [r.spans for r in rows]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text("aA1234567890.@+-_% ()é😀", max_size=60), min_size=300, max_size=300))
def test_any_text(spark, texts):
    for text, spans in zip(texts, spans_of(spark, texts)):
        assert [(s.kind, s.start, s.end) for s in spans if s.kind in dict(enumerate(c[0] for c in CHECKS)).values()] == base(text)
        assert all(text[s.start:s.end] == s.text for s in spans)


LONG = ["a" * 100_000 + "@b.c", "1" * 100_000, "1 " * 60_000, "+1" + " " * 100_000, "+1" * 50_000, "1.2.3.4 " * 3000,
        "a@b.c_d@e.f " * 4000, "." * 100_000, "é4111111111111111 " * 1500, "a@b" + ".c" * 50_000]


def test_very_long_texts(spark):
    for text, spans in zip(LONG, spans_of(spark, LONG)):
        assert [(s.kind, s.start, s.end) for s in spans if s.kind in ("email", "ip", "card", "phone")] == base(text)


def test_odd_rows(spark):
    texts = [None, "", "x@y.z_w@v.u", "1.2.3.4.5.6.7.8", "0.0.0.00256", "256.1.1.1 1.1.1.0255", "4111-1111 1111 1111", "+1 (017) 555-7713."]
    for text, spans in zip(texts, spans_of(spark, texts)):
        assert [(s.kind, s.start, s.end) for s in spans] == base(text)
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert P.personal_data(frame).count() == 0


def test_added_kinds_and_context(spark):
    texts = ["my iban DE89 3704 0044 0532 0130 00 ok", "DE89370400440532013001", "GB82WEST12345698765432",
             "ssn 123-45-6789", "code 123-45-6789", 'api_key = "abcdef0123456789abcdef"', "mail me: a@b.cd", "a@b.cd"]
    got = [[(s.kind, s.text, s.score) for s in spans] for spans in spans_of(spark, texts)]
    kinds = [[k for k, _, _ in x if k in ("iban", "ssn", "secret", "email")] for x in got]
    assert kinds == [["iban"], [], ["iban"], ["ssn"], [], ["secret"], ["email"], ["email"]]
    assert got[0][0][1:] == ("DE89 3704 0044 0532 0130 00", 1.0)
    assert got[6][0][2] > got[7][0][2]


def test_no_python_and_no_move(spark):
    text = plan(P.op8(spark, SF))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


NUMBERS = [
    ("IBAN DE89370400440532013000 BIC COBADEFFXXX", ["DE89370400440532013000"]),
    ("GB82WEST12345698765432 TODAY", ["GB82WEST12345698765432"]),
    ("PAY NL91ABNA0417164300 AND DE89 3704 0044 0532 0130 00 NOW", ["NL91ABNA0417164300", "DE89 3704 0044 0532 0130 00"]),
    ("DE89370400440532013000 GB82WEST12345698765432 17 4", ["DE89370400440532013000", "GB82WEST12345698765432"]),
    ("DE89370400440532013001 GB82WEST12345698765432 X1", ["GB82WEST12345698765432"]),
    ("NO9386011117947 2024 12 31", ["NO9386011117947"]),
    ("DE89370400440532013000X", []), ("xDE89370400440532013000 BIC", []), ("DE8937040044053201300 BIC", []),
]


def test_numbers_before_capitals_and_digits(spark, tmp_path):
    texts = [t for t, _ in NUMBERS]
    accounts = [[s.text for s in spans if s.kind == "iban"] for spans in spans_of(spark, texts)]
    assert accounts == [want for _, want in NUMBERS]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.spans for r in P.op8(spark, str(tmp_path)).collect()}
    for i, (text, want) in enumerate(NUMBERS):
        assert [x for x in rows[i].split(",") if x.startswith("iban")] == [
            f"iban:{text.index(w)}:{text.index(w) + len(w)}" for w in want]


@pytest.mark.parametrize("text,want", [
    ("GB82 WEST 1234 5698 7654 32 Hello", "GB82 WEST 1234 5698 7654 32"), ("IBAN DE89370400440532013000 Hello", "DE89370400440532013000"),
    ("Pay to GB82 WEST 1234 5698 7654 32 Thank you", "GB82 WEST 1234 5698 7654 32"), ("NL91ABNA0417164300 Bank", "NL91ABNA0417164300")])
def test_a_number_before_a_name(spark, tmp_path, text, want):
    """Operator, query and SQL find a number whatever word follows it."""
    assert [s.text for s in spans_of(spark, [text])[0]] == [want]
    at = text.index(want)
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = P.op8(spark, str(tmp_path)).first()
    assert row.spans == f"iban:{at}:{at + len(want)}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert con.execute(f"SELECT spans FROM ({P.OP8_SQL})").fetchall() == [(row.spans,)]


def test_a_text_spared_has_no_match():
    """What a kind needs is in every text that its pattern matches, for random texts of its characters."""
    r = random.Random(8)
    parts = ["4111 1111 1111 1111", "a@b.c", "1.2.3.4", "+1 (555) 010-9999", "123-45-6789", "DE89 3704 0044 0532 0130 00",
             "api_key: 'abcdef0123456789", "TOKEN=abcdef0123456789xyz", "5", "-", " ", ".", "+", "AB12", "x"]
    texts = ["".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(500)]
    for k in P.KINDS:
        for text in texts:
            valid = re.search(k.pattern.replace(r"\G", "^"), text)
            if valid and (k.name not in ("card",) or len(re.sub("[^0-9]", "", valid[0])) >= 12):
                assert re.search(k.needs, text), (k.name, text)


def test_every_country_has_one_length():
    names = [c for x in P.LENGTHS.values() for c in x.split()]
    assert len(names) == len(set(names)) and all(15 <= n <= 34 for n in P.LENGTHS)
