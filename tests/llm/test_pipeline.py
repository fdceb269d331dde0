"""The pipeline's stages, each against plain Python over its own input."""

import pytest

import corpus_pipeline as P
from test_decontaminate import brute as hits
from test_mixing import brute as mix_of, domain
from test_sharding import S
from test_simhash import fingerprint, grouped
from tidewell.llm import classifier, mixing

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, seen = docs.columns, [docs]
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
        if i < len(P.STAGES) - 1:
            assert seen[-1].columns == names
    rows = [f.collect() for f in seen]
    scores = {r.doc_id: r.score for r in classifier.scored(spark, docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {r.doc_id for r in rows[1]} == {k for k, s in scores.items() if s >= 0.3}
    ordered = sorted(rows[1], key=lambda r: r.doc_id)
    groups = grouped([fingerprint(r.text) for r in ordered])
    assert sorted(r.doc_id for r in rows[2]) == sorted({ordered[g].doc_id for g in groups})
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {x[0] for x in hits([(r.doc_id, r.text) for r in rows[2]], items) if not x[5]}
    assert {r.doc_id for r in rows[3]} == clean and len(rows[3]) < len(rows[2])
    source = [(r.doc_id, r.text, r.lang, r.source) for r in rows[3]]
    # A row's place comes from its id, its text and its other column, the length.
    lengths = {r.n_chars: r.h for r in seen[3].selectExpr("n_chars", "hex(xxhash64(n_chars)) AS h").distinct().collect()}
    want, _ = mix_of(source, mixing.Mix(), domain, lambda i: f":{lengths[rows[3][i].n_chars]}")
    counted = sorted(source[i][0] for i, c in want.items() for _ in range(c))
    assert sorted(r.doc_id for r in rows[4]) == counted
    slots = S.lookup_table()
    assert sorted(r.doc_id for r in rows[5]) == counted
    assert all(r.shard == S.SHARDS[slots[r.slot]] for r in rows[5])
    result = P.run(spark, SF)
    assert sorted(map(tuple, result.collect()), key=str) == sorted(map(tuple, rows[5]), key=str)


ROWS = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "Some words stand here.", None, "a", 3),
        (2, "Some words stand here.", None, "a", 3), (3, "long text " * 30_000, "de", None, 9)]
NAMES = ("text", "score", "slot", "shard", "fp", "rank", "domain", "copies", "doc", "spans")


@pytest.mark.parametrize("rows", [ROWS, []])
def test_odd_rows_in_every_stage(spark, rows):
    extra = ", ".join(f"{n} string" for n in NAMES[1:])
    docs = spark.createDataFrame([(*r, *["x"] * len(NAMES[1:])) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns
        got = out.collect()
        assert all(r.score == "x" and r.slot == "x" for r in got)
        assert len(got) <= 4 * len(rows) and (name != "shard" or len(got) == len(rows))
        if name == "near_duplicates" and rows:
            assert len(got) == 3
        if name == "decontaminate":
            assert len(got) == len(rows)
