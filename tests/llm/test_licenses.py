"""License scan against trying every template on every run of words."""

import math
import random
import re

import pytest

from tidewell.llm import licenses as L

SF = "/root/testdata/sf0.001"


def words(text):
    return [w.decode() for w in L.words_of(text or "")]


def brute(text, templates=L.TEMPLATES, phrases=L.PHRASES, threshold=L.THRESHOLD, deciding=L.DECIDING, ruled_out=L.RULED_OUT):
    """Words, places of the phrases, and the most that any run holds of each template it is found by."""
    w = words(text)
    places = sorted((i, label) for phrase, label in phrases for i in range(len(w))
                    if w[i:i + len(phrase.split())] == phrase.split())
    best = {}
    for number, (label, template) in enumerate(templates):
        own = set(words(template))
        wide = math.ceil(len(words(template)) / threshold - 1e-9)
        sure = set(words(" ".join(deciding.get(label, ())))) & own
        bad = set(words(" ".join(ruled_out.get(label, ())))) - own
        for i in range(len(w) if own <= set(w) or len(own & set(w)) >= threshold * len(own) - 1e-9 else 0):
            end = next((j for j in range(i, min(len(w), i + wide)) if w[j] in bad), i + wide)
            share = len(own & set(w[i:end])) / len(own) if own and sure <= set(w[i:end]) else 0
            if share and share >= threshold - 1e-9:
                best[number] = max(best.get(number, 0), round(share, 9))
    found = {}
    for number, share in best.items():
        found[templates[number][0]] = max(found.get(templates[number][0], 0), share)
    return len(w), places, found


def found(blocks):
    most = {}
    for b in blocks:
        most[b.label] = max(most.get(b.label, 0), round(b.containment, 9))
    return most


def got(rows):
    return [(r.n_words, sorted((p.word, p.label) for p in r.places), found(r.blocks)) for r in rows]


def test_query_is_the_brute_force_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = L.op9(spark, SF).collect()
    assert len(rows) == len(docs) and any(r.labels for r in rows)
    for r in rows:
        n, places, blocks = brute(docs[r.doc_id])
        base = sorted({label for _, label in places})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (
            n, len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(base), ",".join(sorted({*base, *blocks})))
        assert r.score == pytest.approx(1.0 if places else max(blocks.values(), default=0.0))


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_no_pair_is_missed(spark, threshold):
    r = random.Random(int(threshold * 10))
    letters = "abcdefghijkl"
    templates = [(f"t{i}", " ".join(r.choices(letters, k=r.randint(1, 9)))) for i in range(12)] + [("none", "..")]
    texts = ["\n".join(" ".join(r.choices(letters + "xyz", k=r.randint(0, 9))) for _ in range(r.randint(1, 5)))
             for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    limits = ({"t3": ("a",), "t5": ("b", "c")}, {"t3": ("d", "x"), "t7": ("y", "a")})
    rows = sorted(L.scan(docs, templates, (), threshold, None, *limits).collect(), key=lambda x: x.doc.doc_id)
    assert got(rows) == [brute(t, templates, (), threshold, *limits) for t in texts]
    for r, text in zip(rows, texts):  # what is told holds what is said of it
        for b in r.blocks:
            own = set(words(dict(templates)[b.label]))
            assert len(own & set(words(text)[b.word:b.word + b.words])) == round(b.containment * len(own))


def test_counts_are_of_documents(spark):
    docs = spark.createDataFrame([("mit mit\nMIT",), ("released",), (None,), ("",), ("mit",)], "text string").repartition(4)
    counts = L.document_counts(docs, [("mit", "Released MIT license")])
    assert counts == {b"mit": 2, b"released": 1, b"license": 0}


def test_odd_rows_and_clashing_names(spark):
    long = "filler " * 50_000 + "\nReleased under the MIT License.\nCC-by all rights\nreserved"
    rows = [(1, None), (2, ""), (None, "ALL RIGHTS, RESERVED"), (3, long), (3, long), (4, "cc"), (5, "by x")]
    docs = spark.createDataFrame([(*x, "p", "b") for x in rows], "doc_id long, text string, places string, blocks string")
    found = L.scan(docs).collect()
    assert got(found) == [brute(t) for _, t in rows] and all(r.doc.places == "p" for r in found)
    assert L.scan(docs.limit(0)).count() == 0
    assert re.search("Exchange", L.scan(docs)._jdf.queryExecution().executedPlan().toString()) is None


MIT = """MIT License

Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
LESSER = GPL.replace("General", "Lesser General").replace("program", "library")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
NAMED = [
    ("mit", MIT), ("gpl-3.0", GPL), ("lgpl-3.0", LESSER), ("lgpl-2.1", LESSER.replace("version 3", "version 2.1")),
    ("gpl-2.0", GPL.replace("version 3", "version 2")), ("agpl-3.0", GPL.replace("General", "Affero General")), ("isc", ISC),
    ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"),
    ("mpl-2.0", "x\n * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"),
    ("apache-2.0", "\n\n# Licensed under the Apache\n# License,\n#\n# Version 2.0 (the"),
    ("apache-2.0", "// SPDX-License-Identifier: Apache-2.0\nint x;"), ("gpl-2.0", "/* SPDX-License-Identifier: GPL-2.0-only */"),
    ("mit", "the mit\nlicense released under"), ("mit", "Released under\nthe MIT\n"), ("mit", "The MIT License (MIT)"),
    ("mit", "word " * 5000 + "released under the MIT license" + " word" * 5000),
    ("mit", "the released " + "word " * 100 + "This is released under an MIT license " + "word " * 100),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"), ("cc-by-nc", "Licensed by X under CC BY-NC 3.0"),
    ("cc-by", "Licensed under CC BY 4.0"), ("cc-by-sa", "Licensed\nunder CC BY-SA 4.0"), ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"), ("unlicense", "free and unencumbered software released into the public domain"),
    ("cc-by-nc", "This is under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc0", "Creative Commons CC0 1.0 Universal"), ("zlib", "provided 'as-is', without any express or implied warranty. In no event will the "
                                                            "authors\nbe held liable for any damages arising from the use of this software"),
    ("gpl-3.0", "work licensed under the GNU General Public License, version 3"),
]
NEAR_MISSES = [
    "License", "the license", "This work is licensed under the GNU General Public License, version 1", "Released under the Apache License",
    "Released under the BSD License", "Released under\nthe BSD License", "Licensed under the Apache License, Version 1.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1",
    "This work is licensed under the GNU Library General Public License, version 3",
    "released " + "word " * 40 + "under the " + "word " * 40 + "license of mit",
    "license under mit " + "word " * 29 + "released the", "released\n" + "filler " * 9 + "under\n" + "filler " * 9 + "a MIT license",
    "it is granted to any person free of charge", "licensed under the terms of the sale",
]


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return [{b.label for b in r.blocks} for r in sorted(L.scan(docs).collect(), key=lambda r: r.doc.doc_id)]


def test_published_notices_and_near_misses(spark):
    want = [{label} for label, _ in NAMED] + [set()] * len(NEAR_MISSES)
    texts = [t for _, t in NAMED] + NEAR_MISSES
    assert list(zip(texts, labels_of(spark, texts))) == list(zip(texts, want))


def test_every_template_is_found_by_itself(spark):
    assert labels_of(spark, [t for _, t in L.TEMPLATES]) == [{label} for label, _ in L.TEMPLATES]


def test_wrapping_anew_changes_nothing(spark):
    r = random.Random(9)
    texts = [t for _, t in NAMED] + NEAR_MISSES
    anew = ["".join(r.choice(["\n", " ", "\n * ", "  \n\n"]) if c.isspace() else c for c in t) for t in texts]
    assert labels_of(spark, anew) == labels_of(spark, texts)


def test_notices_do_not_run_over_two_texts_and_are_told_once(spark):
    docs = spark.createDataFrame([(0, "Released under the"), (1, "A file\n\nReleased under the MIT License\nthe MIT")],
                                 "doc_id long, text string").coalesce(1)
    first, second = sorted(L.scan(docs, [("mit", "Released under the MIT License")]).collect(), key=lambda r: r.doc.doc_id)
    assert not first.blocks
    assert [(b.label, b.line, b.word, b.words, b.containment) for b in second.blocks] == [("mit", 2, 2, 5, 1.0)]


def test_one_long_run_of_template_words(spark):
    """Words that fill a text are looked at once each, not once a window."""
    text = "license under the " * 100_000 + "released mit " + "mit license " * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert labels_of(spark, [text]) == [{"mit"}] and L.scan(docs, threshold=1.0).count() == 1
