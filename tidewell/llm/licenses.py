"""License scan as an exact set-similarity join of text blocks with templates.

The blocks are the runs of consecutive words, over any line ends, of at most
``1 / threshold`` times a template's length. A template is found where such a run
holds at least ``threshold`` of the template's distinct words, all words that decide
which licence it is (``DECIDING``, by label) and none that rules it out
(``RULED_OUT``). Neither lines nor the order of words count, so wrapping a text anew
never changes what is found.

The words are put in one global order, rarest first by the number of documents that
hold them, counted over the whole corpus. Then

* prefix filter: a run that holds ``need`` of a template's ``n`` words holds one of
  its first ``n - need + 1``; only around these a text is looked at;
* length filter: at least ``need`` of the template's words stand near such a word;
* positional filter: at least ``need`` distinct ones that are no earlier in the order,
  as the first common word of a run decides;

and what remains is verified on the words themselves, by one pass of a sliding run.
No block above the threshold is missed. Of runs that overlap, the one with the most
words is told, the first of equals.

Templates are a parameter of bounded size; documents never move, only
word counts of the templates' vocabulary are shuffled.

Fixed phrases are searched beside it, at every place where their words follow
one another.

Defined results: a null or empty text has no words, places or labels, and score
zero. Repeated documents are judged one by one. A template without words is
never found.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.registry import query, table
from tidewell.llm.texts import LETTERS, Slice, map_texts, run_hashes, slices

THRESHOLD = 0.8
#: Phrases and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Notices by which common licenses are named, and their labels.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Apache License Version 2.0, January 2004"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsl-1.0", "Boost Software License - Version 1.0"),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("cc0", "Creative Commons CC0 1.0 Universal"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "The MIT License"),
    ("mit", "MIT License Copyright (c)"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. "
             "In no event will the authors be held liable for any damages"),
)
#: The parts of Creative Commons licenses, and the licenses made of them.
CC_PARTS = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
CC_LICENSES = ("by", "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "by-sa")
#: Label, name and version of the GNU licenses.
GNU_LICENSES = (
    ("agpl-3.0", "Affero General Public License", "3"),
    ("gpl-2.0", "General Public License", "2"),
    ("gpl-3.0", "General Public License", "3"),
    ("lgpl-2.1", "Lesser General Public License", "2.1"),
    ("lgpl-3.0", "Lesser General Public License", "3"),
)
#: Labels whose SPDX identifier differs from the label.
SPDX = {"bsd": "BSD-3-Clause", "cc0": "CC0-1.0"}
GNU_HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
              "as published by the Free Software Foundation, either version {} of the License")


def _templates() -> tuple[tuple[str, str], ...]:
    found = list(NOTICES)
    for parts in CC_LICENSES:
        name = "-".join(CC_PARTS[part] for part in parts.split("-"))
        found += [(f"cc-{parts}", f"Licensed under CC {parts} 4.0"),
                  (f"cc-{parts}", f"Creative Commons {name} 4.0 International License"),
                  (f"cc-{parts}", f"SPDX-License-Identifier: CC-{parts}-4.0")]
    for label, name, version in GNU_LICENSES:
        found += [(label, f"This work is licensed under the GNU {name}, version {version}"),
                  (label, GNU_HEADER.format(name, version)), (label, f"SPDX-License-Identifier: {label}")]
    found += [(label, f"SPDX-License-Identifier: {SPDX.get(label, label)}")
              for label in sorted({label for label, _ in NOTICES})]
    return tuple(found)


TEMPLATES = _templates()
#: By label: words that its templates, where they have them, are not found without.
DECIDING = {
    "agpl-3.0": ("affero", "agpl", "3"),
    "apache-2.0": ("apache", "2"),
    "bsd": ("bsd",),
    "bsl-1.0": ("boost", "bsl"),
    "cc0": ("cc0",),
    "epl-2.0": ("eclipse", "epl", "2"),
    "gpl-2.0": ("gnu", "general", "gpl", "2"),
    "gpl-3.0": ("gnu", "general", "gpl", "3"),
    "isc": ("isc", "fee", "purpose"),
    "lgpl-2.1": ("lesser", "lgpl", "2", "1"),
    "lgpl-3.0": ("lesser", "lgpl", "3"),
    "mit": ("mit",),
    "mpl-2.0": ("mozilla", "mpl", "2"),
    "unlicense": ("unencumbered", "unlicense"),
    "zlib": ("zlib", "express", "held"),
    **{f"cc-{parts}": ("cc", "creative", *parts.split("-"), *(CC_PARTS[p] for p in parts.split("-")))
       for parts in CC_LICENSES},
}
#: By label: words that no block of its templates may hold.
RULED_OUT = {
    "gpl-2.0": ("lesser", "library", "affero"),
    "gpl-3.0": ("lesser", "library", "affero"),
    **{f"cc-{parts}": tuple(word for part, name in CC_PARTS.items() if part not in parts.split("-")
                            for word in (part, name)) for parts in CC_LICENSES},
}
RESULTS = ("n_words long, places array<struct<label: string, word: long>>, "
           "blocks array<struct<label: string, line: long, word: long, words: long, containment: double>>")


def words_of(text: str) -> list[bytes]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def _hashes(words: Sequence[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    return run_hashes(data, ends - [len(w) for w in words], ends) if len(words) else np.zeros(0, np.uint64)


class Vocabulary:
    """The templates' words, and others beside them, found by hash."""

    def __init__(self, templates: Sequence[tuple[str, str]], others: Iterable[bytes] = ()):
        self.words = sorted({w for _, text in templates for w in words_of(text)} | set(others))
        hashes = _hashes(self.words)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Index into ``words`` of each hash, -1 for other words."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def document_counts(docs: DataFrame, templates: Sequence[tuple[str, str]], text: str = "text") -> dict[bytes, int]:
    """Number of documents that hold each of the templates' words. Every task adds
    up its own rows first; the result is as long as the vocabulary."""
    vocabulary = Vocabulary(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.words), dtype=np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0)):
                low = part.lowered()
                starts, ends, bounds = low.runs(LETTERS)
                ids = vocabulary.ids(run_hashes(low.data, starts, ends))
                at = np.flatnonzero(ids >= 0)
                holder = np.searchsorted(bounds, at, side="right") - 1
                pairs = np.unique(holder * len(total) + ids[at]) if len(total) else at
                total += np.bincount(pairs % max(1, len(total)), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["id", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "id long, n long")
    found = rows.groupBy("id").agg(F.sum("n").alias("n")).collect()
    totals = {r.id: r.n for r in found}
    return {w: totals.get(i, 0) for i, w in enumerate(vocabulary.words)}


class Template:
    """One template's words by their number in the vocabulary, in the global order."""

    def __init__(self, label: str, text: str, vocabulary: Vocabulary, rank: Mapping[bytes, int], threshold: float,
                 deciding: Iterable[bytes], ruled_out: Iterable[bytes]):
        number = {w: i for i, w in enumerate(vocabulary.words)}
        words = words_of(text)
        own = sorted(set(words), key=rank.__getitem__)
        self.label, self.size = label, len(own)
        self.need = max(1, math.ceil(threshold * len(own) - 1e-9))
        self.wide = math.ceil(len(words) / threshold - 1e-9)
        self.order = np.full(len(number), -1)
        self.order[[number[w] for w in own]] = np.arange(len(own))
        self.out = np.zeros(len(number), dtype=bool)
        self.out[[number[w] for w in set(ruled_out) - set(own)]] = True
        self.sure = {own.index(w) for w in set(deciding) & set(own)}
        self.words = own

    def near(self, own: np.ndarray, order: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of ``own``, the places of the template's words, that may hold a block.
        ``breaks`` are the places that no block spans."""
        hits = np.flatnonzero(order <= self.size - self.need)
        part = np.searchsorted(breaks, own[hits], side="right")
        first = np.searchsorted(own, np.concatenate([[0], breaks])[part])
        last = np.searchsorted(own, np.concatenate([breaks, [np.iinfo(np.int64).max]])[part])
        lo = np.maximum(np.searchsorted(own, own[hits] - self.wide + 1), first)
        hi = np.minimum(np.searchsorted(own, own[hits] + self.wide), last)
        enough = hi - lo >= self.need
        hits, lo, hi = hits[enough], lo[enough], hi[enough]
        if not len(hits):
            return
        cover = np.zeros(len(own) + 1, dtype=np.int64)
        np.add.at(cover, lo, 1)
        np.add.at(cover, hi, -1)
        inside = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        a, z = np.searchsorted(inside, lo), np.searchsorted(inside, hi)
        distinct = np.zeros(len(hits), dtype=np.int64)
        for word in range(self.size):
            before = np.concatenate([[0], np.cumsum(order[inside] == word)])
            distinct += (before[z] > before[a]) & (order[hits] <= word)
        start = end = 0
        for a, z in zip(lo[distinct >= self.need].tolist(), hi[distinct >= self.need].tolist()):
            if a >= end:
                if start < end:
                    yield start, end
                start = a
            end = z
        if start < end:
            yield start, end

    def blocks(self, places: list[int], order: list[int]) -> Iterator[tuple[int, int, int]]:
        """First word, end and number of distinct words of the blocks in one range."""
        inside: Counter = Counter()
        left, best = 0, None
        for j, word in enumerate(order):
            inside[word] += 1
            while places[j] - places[left] >= self.wide:
                inside[order[left]] -= 1
                if not inside[order[left]]:
                    del inside[order[left]]
                left += 1
            while inside[order[left]] > 1:  # a word that comes again adds nothing at the front
                inside[order[left]] -= 1
                left += 1
            if len(inside) < self.need or not self.sure <= inside.keys():
                continue
            if best and places[left] >= best[1]:
                yield best
                best = None
            if not best or len(inside) > best[2]:
                best = places[left], places[j] + 1, len(inside)
        if best:
            yield best


class Join:
    """The templates' side: their words in the global order of the corpus."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: Mapping[bytes, int], threshold: float,
                 deciding: Mapping[str, Sequence[str]] = DECIDING, ruled_out: Mapping[str, Sequence[str]] = RULED_OUT):
        def listed(words: Mapping[str, Sequence[str]], label: str) -> list[bytes]:
            return words_of(" ".join(words.get(label, ())))

        rank = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.vocabulary = Vocabulary(templates, [w for label, _ in templates for w in listed(ruled_out, label)])
        self.templates = [Template(label, text, self.vocabulary, rank, threshold, listed(deciding, label),
                                   listed(ruled_out, label)) for label, text in templates if words_of(text)]

    def search(self, ids: np.ndarray, bounds: np.ndarray, words: Callable[[int], bytes]
               ) -> Iterator[tuple[Template, int, int, int]]:
        """Template, first word, end and number of distinct words of every block; ``ids``
        are the words' numbers in the vocabulary, ``bounds`` the first words of the texts."""
        known = np.flatnonzero(ids >= 0)
        for template in self.templates:
            order = template.order[ids[known]]
            own, order = known[order >= 0], order[order >= 0]
            if len(own) < template.need or order.min() > template.size - template.need:
                continue
            breaks = np.unique(np.concatenate([bounds, known[template.out[ids[known]]]]))
            for a, z in template.near(own, order, breaks):
                true = [i for i in range(a, z) if words(int(own[i])) == template.words[order[i]]]
                for block in template.blocks(own[true].tolist(), order[true].tolist()):
                    yield template, *block


def _scan(part: Slice, join: Join, phrases: list[tuple[str, np.ndarray]]) -> list:
    low = part.lowered()
    starts, ends, bounds = low.runs(LETTERS)
    hashes = run_hashes(low.data, starts, ends)
    places: list[list[dict]] = [[] for _ in range(len(part))]
    for label, phrase in phrases:
        here = np.ones(max(0, len(hashes) - len(phrase) + 1), dtype=bool)
        for i, word in enumerate(phrase):
            here &= hashes[i:i + len(here)] == word
        for at in np.flatnonzero(here).tolist():
            text = int(np.searchsorted(bounds, at, side="right")) - 1
            if at + len(phrase) <= bounds[text + 1]:
                places[text].append({"label": label, "word": at - int(bounds[text])})
    blocks: list[list[dict]] = [[] for _ in range(len(part))]
    line_starts, _, line_bounds = low.lines()
    ids = join.vocabulary.ids(hashes)
    for template, at, end, common in join.search(ids, bounds, lambda i: low.data[starts[i]:ends[i]].tobytes()):
        text = int(np.searchsorted(bounds, at, side="right")) - 1
        line = int(np.searchsorted(line_starts, starts[at], side="right")) - 1
        blocks[text].append({"label": template.label, "line": line - int(line_bounds[text]),
                             "word": at - int(bounds[text]), "words": end - at, "containment": common / template.size})
    return [np.diff(bounds).astype(np.int64),
            pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
            pa.array(blocks, pa.list_(pa.struct([("label", pa.string()), ("line", pa.int64()), ("word", pa.int64()),
                                                 ("words", pa.int64()), ("containment", pa.float64())])))]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD, keep: list[str] | None = None,
         deciding: Mapping[str, Sequence[str]] = DECIDING,
         ruled_out: Mapping[str, Sequence[str]] = RULED_OUT) -> DataFrame:
    """Rows of ``docs`` as ``doc``, with ``n_words``, ``places`` (phrases, by word) and
    ``blocks`` (templates, by their first line and word, with length and containment)."""
    join = Join(templates, document_counts(docs, templates), threshold, deciding, ruled_out)
    searched = [(label, _hashes(words_of(phrase))) for phrase, label in phrases]
    return map_texts(docs, RESULTS, lambda: lambda part: _scan(part, join, searched), keep=keep)


def _values() -> str:
    """The templates as rows of SQL: number, label, notice, deciding and ruling words."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    return ",\n    ".join(
        f"({i}, {text(label)}, {text(notice)}, {text(' '.join(DECIDING.get(label, ())))}, "
        f"{text(' '.join(RULED_OUT.get(label, ())))})" for i, (label, notice) in enumerate(TEMPLATES))


OP9_SQL = r"""
WITH listed AS (
  SELECT number, label, regexp_extract_all(lower(notice), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS said,
         string_split(lower(deciding), ' ') AS deciding, string_split(lower(ruling), ' ') AS ruling
  FROM (VALUES
    @values) t(number, label, notice, deciding, ruling)
), templates AS (
  SELECT number, label, list_distinct(said) AS own, list_intersect(deciding, said) AS sure,
         list_filter(ruling, lambda w: NOT list_contains(said, w)) AS bad,
         ceil(0.8 * len(list_distinct(said)) - 1e-9) AS need, ceil(len(said) / 0.8 - 1e-9) AS wide
  FROM listed
), own_words AS (SELECT number, unnest(own) AS w FROM templates
), bad_words AS (SELECT number, unnest(bad) AS w FROM templates
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), split AS (
  SELECT r, doc_id, low, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs
), words AS MATERIALIZED (
  SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM split
), placed AS (
  SELECT r, i AS word, w, lead(w) OVER u AS w2, lead(w, 2) OVER u AS w3 FROM words WINDOW u AS (PARTITION BY r ORDER BY i)
), places AS (
  SELECT r, word, CASE WHEN w = 'cc' AND w2 = 'by' THEN 'cc-by'
                       WHEN w = 'general' AND w2 = 'public' AND w3 = 'license' THEN 'gpl'
                       WHEN w = 'all' AND w2 = 'rights' AND w3 = 'reserved' THEN 'reserved' END AS label
  FROM placed
), holders AS (
  SELECT r, number, need, wide, sure, label, len(own) AS n
  FROM (SELECT r, number, count(DISTINCT w) AS c FROM words JOIN own_words USING (w) GROUP BY ALL)
  JOIN templates USING (number) WHERE c >= need
), marks AS (
  SELECT r, number, i, w, false AS bad FROM words JOIN own_words USING (w) SEMI JOIN holders USING (r, number)
  UNION ALL
  SELECT r, number, i, w, true FROM words JOIN bad_words USING (w) SEMI JOIN holders USING (r, number)
), stops AS (
  SELECT *, min(CASE WHEN bad THEN i END) OVER (PARTITION BY r, number ORDER BY i
                                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stop
  FROM marks
), blocks AS (
  SELECT h.r, h.label, count(DISTINCT b.w) / any_value(h.n) AS share
  FROM holders h JOIN stops a USING (r, number)
  JOIN stops b ON b.r = a.r AND b.number = a.number AND b.i >= a.i AND b.i < a.i + h.wide AND b.i < coalesce(a.stop, b.i + 1)
  WHERE NOT a.bad AND NOT b.bad
  GROUP BY h.r, h.number, h.label, a.i
  HAVING count(DISTINCT b.w) >= any_value(h.need) AND list_has_all(list(b.w), any_value(h.sure))
), base AS (
  SELECT r, count(*) AS n, min(word) AS first_word, max(word) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places WHERE label IS NOT NULL GROUP BY r
), every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM places WHERE label IS NOT NULL UNION ALL SELECT r, label FROM blocks) GROUP BY r
), best AS (SELECT r, max(share) AS share FROM blocks GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM split LEFT JOIN base USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)
""".replace("@values", _values())


@query("op9_license_scan", OP9_SQL)
def op9(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.transform("places", lambda p: p["label"])
    own = F.transform("blocks", lambda b: b["label"])
    starts = F.transform("places", lambda p: p["word"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    share = F.array_max(F.transform("blocks", lambda b: b["containment"]))
    return found.select(
        F.col("doc")["doc_id"].alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"))
