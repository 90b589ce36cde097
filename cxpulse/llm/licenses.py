"""License scan: base phrases, and an exact set-similarity join with templates.

A text's words are runs of characters other than ASCII ones that are no digit
or letter, A-Z lower-cased. Base labels: places where a phrase's words stand
consecutively. The method adds labels of its own: every text block whose
word set contains at least ``THRESHOLD`` t of a template's word set gets the
template's label. A template of n words is compared with all runs of ``ceil(n / t)``
consecutive words (or the whole text, if shorter), whatever line breaks they span,
as notices are usually wrapped; words further apart than that are no notice. Tokens
have one global order, rarest first, by the number of lines of the whole corpus
that hold them. With it the join is exact but looks at few pairs:

* prefix filter: a block that meets the threshold holds one of the template's
  ``|T| - ceil(t |T|) + 1`` rarest tokens; only those are indexed;
* length filter: the block has at least ``ceil(t |T|)`` distinct words;
* positional filter: after the first shared prefix token, what both have left
  must still reach ``ceil(t |T|)``.

A text's word set holds that of each of its runs, so the filters look at texts
first, and the runs of a text only for the templates that it meets as one block;
runs are verified on their full sets. Runs that meet a template and share a template
word make one block (``license_blocks``). The templates are a parameter (a few
dozen), so their index travels with the function; the corpus is read map-only,
once for the order and once for the join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, table

#: (phrase, label), as given
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: (text, label): what the method looks for besides
TEMPLATES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-notice"),
    ("released under the mit license", "mit-release"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-notice"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
]
THRESHOLD = 0.8
_WORD = T.lut([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
_WORD_RE = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = rb"[^0-9a-z\x80-\xff]+"


def needed(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def run_words(size: int, threshold: float) -> int:
    """Words of the runs that a template of ``size`` words is compared with."""
    return math.ceil(size / threshold - 1e-9)


class TemplateIndex:
    """Templates with their tokens in the global order and the prefix index."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, frequency: dict[bytes, int]):
        self.threshold = threshold
        order = lambda w: (frequency.get(w, 0), w)  # noqa: E731  rarest first, ties by text
        self.sets = [sorted(set(text.encode().split()), key=order) for text, _ in templates]
        self.sizes = [run_words(len(text.split()), threshold) for text, _ in templates]
        self.labels = [label for _, label in templates]
        self.rank = {w: k for k, w in enumerate(sorted({w for s in self.sets for w in s}, key=order))}
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for t, tokens in enumerate(self.sets):
            for place in range(len(tokens) - needed(len(tokens), threshold) + 1 if tokens else 0):
                self.index.setdefault(tokens[place], []).append((t, place))
        # one search finds whether a text has any prefix token at all
        self.any_prefix = re.compile(b"|".join(sorted(map(re.escape, self.index), key=len, reverse=True))) if self.index else None

    def matches(self, words: set[bytes]) -> dict[int, float]:
        """template -> containment, for all templates that a block's word set meets."""
        found: dict[int, float] = {}
        seen: set[int] = set()
        known = sorted((w for w in words if w in self.rank), key=self.rank.__getitem__)
        for k, w in enumerate(known):
            for t, place in self.index.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)
                tokens = self.sets[t]
                least = needed(len(tokens), self.threshold)
                if len(words) < least or 1 + min(len(known) - k - 1, len(tokens) - place - 1) < least:
                    continue
                both = sum(x in words for x in tokens)
                if both >= least:
                    found[t] = both / len(tokens)
        return found

    def run_matches(self, words: list[bytes]) -> dict[int, list[tuple[int, int, float]]]:
        """template -> its blocks in a text of these words: (first, last, best containment)
        of runs that meet the template, one for all that share a template word; first
        and last are template words."""
        found: dict[int, list[tuple[int, int, float]]] = {}
        for t in self.matches(set(words)):
            tokens = set(self.sets[t])
            least = needed(len(tokens), self.threshold)
            held: dict[bytes, int] = {}
            own = [k for k, w in enumerate(words) if w in tokens]
            blocks: list[tuple[int, int, float]] = []
            first = 0
            for k in own:  # a run holds no more of the template than the one that ends at its last template word
                held[words[k]] = held.get(words[k], 0) + 1
                while own[first] <= k - self.sizes[t]:
                    w = words[own[first]]
                    held[w] -= 1
                    if not held[w]:
                        del held[w]
                    first += 1
                if len(held) >= least:
                    start, c = own[first], len(held) / len(tokens)
                    if blocks and start <= blocks[-1][1]:
                        begin, _, best = blocks.pop()
                        start, c = begin, max(best, c)
                    blocks.append((start, k, c))
            if blocks:
                found[t] = blocks
        return found

    def blocks(self, text: bytes) -> dict[int, list[tuple[int, int, float]]]:
        """``run_matches`` of a lower-cased text."""
        if self.any_prefix is None or not self.any_prefix.search(text):
            return {}
        return self.run_matches(_WORD_RE.findall(text))


def _lower(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each chunk of rows: (lo, hi, lower-cased bytes, bounds of the texts)."""
    data, offsets = T.text_buffers(column)
    for lo, hi in T.chunks(offsets):
        part = T.ASCII_LOWER[data[offsets[lo]:offsets[hi]]]
        yield lo, hi, part, offsets[lo:hi + 1] - offsets[lo]


def _token_blocks(tokens: list[bytes]):
    """Per batch: in how many blocks (lines) each template token stands."""
    hashes = T.span_hashes(np.frombuffer(b" ".join(tokens), np.uint8), *_spans(tokens))
    order = np.argsort(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for lo, hi, part, at in _lower(batch.column("text")):
                first, past = T.word_spans(part, at[:-1], at[1:], _WORD)
                h = T.span_hashes(part, first, past)
                k = np.searchsorted(hashes[order], h)
                hit = np.flatnonzero(hashes[order][np.minimum(k, len(order) - 1)] == h)
                starts = np.unique(np.concatenate([at[:-1], np.flatnonzero(part == 10) + 1]))
                block = np.searchsorted(starts, first[hit], "right")
                pairs = np.unique(block * len(tokens) + order[k[hit]])
                count += np.bincount(pairs % len(tokens), minlength=len(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array(count)], names=["token", "blocks"])
    return run


def _spans(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    past = np.cumsum([len(w) + 1 for w in tokens]) - 1
    return past - np.array([len(w) for w in tokens]), past


def token_frequency(docs: DataFrame, templates: list[tuple[str, str]]) -> dict[bytes, int]:
    """Blocks holding each template token, over all documents (as many rows as
    the templates have tokens)."""
    tokens = sorted({w for text, _ in templates for w in text.encode().split()})
    rows = docs.select("text").mapInArrow(_token_blocks(tokens), "token binary, blocks long")
    return {bytes(r["token"]): r["n"] for r in rows.groupBy("token").agg(F.sum("blocks").alias("n")).collect()}


def _scan(index: TemplateIndex, phrases: list[tuple[str, str]]):
    patterns = [(re.compile(rb"(?<![0-9a-z\x80-\xff])" + _GAP.join(map(re.escape, p.encode().split())) + rb"(?![0-9a-z\x80-\xff])"), p.encode().split(), label) for p, label in phrases]

    def scan(text: bytes) -> list[tuple[int, str]]:
        """(byte place, label) of all base phrases."""
        places = []
        for pattern, words, label in patterns:
            if all(w in text for w in words):
                m = pattern.search(text)
                while m:
                    places.append((m.start(), label))
                    m = pattern.search(text, m.start() + 1)
        return places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, part, at in _lower(batch.column("text")):
                first, _ = T.word_spans(part, at[:-1], at[1:], _WORD)
                bounds = np.searchsorted(first, at)
                raw = part.tobytes()
                out = []
                for k in range(hi - lo):
                    text = raw[at[k]:at[k + 1]]
                    places, met = scan(text), index.blocks(text)
                    own = np.searchsorted(first[bounds[k]:bounds[k + 1]], [at[k] + p for p, _ in places])
                    base = sorted({label for _, label in places})
                    every = sorted({*base, *(index.labels[t] for t in met)})
                    score = 1.0 if places else max((c for found in met.values() for _, _, c in found), default=0.0)
                    out.append((len(places), int(own.min()) if places else None, int(own.max()) if places else None, ",".join(base), ",".join(every), score,
                                sum(map(len, met.values()))))
                cols = list(zip(*out)) or [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.diff(bounds).astype(np.int64)),
                     *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())))],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks"])
    return run


def _blocks(index: TemplateIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo, hi, part, at in _lower(batch.column("text")):
                raw = part.tobytes()
                out = [(ids[lo + k], index.labels[t], first, last, c) for k in range(hi - lo)
                       for t, found in index.blocks(raw[at[k]:at[k + 1]]).items() for first, last, c in found]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()))],
                                                 names=["doc_id", "label", "first_word", "last_word", "containment"])
    return run


def license_blocks(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every text block that meets a template: doc_id, label, first_word, last_word
    (words from 0), containment.

    Null or empty texts have no blocks; repeated rows repeat theirs; an empty table
    gives an empty result; columns besides doc_id and text are ignored.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = TemplateIndex(templates, threshold, token_frequency(rows, templates))
    return rows.mapInArrow(_blocks(index), "doc_id long, label string, first_word long, last_word long, containment double")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, n_blocks (of all templates).

    ``score`` is 1 with a base phrase, else the best containment of a matching
    template, else 0. Null or empty texts have no words, empty labels and score
    0; repeated rows give repeated results; an empty table an empty result.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = TemplateIndex(templates, threshold, token_frequency(rows, templates))
    return rows.mapInArrow(_scan(index, phrases), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    phrases = " UNION ALL ".join(f"SELECT string_split('{p}', ' ') AS p, '{label}' AS label" for p, label in PHRASES)
    templates = " UNION ALL ".join(f"SELECT list_distinct(string_split('{t}', ' ')) AS t, {run_words(len(t.split()), THRESHOLD)} AS run, '{label}' AS label" for t, label in TEMPLATES)
    return rf"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
phrases AS ({phrases}),
templates AS ({templates}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(p) - 1] = p)) - 1 AS place
  FROM d JOIN phrases ON list_contains(w, p[1])),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id),
texts AS (
  SELECT doc_id, w, m.t, run, label FROM d JOIN templates m ON len(list_intersect(list_distinct(w), m.t)) >= ceil({THRESHOLD} * len(m.t) - 1e-9)),
ends AS (SELECT *, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(t, w[i]))) AS k FROM texts),
runs AS (
  SELECT doc_id, label, k, len(t) AS n, len(list_intersect(list_distinct(w[greatest(1, k - run + 1):k]), t)) AS held,
    min(k) OVER (PARTITION BY doc_id, label ORDER BY k RANGE BETWEEN run - 1 PRECEDING AND CURRENT ROW) AS start FROM ends),
hits AS (
  SELECT doc_id, label, held::DOUBLE / n AS c, CASE WHEN start <= lag(k) OVER (PARTITION BY doc_id, label ORDER BY k) THEN 0 ELSE 1 END AS opens
  FROM runs WHERE held >= ceil({THRESHOLD} * n - 1e-9)),
met AS (SELECT doc_id, label, max(c) AS c, sum(opens) AS n_blocks FROM hits GROUP BY doc_id, label),
own AS (SELECT doc_id, list(label) AS labels, max(c) AS c, sum(n_blocks) AS n_blocks FROM met GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score, coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""


SQL = _sql()
