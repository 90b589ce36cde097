"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words (runs of ASCII digits and letters, A-Z lower-cased, and
of all bytes from 0x80) and the first six bytes of longer words, hashed into
``SLOTS`` slots; a term is present or not. The machine scores
``w0 + sum w_i + sum over pairs <v_i, v_j>`` over the present terms, so that two
terms together can weigh more, or less, than their sum (insult with group
mention). It is fitted on at most ``SAMPLE`` labelled rows (those with the
smallest hash of their id), on the ``TERMS`` slots that separate their labels
best; both bounds are parameters. Scoring reads every whole text, map-only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, table

SLOTS = 1 << 20
TERMS = 4096
SAMPLE = 12_000
FACTORS = 8
PREFIX = 6
EPOCHS = 25
BATCH = 256
L2_W = 1e-4
L2_V = 1e-3
_WORD = T.lut([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


def term_slots(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each chunk of rows: (lo, hi, row, slot) of all terms, repeated ones too."""
    data, offsets = T.text_buffers(column)
    for lo, hi in T.chunks(offsets):
        part = T.ASCII_LOWER[data[offsets[lo]:offsets[hi]]]
        at = offsets[lo:hi + 1] - offsets[lo]
        first, past = T.word_spans(part, at[:-1], at[1:], _WORD)
        row = np.searchsorted(at, first, "right") - 1
        long = past - first > PREFIX
        hashes = np.concatenate([T.span_hashes(part, first, past), ~T.span_hashes(part, first[long], first[long] + PREFIX)])
        yield lo, hi, np.concatenate([row, row[long]]), (hashes % np.uint64(SLOTS)).astype(np.int64)


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, toxic and the distinct slots of each labelled text."""
    for batch in batches:
        for lo, hi, row, slot in term_slots(batch.column("text")):
            key = np.unique(row * SLOTS + slot)
            at = np.searchsorted(key, np.arange(hi - lo + 1) * SLOTS)
            slots = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((key % SLOTS).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("toxic").slice(lo, hi - lo), slots], names=["doc_id", "toxic", "slots"])


class FactorizationMachine:
    """terms: int32 per slot (-1: not in use); w0, w, v: the machine's weights."""

    def __init__(self, terms: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.w0, self.w, self.v = terms, w0, w, v

    def score(self, n: int, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Probabilities for ``n`` texts with terms (row, slot), which may repeat."""
        term = self.terms[slot]
        used = term >= 0
        key = np.unique(row[used] * len(self.w) + term[used])
        row, term = key // max(1, len(self.w)), key % max(1, len(self.w))
        y = self.w0 + np.bincount(row, self.w[term], n)
        for k in range(self.v.shape[1]):
            f = self.v[term, k]
            y += 0.5 * (np.bincount(row, f, n) ** 2 - np.bincount(row, f * f, n))
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def choose_terms(slots: list[np.ndarray], toxic: np.ndarray, most: int) -> np.ndarray:
    """The slots whose presence differs most between the labels (two-proportion
    z), ties to the smaller slot; a slot must be in two texts."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    flat = np.concatenate(slots) if slots else np.zeros(0, np.int64)
    c = np.bincount(flat, minlength=SLOTS).astype(float)
    c1 = np.bincount(flat, np.repeat(toxic, [len(s) for s in slots]).astype(float), SLOTS)
    p = c / (n1 + n0)
    z = np.abs(c1 / n1 - (c - c1) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    z[c < 2] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] > 2])


def gradient(theta: np.ndarray, x: np.ndarray, toxic: np.ndarray, weight: float) -> np.ndarray:
    """Of the mean log loss (toxic rows weigh ``weight``) plus ``L2_W`` / 2 |w|^2 and
    ``L2_V`` / 2 |v|^2, by theta = (w0, w, v); ``x``: which text holds which term."""
    m = x.shape[1]
    w, v = theta[1:m + 1], theta[m + 1:].reshape(m, FACTORS).astype(x.dtype)
    s = x @ v
    y = theta[0] + x @ w + 0.5 * ((s * s).sum(1) - x @ (v * v).sum(1))
    e = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - toxic).astype(x.dtype) / len(x)
    e = np.where(toxic > 0, e * weight, e).astype(x.dtype)
    return np.concatenate([[e.sum()], e @ x + L2_W * w, (x.T @ (e[:, None] * s) - v * (e @ x)[:, None] + L2_V * v).ravel()])


def fit(slots: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> FactorizationMachine:
    """Minibatch Adam on the log loss with L2; deterministic for given rows.
    Without labelled rows every text scores near 0."""
    chosen = choose_terms(slots, toxic, TERMS)
    terms = np.full(SLOTS, -1, np.int32)
    terms[chosen] = np.arange(len(chosen))
    m = len(chosen)
    rng = np.random.default_rng(seed)
    prior = (toxic.sum() + 0.5) / (len(toxic) + 1) if len(toxic) else 0.01
    theta = np.concatenate([[np.log(prior / (1 - prior))], np.zeros(m), rng.normal(0, 0.01, m * FACTORS)])
    held = [terms[s][terms[s] >= 0] for s in slots]
    weight = max(1.0, (len(toxic) - toxic.sum()) / max(1.0, toxic.sum()))  # both labels weigh alike
    g1, g2, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(EPOCHS if m else 0):
        order = rng.permutation(len(held))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            x = np.zeros((len(pick), m), np.float32)
            for r, i in enumerate(pick):
                x[r, held[i]] = 1
            grad = gradient(theta, x, toxic[pick], weight)
            step += 1
            g1 = 0.9 * g1 + 0.1 * grad
            g2 = 0.99 * g2 + 0.01 * grad * grad
            theta -= 0.02 * (g1 / (1 - 0.9 ** step)) / (np.sqrt(g2 / (1 - 0.99 ** step)) + 1e-8)
    return FactorizationMachine(terms, float(theta[0]), theta[1:m + 1], theta[m + 1:].reshape(m, FACTORS))


def remainder(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorizationMachine:
    """Fit on the training fold (``remainder`` not 0) of ``labels`` (doc_id,
    toxic); null labels are left out, a repeated doc_id is toxic if any row says so
    and learned from its smallest text. ``sample`` bounds the rows learned from."""
    fold = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
    rows = fold.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")  # at most ``sample`` rows
    texts = texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # one row per id, so no more than ``sample``
    found = texts.select("doc_id", "toxic", "text").mapInArrow(_sample_terms, "doc_id long, toxic int, slots array<int>").toArrow()
    found = found.sort_by("doc_id").combine_chunks()
    slots = [np.asarray(s.values.to_numpy(), np.int64) for s in found.column("slots").combine_chunks()] if len(found) else []
    return fit(slots, found.column("toxic").to_numpy().astype(float) if len(found) else np.zeros(0))


def scorer(model, extra):
    """A mapInArrow function: batches of rows with a ``text`` column -> what
    ``extra(batch, scores)`` makes of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            scores = [machine.score(hi - lo, row, slot) for lo, hi, row, slot in term_slots(batch.column("text"))]
            yield extra(batch, np.concatenate(scores) if scores else np.zeros(0))
    return run


def _result(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                      names=["doc_id", "held_out", "score", "predicted"])


def _accepted(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
    return batch.filter(pa.array(scores < 0.5))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null or empty texts have no terms and score like the prior; repeated rows
    score alike; an empty table gives an empty result; scores depend on nothing
    but the text. A null doc_id counts as empty text for ``held_out``.
    """
    importable(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    return rows.mapInArrow(scorer(model, _result), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents predicted toxic."""
    importable(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.mapInArrow(scorer(model, _accepted), docs.schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
