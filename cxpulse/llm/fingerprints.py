"""Document fingerprints: threshold-scaled sketches of word shingles.

Words are runs of non-white-space (``[\\x20\\x09-\\x0D]``), A-Z lower-cased; a
shingle is five words in a row (fewer words: the whole sequence). Of a text's
distinct 64-bit shingle hashes the sketch retains every one below ``THRESHOLD``,
one in ``ONE_IN`` of all hashes whatever the text's length, so sketches of very
unequal texts stay comparable. A text with fewer than ``LEAST`` such hashes retains
its ``LEAST`` smallest ones (all, if it has no more), so short texts are not left
without a sketch.

Up to some hash a sketch is complete: the threshold, its largest hash, or, with
fewer than ``LEAST`` hashes, all there are. Two sketches are compared below the
smaller of their bounds. Sketches merge: ``merge`` of the sketches of some texts
equals the sketch of all their shingles.

A fingerprint is the base64 text of the retained hashes in ascending order, 8
bytes each, so equal texts have equal fingerprints; without words it is empty.
Likeness is the estimated containment of the one with fewer shingles in the other
(0 to 1): 1 for two texts without words, 0 if only one has none or nothing of it
lies below the common bound.

``edited_documents`` meets every document with the next one in the order of
doc_id (a null counts as the smallest; rows of one id in the order of a hash of
their text): documents are dealt to buckets by bounds on (id, hash), and the
first document of a bucket also goes to the bucket before as the last one's next.
So texts are shuffled once, and a task sees its rows as a sorted stream. Rows
repeating an id and text in more copies than a bucket's rows are counted before
the shuffle. A null text is an empty one; after the last document comes the first
(a single document follows itself); an empty table gives an empty result; columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, materialise, table

SHINGLE = 5
ONE_IN = 32
THRESHOLD = np.uint64((1 << 64) // ONE_IN)
LEAST = 64
BUCKET_ROWS = 8192
MAX_BUCKETS = 100_000  # beyond, buckets get longer
REPEAT_ROWS = 10_000
_NO_ID = -(1 << 63)


def retained(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct shingle hashes."""
    return hashes[:max(LEAST, int(np.searchsorted(hashes, THRESHOLD)))]


def sketches(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sketch of every text of a column."""
    for lo, hi, words, bounds in T.words_of(texts, T.NOT_SPACE):
        for k in range(hi - lo):
            yield retained(T.shingle_set(words[bounds[k]:bounds[k + 1]], SHINGLE))


def merge(parts: Iterable[np.ndarray]) -> np.ndarray:
    """The sketch of the union of the texts' shingles."""
    return retained(np.unique(np.concatenate([np.zeros(0, np.uint64), *parts])))


def complete_to(sketch: np.ndarray) -> int:
    """The largest hash up to which the sketch holds every shingle."""
    return (1 << 64) - 1 if len(sketch) < LEAST else max(int(sketch[-1]), int(THRESHOLD) - 1)


def shared(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(common hashes, hashes of a, hashes of b) below the common bound."""
    bound = np.uint64(min(complete_to(a), complete_to(b)))
    a, b = a[:np.searchsorted(a, bound, "right")], b[:np.searchsorted(b, bound, "right")]
    return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated containment of the smaller shingle set in the larger."""
    if not len(a) and not len(b):
        return 1.0
    common, n, m = shared(a, b)
    return common / min(n, m) if n and m else 0.0


def encoded(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [encoded(s) for s in sketches(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""
    importable(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fingerprint string")


def _deal(ids: np.ndarray, hashes: np.ndarray):
    """Adds each row's bucket; the first rows of a bucket also go to the bucket
    before it, marked as its tail. ``ids``, ``hashes``: the buckets' first keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, h = np.asarray(batch.column("key"), np.int64), np.asarray(batch.column("h"), np.int64)
            bucket = np.searchsorted(ids, key, "left") - 1
            upto = np.searchsorted(ids, key, "right")
            for k in np.flatnonzero(upto - 1 > bucket):  # an id that bounds a bucket
                a, b = bucket[k] + 1, upto[k]
                bucket[k] = a + np.searchsorted(hashes[a:b], h[k], "right") - 1
            firsts = np.flatnonzero((ids[bucket] == key) & (hashes[bucket] == h))
            rows = np.concatenate([np.arange(len(key)), firsts])
            place = np.concatenate([bucket, (bucket[firsts] - 1) % len(ids)])
            tail = np.arange(len(rows)) >= len(key)
            full = batch.take(pa.array(rows)) if len(firsts) else batch
            yield pa.RecordBatch.from_arrays([*full.columns, pa.array(place, pa.int32()), pa.array(tail)], names=[*full.schema.names, "bucket", "tail"])
    return run


def _results(pairs: list[tuple]) -> pa.RecordBatch:
    """Rows of (doc_id, text, its sketch, times, next text, its sketch)."""
    edited = [text[:len(text) - len(text) // 4] + after[:len(text) // 4] for _, text, _, _, after, _ in pairs]
    marks = list(sketches(pa.array(edited, pa.large_string())))
    columns = {
        "doc_id": pa.array([p[0] for p in pairs], pa.int64()), "n_chars": pa.array([len(p[1]) for p in pairs], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        "fingerprint": pa.array([encoded(p[2]) for p in pairs]), "edited_fingerprint": pa.array([encoded(s) for s in marks]),
        "near_edited": pa.array([likeness(p[2], s) for p, s in zip(pairs, marks)]), "near_next": pa.array([likeness(p[2], p[5]) for p in pairs]),
        "times": pa.array([p[3] for p in pairs], pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with the next one of its bucket, from rows sorted by (bucket,
    tail, key, h, text)."""
    held = None  # (bucket, doc_id, text, sketch)
    for batch in batches:
        _, offsets = T.text_buffers(batch.column("text"))
        for lo, hi in T.chunks(offsets):
            part = batch.slice(lo, hi - lo)
            pairs = []
            rows = zip(*(part.column(c).to_pylist() for c in ("bucket", "tail", "doc_id", "text", "copies")), sketches(part.column("text")))
            for bucket, tail, doc_id, text, copies, sketch in rows:
                if held and held[0] == bucket:
                    pairs.append((*held[1:], 1, text, sketch))
                    held = None
                if not tail:
                    held = (bucket, doc_id, text, sketch)
                    if copies > 1:  # all but the last are followed by a copy
                        pairs.append((doc_id, text, sketch, copies - 1, text, sketch))
            if pairs:
                yield _results(pairs)


def edited_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: each document against itself with the last quarter
    of its code points replaced by the head of the next document, and against the
    next document."""
    spark = docs.sparkSession
    importable(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), F.xxhash64(text).alias("h"), text.alias("text"))
    keys = materialise(rows.groupBy("key", "h").agg(F.count(F.lit(1)).alias("n")), "fingerprint-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(1, min(-(-total // BUCKET_ROWS), MAX_BUCKETS))
    long = max(BUCKET_ROWS, -(-total // n_buckets))
    heads = (keys.repartitionByRange(n_buckets, "key", "h").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct("key", "h")).alias("head")).select("head.key", "head.h").orderBy("key", "h").toArrow())
    ids, hashes = (np.asarray(heads.column(c).combine_chunks(), np.int64) for c in ("key", "h"))
    common = rows.withColumn("copies", F.lit(1).cast("long"))
    crowded = [(r["key"], r["h"]) for r in keys.filter(F.col("n") > long).select("key", "h").collect()]  # at most MAX_BUCKETS
    if crowded:
        hot = F.broadcast(spark.createDataFrame(crowded, "key long, h long"))
        counted = rows.join(hot, ["key", "h"], "left_semi").groupBy("doc_id", "key", "h", "text").agg(F.count(F.lit(1)).alias("copies"))
        common = common.join(hot, ["key", "h"], "left_anti").select("doc_id", "key", "h", "text", "copies").union(counted.select("doc_id", "key", "h", "text", "copies"))
    if not total:
        ids, hashes = np.zeros(1, np.int64), np.zeros(1, np.int64)
    order = ["bucket", "tail", "key", "h", "text"]
    dealt = common.mapInArrow(_deal(ids, hashes), "doc_id long, key long, h long, text string, copies long, bucket int, tail boolean")
    met = dealt.repartitionById(n_buckets, "bucket").sortWithinPartitions(*order).mapInArrow(
        _meet, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, times long")
    if crowded:  # copies that were counted come back as rows, some at a time
        met = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(times - 1) div {REPEAT_ROWS}")))).repartition(n_buckets)
        met = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(REPEAT_ROWS), F.col("times") - F.col("block") * REPEAT_ROWS)))).drop("block", "copy")
    return met.drop("times")


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_documents(table(spark, sf_dir, "documents"))
