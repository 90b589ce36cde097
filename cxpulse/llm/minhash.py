"""Near-duplicate documents: MinHash, banding, signature verification, exact
verification on full shingle sets, components by large-star and small-star.

A document's set holds its distinct 4-word shingles (words: runs of
``[^\\x20\\x09-\\x0D]``, A-Z lower-cased; fewer words: the whole sequence). Two
documents are linked when 100 * intersection >= 80 * union.

* Documents with the same set form a class first (128-bit set fingerprint);
  only one of each class goes on, so groups of copies cost one row.
* ``BANDS`` bands of ``ROWS`` minima of universal hashes (multiply-add over
  64 bits, upper half): a pair at the threshold shares no band with
  probability (1 - 0.8 ** ROWS) ** BANDS = 4e-7.
* Documents of a bucket are verified against the bucket's centre, not against
  each other. What stays apart after that (documents of one bucket in different
  components) is compared by signature, in blocks spread over tasks, and where the
  estimate reaches ``PRUNE`` (5 standard errors under the threshold) on full
  sets, in the same task: only links leave it. No bucket is cut or dropped. A
  pair at the threshold has fewer than 69 equal minima with probability 2.2e-6;
  with the bands, 2.5e-6 is the most that such a pair is missed with.
* Centres with many members are split into blocks of ``BLOCK`` members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm import textnum as T
from cxpulse.llm.common import importable, materialise, table
from cxpulse.llm.components import components

SHINGLE = 4
BANDS, ROWS = 28, 4
PERCENT = 80
PRUNE = 0.61
BLOCK = 500  # documents in a block; one more for every SHINGLES of a long one
SHINGLES = 1000
SIGNATURES = 4096  # signatures in a block
_HASHES = BANDS * ROWS
_rng = np.random.default_rng(20240117)
_A = _rng.integers(0, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2)


def signature(shingles: np.ndarray) -> np.ndarray:
    """uint32 minima of the ``_HASHES`` universal hashes over a set."""
    x = shingles >> np.uint64(32)
    least = np.full(_HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), 256):
        np.minimum(least, (_A[:, None] * x[None, k:k + 256] + _B[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, hashes, bounds in T.words_of(batch.column("text"), T.NOT_SPACE):
            n, k1, k2, sigs = [], [], [], []
            for k in range(hi - lo):
                s = T.shingle_set(hashes[bounds[k]:bounds[k + 1]], SHINGLE)
                n.append(len(s))
                k1.append(int(np.add.reduce(T.mix64(s)).astype(np.int64)) if len(s) else 0)
                k2.append(int(np.bitwise_xor.reduce(T.mix64(s + np.uint64(0x5851F42D4C957F2D))).astype(np.int64)) if len(s) else 0)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "k1", "k2", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, key, doc_id) of each signature, one row per band."""
    for batch in batches:
        for lo in range(0, len(batch), 4096):
            part = batch.slice(lo, 4096)
            if not len(part):
                continue
            sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(len(part), BANDS, ROWS).astype(np.uint64)
            key = np.full(sigs.shape[:2], np.uint64(1))
            for r in range(ROWS):
                key = T.mix64(key * np.uint64(0x9FB21C651E98DF25) + sigs[:, :, r])
            key = T.mix64(key + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93))
            ids = np.repeat(part.column("doc_id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids)], names=["key", "doc_id"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) whose full sets meet the threshold, from rows sorted by
    (centre, block, kind): a centre's own row (kind 0) precedes its members."""
    centre, base = None, None
    for batch in batches:
        centres, kinds, ids = (batch.column(c).to_pylist() for c in ("centre", "kind", "doc_id"))
        u, v = [], []
        for lo, hi, hashes, bounds in T.words_of(batch.column("text"), T.NOT_SPACE):
            for k in range(lo, hi):
                if kinds[k] == 0:
                    centre = centres[k]
                    base = T.shingle_set(hashes[bounds[k - lo]:bounds[k - lo + 1]], SHINGLE)
                    continue
                if centre != centres[k]:
                    continue
                s = T.shingle_set(hashes[bounds[k - lo]:bounds[k - lo + 1]], SHINGLE)
                both = len(np.intersect1d(base, s, assume_unique=True))
                if both and 100 * both >= PERCENT * (len(base) + len(s) - both):
                    u.append(centre)
                    v.append(ids[k])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u: centre, v: member) whose documents are linked, by their full texts."""
    counts = pairs.groupBy("u").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = pairs.join(counts, "u").select("u", F.expr("pmod(xxhash64(v), blocks)").cast("int").alias("block"), F.lit(1).alias("kind"), F.col("v").alias("want"))
    centres = counts.select("u", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(0).alias("kind"), F.col("u").alias("want"))
    wanted = members.union(centres).withColumnRenamed("u", "centre")
    texts = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"] == wanted["want"]).select("centre", "block", "kind", "doc_id", "text")
    grouped = texts.repartition("centre", "block").sortWithinPartitions("centre", "block", "kind")
    return grouped.mapInArrow(_verify, "u long, v long").distinct()


def _linked_across(left: list[tuple], right: list[tuple]) -> tuple[list[int], list[int]]:
    """Linked pairs of different components between two lists of (doc_id, comp,
    sig, set): signatures first, then the full sets."""
    u: list[int] = []
    v: list[int] = []
    if not left or not right:
        return u, v
    sigs = np.frombuffer(b"".join(r[2] for r in left), np.uint32).reshape(-1, _HASHES)
    ids, comps, sizes = (np.array(x) for x in zip(*((r[0], r[1], len(r[3])) for r in left)))
    flat = np.concatenate([r[3] for r in left])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    names, flat = np.unique(flat, return_inverse=True)
    for doc_id, comp, sig, own in right:
        near = ((sigs == np.frombuffer(sig, np.uint32)).sum(axis=1) >= PRUNE * _HASHES) & (comps != comp)
        if not near.any():
            continue
        at = np.minimum(np.searchsorted(names, own), len(names) - 1)
        held = np.zeros(len(names), np.int64)
        held[at[names[at] == own]] = 1
        both = np.add.reduceat(held[flat], starts)
        hit = ids[near & (100 * both >= PERCENT * (sizes + len(own) - both))].tolist()
        u += [min(doc_id, x) for x in hit]
        v += [max(doc_id, x) for x in hit]
    return u, v


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) between components, from rows sorted by (key, i, j): side 0 is
    block i of a group, side 1 block j of its documents outside its largest
    component. Only links come out, never pairs to be tested."""
    def links(rows: list[tuple]) -> pa.RecordBatch:
        u, v = _linked_across(*([r[4:] for r in rows if r[3] == side] for side in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    held: list[tuple] = []
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "doc_id", "comp", "sig"))))
        for lo, hi, hashes, bounds in T.words_of(batch.column("text"), T.NOT_SPACE):
            for k in range(lo, hi):
                if held and held[0][:3] != rows[k][:3]:
                    yield links(held)
                    held = []
                held.append((*rows[k], T.shingle_set(hashes[bounds[k - lo]:bounds[k - lo + 1]], SHINGLE)))
    if held:
        yield links(held)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id) of the documents whose signature agrees with one of another
    component across the blocks, from rows as for ``_apart``. A row per document
    comes out, never pairs."""
    def found(rows: list[tuple]) -> pa.RecordBatch:
        sides = [[r for r in rows if r[3] == side] for side in (0, 1)]
        ids: list[int] = []
        if all(sides):
            left = np.frombuffer(b"".join(r[6] for r in sides[0]), np.uint32).reshape(-1, _HASHES)
            comps, hit = np.array([r[5] for r in sides[0]]), np.zeros(len(left), bool)
            for r in sides[1]:
                near = ((left == np.frombuffer(r[6], np.uint32)).sum(axis=1) >= PRUNE * _HASHES) & (comps != r[5])
                hit |= near
                if near.any():
                    ids.append(r[4])
            ids += [r[4] for r, h in zip(sides[0], hit) if h]
        return pa.RecordBatch.from_arrays([pa.array([rows[0][0]] * len(ids), pa.int64()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "doc_id", "comp", "sig"))):
            if held and held[0][:3] != row[:3]:
                yield found(held)
                held = []
            held.append(row)
    if held:
        yield found(held)


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, main, comp, doc_id, weight, ...) of groups as pairs of blocks
    (key, i, j): side 0 has block i of a group, side 1 block j of its documents
    outside ``main``. A block weighs about ``block``."""
    outer = F.col("comp") != F.col("main")
    per = rows.groupBy("key").agg(F.ceil(F.sum("weight") / block).cast("int").alias("ni"), F.ceil(F.sum(F.when(outer, F.col("weight"))) / block).cast("int").alias("nj"))
    rows = rows.join(per.filter("nj > 0"), "key")
    own = lambda n: F.expr(f"pmod(xxhash64(doc_id), {n})").cast("int")
    spread = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    kept = [c for c in rows.columns if c not in ("key", "main", "weight", "ni", "nj")]
    every = rows.select("key", own("ni").alias("i"), spread("nj").alias("j"), F.lit(0).alias("side"), *kept)
    outside = rows.filter(outer).select("key", spread("ni").alias("i"), own("nj").alias("j"), F.lit(1).alias("side"), *kept)
    return every.union(outside)


def _links_across(docs: DataFrame, shared: DataFrame, sigs: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between documents that share a bucket and are in different
    components after the centres were verified.

    Buckets whose centres are in one component make one group, so that a document
    comes once, not once per band. Only documents outside a group's largest
    component are compared with the group; both sides are dealt out in blocks.
    Signatures go first; texts are sent only for documents whose signature agrees
    with one across, in blocks bounded by their shingles.
    """
    named = lambda node: (F.coalesce(F.col(f"{node}_root"), F.col(node)))
    root = lambda node: comps.select(F.col("node").alias(f"{node}_node"), F.col("root").alias(f"{node}_root"))
    rows = shared.join(root("u"), F.col("u") == F.col("u_node"), "left").join(root("doc_id"), F.col("doc_id") == F.col("doc_id_node"), "left")
    rows = materialise(rows.select(named("u").alias("key"), "doc_id", named("doc_id").alias("comp")).distinct(), "groups")
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = per.groupBy("key").agg(F.max_by("comp", "n").alias("main"), F.count("*").alias("comps")).filter("comps > 1").select("key", "main")
    signed = materialise(rows.join(mixed, "key").join(sigs.select("doc_id", "n_shingles", "sig"), "doc_id"), "mixed-groups")
    grouped = lambda df: df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    near = grouped(_dealt(signed.withColumn("weight", F.lit(1)), SIGNATURES)).mapInArrow(_alike, "key long, doc_id long")
    near = materialise(near.distinct(), "alike")
    sized = signed.join(near, ["key", "doc_id"]).withColumn("weight", 1 + F.col("n_shingles") / F.lit(SHINGLES))
    wanted = _dealt(sized, BLOCK).withColumnRenamed("doc_id", "want")
    found = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"] == wanted["want"]).select("key", "i", "j", "side", "doc_id", "comp", "sig", "text")
    return grouped(found).mapInArrow(_apart, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable, itself included), kept.

    Null or empty texts, and texts of white space only, have an empty set and
    are linked with nothing. A doc_id names one document: rows that repeat it
    get the same component. Rows without doc_id are kept, component_id null.
    An empty table gives an empty result; further columns are ignored.
    """
    importable(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = materialise(docs.mapInArrow(_signatures, "doc_id long, n_shingles long, k1 long, k2 long, sig binary"), "signatures")
    filled = sigs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = ["n_shingles", "k1", "k2"]
    classes = materialise(filled.groupBy(*keys).agg(F.min("doc_id").alias("rep")), "classes")
    reps = sigs.join(classes, [*keys, ]).filter("doc_id = rep").select("doc_id", "n_shingles", "sig").dropDuplicates(["doc_id"])
    reps = materialise(reps, "class-signatures")
    bands = reps.mapInArrow(_bands, "key long, doc_id long")
    centres = bands.groupBy("key").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("last")).filter("u != last").select("key", "u")
    shared = materialise(bands.join(centres, "key").select("u", "doc_id").distinct(), "shared-bands")
    first = shared.filter("doc_id != u").select("u", F.col("doc_id").alias("v"))
    links = materialise(verified(docs, materialise(first, "star-pairs")), "links")
    comps = materialise(components(links), "components")
    across = materialise(_links_across(docs, shared, reps, comps), "links-across")
    if not across.isEmpty():
        comps = materialise(components(links.union(across)), "components")
    member = sigs.select("doc_id", *keys).join(classes, keys, "left")
    named = member.join(comps, member["rep"] == comps["node"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "rep", "doc_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one document of each near-duplicate group."""
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM t),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r AS (SELECT doc_id AS node, doc_id AS root FROM s UNION SELECT l.v, r.root FROM r JOIN both_ways l ON r.node = l.u),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON s.doc_id = c.node
"""
