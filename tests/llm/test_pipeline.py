"""The pipeline on a small corpus, each stage against brute force on what the
stage before it left."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from cxpulse.llm import exact_dedup, minhash, mixing, toxicity
from cxpulse.llm.common import materialise, shared_dir, step_tables

from .test_minhash import brute, near_copies
from .test_toxicity import corpus


def test_stages_keep_columns_of_any_name(spark, documents):
    """Columns named like what the operators add themselves come through unchanged."""
    names = ["_digest", "_keep_id", "digest", "keep_id", "own_id", "own_digest", "row", "n_keep", "_mix_source", "_mix_rate", "_mix_draw", "_mix_copies", "_mix_copy",
             "rate", "draw", "copies", "t_source", "own_source", "_gone", "component_id", "kept", "score", "n_shingles", "held_out", "toxic"]
    docs = documents([(1, "one text of some words", "a"), (2, "one text  of some words", "a"), (3, "another text altogether different", "b"), (4, None, None)], extra=False)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(1, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    stages = {"toxicity": toxicity.accepted(docs, labels), "exact": exact_dedup.keep_one(docs), "near": minhash.keep_one(docs), "mix": mixing.mix(docs)}
    for name, out in stages.items():
        assert out.columns == docs.columns, name
        found = out.collect()
        assert found and all(r[c] == f"{c} of {r['doc_id']}" for r in found for c in names), name
    assert sorted(r["doc_id"] for r in stages["exact"].collect()) == [1, 3, 4]


def test_stages_and_run(spark, documents, tmp_path):
    rows, labels = corpus(200)
    clean = [(1000 + i, t, "ab"[i % 2]) for i, t in enumerate(near_copies(12, 4, 3))]
    rows = [(i, t, "abc"[i % 3]) for i, t in rows] + clean + [(2000, clean[0][1] + " ", "a"), (2001, clean[0][1].replace(" ", "\t"), "a"), (2002, None, "a"), (2003, "", "b")]
    documents(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf, docs, kept = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in P.STAGES:
        out = materialise(stage(spark, docs, sf), name)
        if name != "pack":
            assert out.columns == docs.columns
        kept[name] = out.collect()
        last, docs = docs, out
    texts = lambda name: [(r["doc_id"], r["text"]) for r in kept[name]]
    accepted = dict(texts("toxicity"))
    assert {i for i, _, _ in clean} <= set(accepted) and len(accepted) < len(rows) - 20
    groups = {}
    for i, t in accepted.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    assert sorted(i for i, _ in texts("exact_dedup")) == sorted(min(g) for g in groups.values())
    assert sorted(i for i, _ in texts("near_dedup")) == [i for i, _, _, first in brute(texts("exact_dedup")) if first]
    near = spark.createDataFrame(kept["near_dedup"], last.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.decisions(near).collect()}
    taken = [i for i, _ in texts("mix_sources")]
    assert sorted(taken) == sorted(i for i, n in copies.items() for _ in range(n))
    tokens = {r["doc_id"]: r["doc_tokens"] for r in kept["pack"]}
    assert set(tokens) == set(taken) and sum(r["length"] for r in kept["pack"]) == sum(tokens[i] for i in taken)
    key = lambda r: tuple(r)
    shared = lambda: {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    result = P.run(spark, sf)
    assert {"llm-stage-mix_sources"} <= shared() <= {"llm-stage-mix_sources", "llm-token-ids", "llm-pack-sums"}  # what the last stage reads
    assert sorted(map(key, result.select("doc_id", "doc_tokens").distinct().collect())) == sorted(tokens.items())


def test_tables_of_a_step_are_deleted(spark):
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError), step_tables(spark):
        assert materialise(spark.range(5), "inner").count() == 5 and len(set(os.listdir(folder)) - before) == 1
        1 / 0
    assert set(os.listdir(folder)) == before
    kept = materialise(spark.range(3), "outer")
    assert kept.count() == 3 and len(set(os.listdir(folder)) - before) == 1
