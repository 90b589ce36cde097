"""Corpus pipeline: toxicity, exact dedup, near dedup, source mixing, packing.

Each stage is (name, function (spark, docs, sf_dir) -> DataFrame); all but the
last return the columns of documents. ``run`` writes each stage's result as
Parquet to the shared folder and hands the reread table to the next. What a
stage wrote on the way is deleted once its result is written, and so is the result
before it; the last stage's input and tables stay, for its rows are read later.

Repeated rows, nulls, empty tables: as the operators' docstrings say. A document
that mixing takes more than once arrives at packing as that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cxpulse.llm import exact_dedup, minhash, mixing, packing, toxicity
from cxpulse.llm.common import delete, materialise, own_folder, step_tables, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: A trained classifier, MinHash and a tokenizer have no SQL form; tests/llm
#: holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = own_folder(spark, f"stage-{name}")
        with step_tables(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
