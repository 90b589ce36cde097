"""Readers for the logical input tables.

A table is either a catalog name (``spark.table``) or a Parquet path. The
readers only declare the scan; filters and projections added by the
reports are pushed into it by Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from . import schemas


def read(spark: SparkSession, source: str) -> DataFrame:
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_survey(spark: SparkSession, source: str) -> DataFrame:
    return schemas.conform(read(spark, source), schemas.SURVEY, name="survey")


def read_qa_eval(spark: SparkSession, source: str) -> DataFrame:
    return schemas.conform(read(spark, source), schemas.QA_EVAL, name="qa_eval")


def read_qa_flags(spark: SparkSession, source: str) -> DataFrame:
    return schemas.conform(read(spark, source), schemas.QA_FLAGS, name="qa_flags")


def read_agent_time(spark: SparkSession, source: str, buckets: Iterable[str]) -> DataFrame:
    return schemas.conform(read(spark, source), schemas.agent_time(buckets), name="agent_time")


def read_training_status(spark: SparkSession, source: str) -> DataFrame:
    return schemas.conform(read(spark, source), schemas.TRAINING_STATUS,
                           name="training_status")
