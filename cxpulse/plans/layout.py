"""Storage by agent: joins of agent time, status and survey without a shuffle.

``save`` writes an input bucketed by agent and sorted by agent and day. Rows of an
agent then lie in the same bucket of every table, so the aggregations by (team,
agent, day) and the joins on agent (J-1, J-3, J-4) need no exchange: each task reads
one bucket of each table. Written once, it serves every refresh; the number of
buckets must be the same for all tables.

``co_located`` is the setting under which Spark accepts tables bucketed by agent
for a join on agent and day (a subset of the keys); it is in force while the
report inside is planned and run.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date

_SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
DATE_OF = {"survey": "response_date", "agent_time": "work_date", "training_status": "work_date"}


def save(df: DataFrame, source: str, folder: str, buckets: int) -> DataFrame:
    """``df`` as a table under ``folder``, bucketed by agent, read back. The
    date column is stored as a date."""
    column = DATE_OF[source]
    name = f"cxpulse_{source}_{uuid.uuid4().hex}"
    stored = df.withColumn(column, as_date(F.col(column))).repartition(buckets, "agent")
    (stored.write.format("parquet").option("path", os.path.join(folder, name))
     .bucketBy(buckets, "agent").sortBy("agent", column).saveAsTable(name))
    return df.sparkSession.table(name)


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SUBSET_KEYS, "true")
    spark.conf.set(_SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET_KEYS, before)
