"""A size rule that is checked before rows are collected into one value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_bytes(rows: DataFrame, size: Column, limit: int, what: str) -> DataFrame:
    """``rows``, or an error if their ``size`` adds up to more than ``limit`` bytes.

    The total is an ordinary partial aggregate (one number per task crosses the
    network), and the rows are joined with that one row: it is checked where it is
    computed, so no task ever holds an oversized result. ``rows`` is read twice: use it on written or
    aggregated reports."""
    total = F.broadcast(rows.agg(F.sum(size).alias("_bytes")).withColumn("_one", F.lit(1)))  # one row
    fits = F.when(F.coalesce(F.col("_bytes"), F.lit(0)) <= limit, F.lit(True)).otherwise(F.raise_error(F.lit(f"{what} is over {limit} bytes")).cast("boolean"))
    return rows.withColumn("_one", F.lit(1)).join(total, "_one").where(fits).select(*rows.columns)
