"""Top-k rows per key.

``row_number() <= k`` over a key partition is planned by Spark as a
``WindowGroupLimit`` (a partial limit before the shuffle and a final one
after), so only k rows per key and map task cross the network: no custom
top-k operator is needed, and a hot key costs k rows, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per ``keys`` by ``order``; number them
    1..k in ``rank_col``. ``order`` must end with a unique column so ties
    resolve the same way on every run and partitioning."""
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  rank_col: str = "rank") -> DataFrame:
    return top_k(df, keys, order, 1, rank_col).drop(rank_col)
