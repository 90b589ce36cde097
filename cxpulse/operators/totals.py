"""Totals over a parent key, on every row of the key.

A window by the key would bring all rows of the key into one task. Here the
totals are an ordinary aggregation (combined before the shuffle, so a task gets
one row per key and upstream task), and come back by a salted join: every total is
copied once per salt, every row carries a salt of its own (a hash of the row). A
hot key's rows so stay spread over ``SALTS`` tasks. Small totals are broadcast by
adaptive execution, then no row moves at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def with_totals(rows: DataFrame, keys: Sequence[str],
                totals: Mapping[str, tuple[Callable[[Column], Column], str]], salts: int = SALTS) -> DataFrame:
    """``rows`` plus, per ``keys`` (NULL is a key), the aggregates ``totals``
    (name -> (function, integer column)) over all rows of the key.

    The rows of a key should differ (as those of a group-by do). ``rows`` is used
    twice, and both uses refer to all its columns (the totals to no bit of the
    hash), so that they are one plan up to the last shuffle and Spark runs it once."""
    whole = F.xxhash64(*rows.columns)
    zero = whole.bitwiseAND(F.lit(0).cast("long"))
    per_key = rows.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        *[fn(F.col(column) + zero).alias(name) for name, (fn, column) in totals.items()])
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_own_salt", F.pmod(whole, F.lit(salts)).cast("int"))
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    joined = salted.join(copies, reduce(and_, same, F.col("_own_salt").eqNullSafe(F.col("_salt"))))
    return joined.select(*rows.columns, *totals)
