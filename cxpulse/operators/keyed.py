"""Rows to nested values: per-key arrays and a key -> struct map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .guard import within_bytes

MAX_MAP_BYTES = 64 * 1024 * 1024


def sorted_array(fields: Sequence[Column]) -> Column:
    """``collect_list(struct(...))`` sorted by the struct's leading fields.

    ``collect_list`` order is not defined after a shuffle, so the order is
    carried as data: put the sort keys first in ``fields``. Use it only on
    groups already limited (top-k) or bounded by a dimension.
    """
    return F.array_sort(F.collect_list(F.struct(*fields)))


def keyed_map(df: DataFrame, key: str, value_cols: Sequence[str],
              out_col: str = "by_key", max_bytes: int = MAX_MAP_BYTES) -> DataFrame:
    """One row holding ``{key: {value_cols...}}`` with entries in key order.

    Spark rejects duplicate map keys by default; the input must be unique
    per key (a group-by on ``key`` guarantees it). The result is a single
    value, so this is for aggregated report outputs whose size is bounded
    by the key's dimension (e.g. one row per team); the bytes are added up
    before anything is collected, more than ``max_bytes`` fail the job.
    """
    size = F.octet_length(F.to_json(F.struct(key, *value_cols)))
    df = within_bytes(df, size, max_bytes, f"map by {key}")
    entry = F.struct(F.col(key).alias("key"),
                     F.struct(*[F.col(c) for c in value_cols]).alias("value"))
    entries = F.array_sort(F.collect_list(entry))
    return df.agg(F.map_from_entries(entries).alias(out_col))
