"""Positional picks in short arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick_clamped(arr: Column, index0: Column) -> Column:
    """Element ``min(i, n-1)`` of ``arr`` (0-based), NULL when ``arr`` is
    empty or NULL."""
    n = F.size(F.coalesce(arr, F.array()))
    idx = F.least(index0, n - 1)
    return F.when(n > 0, F.get(arr, idx))
