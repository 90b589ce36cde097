"""Value folding (CASE mappings)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(col: Column, mapping: Mapping[str, Sequence[str]], keep_others: bool) -> Column:
    """Map groups of raw values to a label.

    ``keep_others=True``: unlisted values pass through (channel folding);
    ``False``: they become NULL (moment folding).
    """
    expr = None
    for label, raw_values in mapping.items():
        cond = col.isin(list(raw_values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return col if keep_others else F.lit(None).cast("string")
    return expr.otherwise(col) if keep_others else expr
