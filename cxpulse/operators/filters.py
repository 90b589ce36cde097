"""Row filters shared by the reports.

All predicates are plain column expressions on literals (``In`` lists,
date ranges, equalities), so Catalyst pushes them into the Parquet scan;
``array_contains(:teams, col)`` would not be pushed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import on_or_after, within
from ..params import Scope


def in_list(col: Column, values: Sequence[str]) -> Column:
    """``col IN UNNEST(@param)``: NULL never matches."""
    return col.isin(list(values))


def is_true(col: Column) -> Column:
    """``IS TRUE``: never NULL (NULL -> false)."""
    return col.eqNullSafe(F.lit(True))


def equals_true(col: Column) -> Column:
    """``= TRUE``: NULL stays NULL, which a filter drops."""
    return col == F.lit(True)


def null_or_not(col: Column, value: str) -> Column:
    """``col IS NULL OR col <> value``: the null-tolerant exclusion."""
    return col.isNull() | (col != F.lit(value))


def non_blank(col: Column) -> Column:
    """Holds a character that is not Unicode white space (NULL does not)."""
    return F.coalesce(col.rlike(r"(?U)\S"), F.lit(False))


def text_is(col: Column, text: str) -> Column:
    """``LOWER(CAST(col AS STRING)) = text`` for any source type."""
    return F.lower(col.cast("string")) == F.lit(text.lower())


def survey_rows(survey: DataFrame, scope: Scope, since: dt.date | None = None) -> DataFrame:
    """The base survey filter: teams, segment, target channel, office and
    ``DATE(response_date) >= since`` (default: the month of ``as_of``, with an
    open upper bound)."""
    since = scope.month_start if since is None else since
    cond = in_list(F.col("team"), scope.teams) & (F.col("segment") == F.lit(scope.segment))
    cond = cond & equals_true(F.col("on_target_channel"))
    cond = cond & (F.col("office") == F.lit(scope.office))
    cond = cond & on_or_after(F.col("response_date"), since)
    return survey.where(cond)


def month_rows(df: DataFrame, date_col: str, scope: Scope) -> DataFrame:
    """Rows in the closed calendar month of ``as_of``."""
    return df.where(within(F.col(date_col), scope.month_start, scope.next_month_start))
