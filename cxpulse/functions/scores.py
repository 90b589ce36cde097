"""Measures of score rows and the aggregates over them.

Reports aggregate *measures* (counts and exact decimal sums), not raw columns,
so the same expressions run over single rows and over rows that were already
combined (see ``plans.survey.summary``). Sums are DECIMAL: they do not depend
on the order in which tasks deliver their parts.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"
# a plain decimal literal; type suffixes, hexadecimal floats, NaN and infinities are none
_NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"


def _hundred() -> Column:
    """A DOUBLE 100 (the SQL literal 100.0 would be DECIMAL in Spark)."""
    return F.lit(100.0)


def to_number(text: Column) -> Column:
    """Text to DOUBLE; anything but a finite decimal literal is NULL (never raises)."""
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def exact(value: Column) -> Column:
    """A DOUBLE as DECIMAL (NULL if it does not fit)."""
    return value.try_cast(EXACT)


def measures(score: Column, target_text: Column) -> list[Column]:
    """Per-row measures: n, pro, neu, det, score_sum, score_n, target_sum, target_n."""
    target = exact(to_number(target_text))
    one = lambda cond: F.when(cond, 1).otherwise(0).cast("long")
    return [
        F.lit(1).cast("long").alias("n"), one(score > 0).alias("pro"), one(score == 0).alias("neu"), one(score < 0).alias("det"),
        exact(score).alias("score_sum"), one(score.isNotNull()).alias("score_n"),
        target.alias("target_sum"), one(target.isNotNull()).alias("target_n"),
    ]


MEASURES = ("n", "pro", "neu", "det", "score_sum", "score_n", "target_sum", "target_n")


def combined(names: Sequence[str] = MEASURES) -> list[Column]:
    """Aggregates that add measures up to measures again."""
    return [F.sum(m).alias(m) for m in names]


def n_rows() -> Column:
    """Number of answers: NULL scores still count (they lower the net score)."""
    return F.sum("n")


def net_score(digits: int = 1) -> Column:
    """(promoters - detractors) * 100 / all answers, rounded half-up."""
    return F.round((F.sum("pro") - F.sum("det")) * _hundred() / F.sum("n"), digits)


def mean(total: str, count: str) -> Column:
    """Average from a sum and a count measure; NULL without values."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(count))


def target_pct(digits: int = 1) -> Column:
    """Average target given as a fraction, as a percentage."""
    return F.round(mean("target_sum", "target_n") * _hundred(), digits)


def share_of(count: Column, total: Column, digits: int = 1) -> Column:
    """``count * 100 / total``, rounded (for totals see ``operators.totals``)."""
    return F.round(count * _hundred() / total, digits)


def safe_ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator."""
    return F.try_divide(num, den)


def sum_of_sums(cols: Sequence[str | Column]) -> Column:
    """SUM(a) + SUM(b) + ...: one bucket that is all NULL makes it NULL,
    single NULLs are skipped (unlike SUM(a + b + ...))."""
    sums = [F.sum(c) for c in cols]
    return functools.reduce(operator.add, sums)


def target_or_default(target: Column, default: float, zero_is_missing: bool) -> Column:
    """Effective target. Two rules exist: one treats 0 as missing, one not."""
    t = F.nullif(target, F.lit(0.0)) if zero_is_missing else target
    return F.coalesce(t, F.lit(float(default)))
