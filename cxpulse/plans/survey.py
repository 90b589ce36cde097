"""Survey reports: net score by month (R1), score by week (R2), score by process
(R3) and driver detail (R8).

All four roll up from the same measures. ``summary`` groups the filtered survey
once by every key they need; pass it as ``rows`` and each report reads that small
table. Without it a report reads the filtered survey rows itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.dates import as_date, on_or_after, week_label
from ..operators.filters import non_blank, survey_rows
from ..operators.totals import with_totals
from ..params import Scope

SUMMARY_KEYS = ("team", "week", "in_month", "process", "driver", "training_id")
# the same without the cohort: its distinct counts are kept as a sketch
SKETCHED_KEYS = SUMMARY_KEYS[:-1]
COHORT_SKETCH = "cohort_sketch"


def weekly_since(scope: Scope, weeks_back: int) -> dt.date:
    return scope.month_start - dt.timedelta(weeks=weeks_back)


def measured(survey: DataFrame, scope: Scope, since: dt.date | None = None) -> DataFrame:
    """The filtered survey rows (from ``since``; default: the month) as keys and
    measures. Columns that a report does not use are pruned from the scan."""
    day = F.col("response_date")
    return survey_rows(survey, scope, since=since).select(
        "team", week_label(day).alias("week"), on_or_after(day, scope.month_start).alias("in_month"),
        "process", "driver", "training_id", "agent", "channel",
        *scores.measures(F.col("score"), F.col("target_text")))


def cohort_sketch(sketch_k: int) -> Column:
    """Aggregate: a mergeable sketch of the distinct cohorts, of 2 ** ``sketch_k``
    cells (relative standard error about 1.04 / sqrt(cells): 1.6 % for 12)."""
    return F.hll_sketch_agg(F.col("training_id").cast("string"), sketch_k).alias(COHORT_SKETCH)


def grouped(rows: DataFrame, keys: Sequence[str], sketch_k: int | None = None) -> DataFrame:
    """Measures combined by ``keys``; with ``sketch_k`` the cohorts as sketches."""
    kept = [cohort_sketch(sketch_k)] if sketch_k else []
    return rows.groupBy(*keys).agg(*scores.combined(), *kept)


def summary(survey: DataFrame, scope: Scope, weeks_back: int = 4, sketch_k: int | None = None) -> DataFrame:
    """One pre-aggregate for R1, R2, R3, R8: one row per ``SUMMARY_KEYS``, or,
    with ``sketch_k``, per ``SKETCHED_KEYS`` and with a cohort sketch: a cohort more
    or less then makes no row more, and R8's distinct counts are estimates."""
    rows = measured(survey, scope, weekly_since(scope, weeks_back))
    return grouped(rows, SKETCHED_KEYS if sketch_k else SUMMARY_KEYS, sketch_k)


def day_rows(survey: DataFrame, scope: Scope, first: dt.date, sketch_k: int | None = None) -> DataFrame:
    """The summary by day instead of week (``plans.state`` keeps it)."""
    rows = survey_rows(survey, scope, since=first).select(
        as_date(F.col("response_date")).alias("day"), "team", "process", "driver", "training_id", *scores.measures(F.col("score"), F.col("target_text")))
    keys = ["day", "team", "process", "driver"]
    return grouped(rows, keys if sketch_k else [*keys, "training_id"], sketch_k)


def of_days(days: DataFrame, scope: Scope, weeks_back: int = 4) -> DataFrame:
    """Day rows as the reports' ``rows``: the weekly period, with week and month."""
    rows = days.where(F.col("day") >= F.lit(weekly_since(scope, weeks_back)))
    return rows.withColumn("week", week_label(F.col("day"))).withColumn("in_month", F.col("day") >= F.lit(scope.month_start))


def _of_month(survey: DataFrame | None, scope: Scope, rows: DataFrame | None) -> DataFrame:
    return measured(survey, scope) if rows is None else rows.where("in_month")


def net_score_monthly(survey: DataFrame | None, scope: Scope, rows: DataFrame | None = None) -> DataFrame:
    """Per team, answers, promoters / passives / detractors and the net
    score, month to date."""
    return (_of_month(survey, scope, rows).groupBy("team")
            .agg(scores.n_rows().alias("enc"), F.sum("pro").alias("pro"), F.sum("neu").alias("neu"),
                 F.sum("det").alias("det"), scores.net_score().alias("nps_score")))


def score_weekly(survey: DataFrame | None, scope: Scope, weeks_back: int = 4, rows: DataFrame | None = None) -> DataFrame:
    """R2: per Monday-week and team, answers and the plain average score
    (not the net score), from ``weeks_back`` weeks before the month start.
    The first week may be partial: the bound is not week-aligned."""
    rows = measured(survey, scope, weekly_since(scope, weeks_back)) if rows is None else rows
    return (rows.groupBy("week", "team")
            .agg(scores.n_rows().alias("enc"),
                 F.round(scores.mean("score_sum", "score_n"), 1).alias("avg_score")))


def score_by_process(survey: DataFrame | None, scope: Scope, rows: DataFrame | None = None) -> DataFrame:
    """Per team and process (NULL is a process), answers, net score,
    average target in percent, and the process's share of the team."""
    agg = (_of_month(survey, scope, rows).groupBy("team", "process")
           .agg(scores.n_rows().alias("enc"), scores.net_score().alias("nps"), scores.target_pct().alias("target")))
    rows = with_totals(agg, ["team"], {"all": (F.sum, "enc")})
    return rows.withColumn("pct", scores.share_of(F.col("enc"), F.col("all"))).drop("all")


def driver_detail(survey: DataFrame | None, scope: Scope, min_n: int = 3, rows: DataFrame | None = None,
                  approximate: float | None = None) -> DataFrame:
    """Per team, process and driver (non-blank), answers, net score,
    average target, distinct cohorts, and the driver's share of its process.
    Groups with fewer than ``min_n`` answers are dropped *before* the share
    is computed, so the share's denominator excludes them.

    ``approximate``: relative error allowed for the distinct cohorts (a
    sketch instead of an exact count). Rows that hold sketches (``summary`` with
    ``sketch_k``) are merged and estimated."""
    month = _of_month(survey, scope, rows)
    if COHORT_SKETCH in month.columns:
        cohorts = F.hll_sketch_estimate(F.hll_union_agg(COHORT_SKETCH))
    else:
        cohorts = F.countDistinct("training_id") if approximate is None else F.approx_count_distinct("training_id", approximate)
    agg = (month.where(non_blank(F.col("driver")))
           .groupBy("team", "process", "driver")
           .agg(scores.n_rows().alias("enc"), scores.net_score().alias("nps_score"),
                scores.target_pct().alias("target"), cohorts.alias("cohorts"))
           .where(F.col("enc") >= min_n))
    rows = with_totals(agg, ["team", "process"], {"all": (F.sum, "enc")})
    return rows.withColumn("pct_in_proc", scores.share_of(F.col("enc"), F.col("all"))).drop("all")
