"""Quality-evaluation reports: score by channel (R4), behaviour counts
and the flag matrix (R7). ``summary`` groups the evaluations once for R4 and R6."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.dates import as_date, on_or_after
from ..functions.folding import fold
from ..operators.filters import in_list, is_true, text_is
from ..params import FlagOptions, QaOptions, Scope

MEASURES = ("n", "qa_sum", "qa_n", "low")


def measured(qa_eval: DataFrame, scope: Scope, opts: QaOptions, since: dt.date | None = None) -> DataFrame:
    """The evaluations (from ``since``; default: the month) as folded keys and measures."""
    rows = qa_eval.where(
        in_list(F.col("team"), scope.teams)
        & (F.col("reason") == F.lit(opts.reason))
        & (F.col("metric_type") == F.lit(opts.metric_type))
        & on_or_after(F.col("assigned_date"), scope.month_start if since is None else since))
    one = lambda cond: F.when(cond, 1).otherwise(0).cast("long")
    return rows.select(
        as_date(F.col("assigned_date")).alias("day"), "team", fold(F.col("channel"), opts.channel_map, keep_others=True).alias("channel"), "sentence",
        fold(F.col("moment"), opts.moment_map, keep_others=False).alias("moment"),
        F.lit(1).cast("long").alias("n"), scores.exact(F.col("qa_total")).alias("qa_sum"),
        one(F.col("qa_total").isNotNull()).alias("qa_n"), one(F.col("sentence_value").isin(list(opts.low_values))).alias("low"))


def summary(qa_eval: DataFrame, scope: Scope, opts: QaOptions) -> DataFrame:
    return measured(qa_eval, scope, opts).groupBy("team", "channel", "sentence", "moment").agg(*scores.combined(MEASURES))


def day_rows(qa_eval: DataFrame, scope: Scope, opts: QaOptions, first: dt.date) -> DataFrame:
    """The summary by day (``plans.state`` keeps it)."""
    return measured(qa_eval, scope, opts, first).groupBy("day", "team", "channel", "sentence", "moment").agg(*scores.combined(MEASURES))


def qa_by_channel(qa_eval: DataFrame | None, scope: Scope, opts: QaOptions, rows: DataFrame | None = None) -> DataFrame:
    """Per team and folded channel, evaluations, average QA score in
    percent (1 dp) and on a 0-2 scale (2 dp), month to date."""
    rows = measured(qa_eval, scope, opts) if rows is None else rows
    average = scores.mean("qa_sum", "qa_n")
    return (rows.groupBy("team", "channel")
            .agg(scores.n_rows().alias("total"),
                 F.round(average * F.lit(100.0), 1).alias("pct"),
                 F.round(average * F.lit(2.0), 2).alias("grade")))


def behaviour_counts(qa_eval: DataFrame | None, scope: Scope, opts: QaOptions, rows: DataFrame | None = None) -> DataFrame:
    """Per team, behaviour sentence and folded moment (unlisted moments
    are NULL), evaluations and how many were rated low."""
    rows = measured(qa_eval, scope, opts) if rows is None else rows
    return (rows.where(F.col("sentence").isNotNull()).groupBy("team", "sentence", "moment")
            .agg(scores.n_rows().alias("total_cases"), F.sum("low").alias("low_count")))


def flagged(qa_flags: DataFrame, scope: Scope, opts: FlagOptions, since: dt.date | None = None) -> DataFrame:
    """Valid non-duplicate flagged answers (``IS TRUE`` flags, answer text 'true'
    in any case) from ``since`` (default: the month), each counting 1."""
    rows = qa_flags.where(
        is_true(F.col("is_valid"))
        & is_true(F.col("not_dup"))
        & (F.col("reason") == F.lit(opts.reason))
        & text_is(F.col("picklist_value"), opts.flag_true_text)
        & (F.col("inappropriate") == F.lit(0))
        & on_or_after(F.col("reference_date"), scope.month_start if since is None else since)
        & in_list(F.col("team"), scope.teams))
    return rows.select(as_date(F.col("reference_date")).alias("day"), "team", "flag_type", "flag", F.lit(1).cast("long").alias("n"))


def flag_days(qa_flags: DataFrame, scope: Scope, opts: FlagOptions, first: dt.date) -> DataFrame:
    """Flagged answers counted by day (``plans.state`` keeps it)."""
    return flagged(qa_flags, scope, opts, first).groupBy("day", "team", "flag_type", "flag").agg(F.sum("n").alias("n"))


def flag_matrix(qa_flags: DataFrame | None, scope: Scope, opts: FlagOptions, rows: DataFrame | None = None) -> DataFrame:
    """Per team, flag type and flag, the month's flagged answers."""
    rows = flagged(qa_flags, scope, opts) if rows is None else rows
    return rows.groupBy("team", "flag_type", "flag").agg(F.sum("n").alias("total"))
