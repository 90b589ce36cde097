"""Measures kept between refreshes, one table per source, partitioned by day.

The measures of the reports add up (counts, exact sums, sketches), so a day is
computed once and kept. A refresh names the days that are new or were corrected;
``replace`` reads those days of the inputs only, and replaces their partitions
(dynamic partition overwrite: other days are not touched, a run that fails leaves
the old ones, a run that is repeated gives the same table). Reports then roll up
from the kept rows and equal those of a full run.

A day without rows is kept too, by a marker row, so that rows deleted from an
input disappear with the next replacement. What is kept depends on teams,
segment, office and the value lists; its folder is named after them, so
measures made under other options are never mixed in.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, within
from ..params import AgentTimeOptions, FlagOptions, QaOptions, Scope
from . import agents as ag
from . import qa
from . import survey as sv

MARKER = "_no_row"


class State:
    """Day tables under ``folder``. ``sketch_k`` keeps cohorts as sketches."""

    def __init__(self, spark: SparkSession, folder: str, scope: Scope, qa_opts: QaOptions,
                 flag_opts: FlagOptions, time_opts: AgentTimeOptions, sketch_k: int | None = None):
        self.spark, self.scope, self.sketch_k = spark, scope, sketch_k
        self.qa, self.flags, self.time = qa_opts, flag_opts, time_opts
        made_by = repr((scope.teams, scope.segment, scope.office, qa_opts, flag_opts, time_opts, sketch_k))
        self.folder = os.path.join(folder, f"days-{hashlib.sha256(made_by.encode()).hexdigest()[:16]}")

    def _sources(self) -> dict[str, tuple[str, str, Callable[[DataFrame, dt.date], DataFrame]]]:
        """table -> (input, its date column, day rows of an input from a date)."""
        sc = self.scope
        return {
            "survey": ("survey", "response_date", lambda df, first: sv.day_rows(df, sc, first, self.sketch_k)),
            "agents": ("survey", "response_date", lambda df, first: ag.segment_agent_days(df, sc)),
            "qa": ("qa_eval", "assigned_date", lambda df, first: qa.day_rows(df, sc, self.qa, first)),
            "flags": ("qa_flags", "reference_date", lambda df, first: qa.flag_days(df, sc, self.flags, first)),
            "time": ("agent_time", "work_date", lambda df, first: ag.time_days(df, sc, self.time)),
            "status": ("training_status", "work_date", lambda df, first: ag.status_days(df, self.time)),
        }

    def path(self, table: str) -> str:
        return os.path.join(self.folder, table)

    def day_rows(self, table: str, inputs, days: Iterable[dt.date]) -> DataFrame:
        """The rows to keep for ``days``, from those days of the input alone (the
        range is pushed to the scan; days in between that are not named are dropped)."""
        days = sorted(set(days))
        source, column, rows = self._sources()[table]
        df = getattr(inputs, source)
        df = df.where(within(F.col(column), days[0], days[-1] + dt.timedelta(days=1)))
        if len(days) <= (days[-1] - days[0]).days:
            df = df.where(as_date(F.col(column)).isin(days))
        return rows(df, days[0])

    def replace(self, inputs, days: Iterable[dt.date], tables: Iterable[str] | None = None) -> None:
        """Compute ``days`` anew from ``inputs`` (``refresh.Inputs``) and put them
        in place of what was kept for them."""
        days = sorted(set(days))
        if not days:
            return
        markers = self.spark.createDataFrame([(d, True) for d in days], f"day date, {MARKER} boolean")
        for table in tables or self._sources():
            rows = self.day_rows(table, inputs, days).withColumn(MARKER, F.lit(False))
            rows = rows.unionByName(markers, allowMissingColumns=True).hint("rebalance", "day")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path(table))

    def rows(self, table: str, first: dt.date | None = None, past: dt.date | None = None) -> DataFrame:
        """Kept rows of the days from ``first`` to before ``past``."""
        df = self.spark.read.parquet(self.path(table)).withColumn("day", F.col("day").cast("date"))
        if first is not None:
            df = df.where(F.col("day") >= F.lit(first))
        if past is not None:
            df = df.where(F.col("day") < F.lit(past))
        return df.where(~F.col(MARKER)).drop(MARKER)

    def report_rows(self, weeks_back: int = 4) -> dict[str, DataFrame]:
        """What the reports take instead of facts, by the argument names of
        ``refresh.build_reports``."""
        sc = self.scope
        month = (sc.month_start, sc.next_month_start)
        return {
            "survey_rows": sv.of_days(self.rows("survey"), sc, weeks_back),
            "qa_rows": self.rows("qa", sc.month_start),
            "flag_rows": self.rows("flags", sc.month_start),
            "time_rows": self.rows("time", *month),
            "status_rows": self.rows("status", *month),
            "agents": self.rows("agents").select("agent").distinct(),
        }
