"""The refresh job: all reports, their payloads, and the published pages.

Every fact table is scanned once: the survey and the evaluations are grouped
once into summaries (``survey.summary``, ``qa.summary``), which are written to a
shared folder, and the reports roll up from those. Only the training share reads
the survey once more, for its agents of all dates. With a state folder only the
days named are read at all (``plans.state``). ``run_refresh`` writes each report in
presentation order, builds the critical-process report and the payloads from the
written tables, writes all rows as JSON texts partitioned by report, and publishes
the pages. Row counts are observed metrics, not extra jobs.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import on_or_after
from ..operators.filters import month_rows
from ..params import DEFAULT_TARGET, AgentTimeOptions, FlagOptions, QaOptions, Scope
from ..session import checkpoint_dir, written
from ..sources import schemas
from ..sources.schemas import conform
from . import agents as ag
from . import critical as cr
from . import qa
from . import survey as sv
from .order import ORDER, presented
from .publish import PayloadSpec, StampSpec, payloads, publish_pages, write_report_rows
from .quality import StopRule, Watch, qa_checks, status_checks, survey_checks
from .state import State

# The six payloads a page embeds, in the order they are injected.
DEFAULT_PAYLOADS = (
    PayloadSpec("NET_SCORE_MONTHLY", "monthly", ORDER["net_score_monthly"]),
    PayloadSpec("SCORE_WEEKLY", "weekly", ORDER["score_weekly"]),
    PayloadSpec("SCORE_BY_PROCESS", "byProcess", ORDER["score_by_process"]),
    PayloadSpec("QA_BY_CHANNEL", "qaByChannel", ORDER["qa_by_channel"]),
    PayloadSpec("TRAINING_SHARE", "trainingShare", key="team"),
    PayloadSpec("CRITICAL_PROCESS", "criticalProcess", key="team"),
)

# report name -> payload name
PAYLOAD_OF = {
    "net_score_monthly": "NET_SCORE_MONTHLY",
    "score_weekly": "SCORE_WEEKLY",
    "score_by_process": "SCORE_BY_PROCESS",
    "qa_by_channel": "QA_BY_CHANNEL",
    "training_share": "TRAINING_SHARE",
    "critical_process_report": "CRITICAL_PROCESS",
}


@dataclass(frozen=True)
class Inputs:
    survey: DataFrame
    qa_eval: DataFrame
    qa_flags: DataFrame
    agent_time: DataFrame
    training_status: DataFrame
    catalog: DataFrame

    def conformed(self, buckets: tuple[str, ...]) -> "Inputs":
        """The inputs with their columns and types checked (``sources.schemas``)."""
        return Inputs(
            conform(self.survey, schemas.SURVEY, name="survey"), conform(self.qa_eval, schemas.QA_EVAL, name="qa_eval"),
            conform(self.qa_flags, schemas.QA_FLAGS, name="qa_flags"), conform(self.agent_time, schemas.agent_time(buckets), name="agent_time"),
            conform(self.training_status, schemas.TRAINING_STATUS, name="training_status"), self.catalog)


@dataclass(frozen=True)
class Options:
    scope: Scope
    qa: QaOptions
    flags: FlagOptions
    agent_time: AgentTimeOptions
    agent_channel_map: dict
    texts: cr.CoachingTexts
    default_target: float = DEFAULT_TARGET
    include_agent_detail: bool = False
    # keep distinct cohorts as sketches of 2 ** sketch_k cells instead of exactly
    sketch_k: int | None = None


def summaries(inp: Inputs, opt: Options, watch: Watch | None = None) -> tuple[DataFrame, DataFrame]:
    """The survey and evaluation summaries, written once. ``watch`` observes the
    rows of their periods in the same pass."""
    survey, qa_eval = inp.survey, inp.qa_eval
    if watch:
        survey = watch.over(survey.where(on_or_after(F.col("response_date"), sv.weekly_since(opt.scope, 4))), "survey", survey_checks())
        qa_eval = watch.over(qa_eval.where(on_or_after(F.col("assigned_date"), opt.scope.month_start)), "qa_eval", qa_checks())
    return (written(sv.summary(survey, opt.scope, sketch_k=opt.sketch_k), "survey-summary"),
            written(qa.summary(qa_eval, opt.scope, opt.qa), "qa-summary"))


def month_status(inp: Inputs, opt: Options, watch: Watch | None = None) -> DataFrame:
    """Status rows of the month by agent and day, observed by ``watch``."""
    status = ag.status_days(month_rows(inp.training_status, "work_date", opt.scope), opt.agent_time)
    return watch.over(status, "training_status", status_checks()) if watch else status


def build_reports(inp: Inputs, opt: Options, survey_rows: DataFrame | None = None, qa_rows: DataFrame | None = None,
                  flag_rows: DataFrame | None = None, time_rows: DataFrame | None = None, status_rows: DataFrame | None = None,
                  agents: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every report as a lazy DataFrame; R1, R2, R3, R8 roll up from
    ``survey_rows``, R4 and R6 from ``qa_rows`` (see ``summaries``) if given, R7 and
    R5 from the others (see ``State.report_rows``)."""
    sc = opt.scope
    inp = inp.conformed(opt.agent_time.buckets)
    reports = {
        "net_score_monthly": sv.net_score_monthly(inp.survey, sc, rows=survey_rows),
        "score_weekly": sv.score_weekly(inp.survey, sc, rows=survey_rows),
        "score_by_process": sv.score_by_process(inp.survey, sc, rows=survey_rows),
        "qa_by_channel": qa.qa_by_channel(inp.qa_eval, sc, opt.qa, rows=qa_rows),
        "training_share": ag.training_share(inp.agent_time, inp.training_status, inp.survey,
                                            sc, opt.agent_time, time_rows, status_rows, agents),
        "driver_detail": sv.driver_detail(inp.survey, sc, rows=survey_rows),
        "behaviour_counts": qa.behaviour_counts(inp.qa_eval, sc, opt.qa, rows=qa_rows),
        "flag_matrix": qa.flag_matrix(inp.qa_flags, sc, opt.flags, rows=flag_rows),
    }
    if opt.include_agent_detail:
        reports["agent_detail"] = ag.agent_detail(inp.survey, inp.agent_time, sc, opt.agent_time,
                                                  opt.agent_channel_map, opt.default_target)
    reports["critical_process_report"] = critical_from(reports, inp.catalog, opt)
    return reports


def critical_from(reports: dict[str, DataFrame], catalog: DataFrame, opt: Options) -> DataFrame:
    return cr.critical_process_report(reports["score_by_process"], reports["driver_detail"],
                                      reports["behaviour_counts"], catalog, opt.texts, opt.default_target)


def payload_reports(reports: dict[str, DataFrame],
                    specs=DEFAULT_PAYLOADS) -> dict[str, DataFrame]:
    by_payload = {PAYLOAD_OF[name]: df for name, df in reports.items() if name in PAYLOAD_OF}
    return {s.name: by_payload[s.name] for s in specs}


def run_refresh(spark: SparkSession, inp: Inputs, opt: Options, pages: DataFrame,
                out_dir: str | None, refreshed_at: dt.datetime, stamp: StampSpec = StampSpec(),
                specs=DEFAULT_PAYLOADS, state_dir: str | None = None, days: Iterable[dt.date] | None = None,
                rule: StopRule | None = None) -> dict[str, int]:
    """Materialise reports, payloads and pages under ``out_dir``; return
    row counts per output (from observed metrics) and, with a ``rule``, the quality
    counts (``quality/<source>.<metric>``).

    ``state_dir``: keep day measures there (``plans.state``); ``days``, the new or
    corrected ones, are read and replaced, all else comes from what was kept. Without
    it every input is read from the start of its period. ``rule``: quality metrics
    are observed and checked before payloads are made (inputs that are read only
    for some days are not observed: a rule needs a run without state).

    ``out_dir=None`` writes under the shared folder the cluster names in
    ``spark.checkpoint.dir`` (one sub-folder per refresh time)."""
    if out_dir is None:
        run = refreshed_at.strftime("%Y%m%dT%H%M%S")
        out_dir = os.path.join(checkpoint_dir(spark), "cxpulse-refresh", run)
    counts: dict[str, int] = {}

    def write(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
        obs = Observation(name)
        path = os.path.join(out_dir, name)
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
        counts[name] = int(obs.get["rows"])
        return spark.read.format(fmt).load(path)

    checked = inp.conformed(opt.agent_time.buckets)
    watch = None
    if state_dir:
        if rule:
            raise ValueError("a stop rule needs a run without state")
        state = State(spark, state_dir, opt.scope, opt.qa, opt.flags, opt.agent_time, opt.sketch_k)
        state.replace(checked, days or ())
        rows = state.report_rows()
    else:
        watch = Watch() if rule else None
        rows = dict(zip(("survey_rows", "qa_rows"), summaries(checked, opt, watch)))
        rows["status_rows"] = month_status(checked, opt, watch)
    lazy = build_reports(inp, opt, **rows)
    done = {name: write(presented(df, name), f"reports/{name}")
            for name, df in lazy.items() if name != "critical_process_report"}
    if watch:
        found = watch.counts()
        rule.check(found)
        counts.update({f"quality/{source}.{k}": v for source, c in found.items() for k, v in c.items()})
    done["critical_process_report"] = write(critical_from(done, inp.catalog, opt), "reports/critical_process_report")
    write_report_rows(done, os.path.join(out_dir, "rows"))
    pay = write(payloads(payload_reports(done, specs), specs), "payloads")
    write(publish_pages(pages, pay, specs, refreshed_at, stamp), "pages")
    return counts
