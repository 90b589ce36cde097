"""Measures kept between refreshes (A4-A7): day tables, sketches, the stream."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cxpulse.params import AgentTimeOptions, FlagOptions, QaOptions, Scope
from cxpulse.plans import agents as ag
from cxpulse.plans import qa, stream
from cxpulse.plans import refresh as rf
from cxpulse.plans import survey as sv
from cxpulse.plans.state import State
from cxpulse.session import checkpoint_dir
from cxpulse.testbed import adapters as tb
from cxpulse.testbed import queries as q

from .conftest import SF001, rows
from .test_properties import QA as QA_OPTS
from .test_properties import QA_SCHEMA, gen_qa, gen_survey
from .test_reports import SURVEY_SCHEMA

SCOPE = Scope(teams=("A", "B", "C"), as_of=dt.date(2024, 3, 15), segment="N", office="O")
TIME = AgentTimeOptions(role="r", buckets=("x", "y"), training_bucket="y", excluded_status="no")
FLAGS = FlagOptions(reason="R")
DAYS = [dt.date(2024, 3, 1) + dt.timedelta(days=k) for k in range(9)]


def folder(spark, name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir=checkpoint_dir(spark))


@pytest.fixture
def inputs(spark):
    qa_rows = [(*r[:4], DAYS[k % 8], *r[5:]) for k, r in enumerate(gen_qa(4))]
    flags = [("ABC"[k % 3], f"t{k % 2}", f"f{k % 5}", True, True, "R", "TRUE", 0, DAYS[k % 7]) for k in range(200)]
    time = [(k % 30, "ABC"[k % 3], "r", DAYS[k % 9], k, None if k % 3 == 0 else 2 * k) for k in range(400)]
    status = [(k % 30, DAYS[k % 9], ["no", "yes", None][k % 3]) for k in range(300)] + [(1, DAYS[1], "yes")] * 2
    return rf.Inputs(
        spark.createDataFrame([(*r[:2], DAYS[r[2].day % 9], *r[3:]) for r in gen_survey(5)], SURVEY_SCHEMA), spark.createDataFrame(qa_rows, QA_SCHEMA),
        spark.createDataFrame(flags, "team string, flag_type string, flag string, is_valid boolean, not_dup boolean, reason string, picklist_value string, inappropriate int, reference_date date"),
        spark.createDataFrame(time, "agent long, team string, role string, work_date date, x_s long, y_s long"),
        spark.createDataFrame(status, "agent long, work_date date, status string"), None)


def reports(inp, **kept):
    sc = SCOPE
    return {
        "r1": sv.net_score_monthly(inp.survey, sc, rows=kept.get("survey_rows")), "r2": sv.score_weekly(inp.survey, sc, rows=kept.get("survey_rows")),
        "r3": sv.score_by_process(inp.survey, sc, rows=kept.get("survey_rows")), "r8": sv.driver_detail(inp.survey, sc, rows=kept.get("survey_rows")),
        "r4": qa.qa_by_channel(inp.qa_eval, sc, QA_OPTS, rows=kept.get("qa_rows")), "r6": qa.behaviour_counts(inp.qa_eval, sc, QA_OPTS, rows=kept.get("qa_rows")),
        "r7": qa.flag_matrix(inp.qa_flags, sc, FLAGS, rows=kept.get("flag_rows")),
        "r5": ag.training_share(inp.agent_time, inp.training_status, inp.survey, sc, TIME, kept.get("time_rows"), kept.get("status_rows"), kept.get("agents"))}


def only(inp, cond):
    """The inputs' rows of the days that meet ``cond`` (a function of a date column)."""
    on = lambda df, c: df.where(cond(F.col(c)))
    return rf.Inputs(on(inp.survey, "response_date"), on(inp.qa_eval, "assigned_date"), on(inp.qa_flags, "reference_date"),
                     on(inp.agent_time, "work_date"), on(inp.training_status, "work_date"), None)


def test_reports_from_kept_days_equal_a_full_run(spark, inputs):
    state = State(spark, folder(spark, "state"), SCOPE, QA_OPTS, FLAGS, TIME)
    state.replace(inputs, DAYS)
    want, got = reports(inputs), reports(rf.Inputs(*[None] * 6), **state.report_rows())
    assert {k: rows(v) for k, v in got.items()} == {k: rows(v) for k, v in want.items()}
    assert all(rows(v) for v in want.values())


def test_a_refresh_reads_the_new_day_only(spark, inputs):
    """The second refresh sees inputs whose other days were emptied: it must equal
    a full run all the same, and replace what was kept of the new day."""
    new = DAYS[4]
    state = State(spark, folder(spark, "state"), SCOPE, QA_OPTS, FLAGS, TIME)
    state.replace(only(inputs, lambda c: c != F.lit(new)), DAYS)
    without = {k: rows(v) for k, v in reports(rf.Inputs(*[None] * 6), **state.report_rows()).items()}
    state.replace(only(inputs, lambda c: c == F.lit(new)), [new])
    state.replace(only(inputs, lambda c: c == F.lit(new)), [new], ["survey", "time"])     # repeated: the same table
    got = {k: rows(v) for k, v in reports(rf.Inputs(*[None] * 6), **state.report_rows()).items()}
    assert got == {k: rows(v) for k, v in reports(inputs).items()} and got != without
    state.replace(only(inputs, lambda c: F.lit(False)), [new])               # its rows were deleted
    assert {k: rows(v) for k, v in reports(rf.Inputs(*[None] * 6), **state.report_rows()).items()} == without


def test_the_days_reach_the_scan(spark):
    path = folder(spark, "survey")
    tb.survey(spark, SF001).write.mode("overwrite").parquet(path)
    state = State(spark, folder(spark, "state"), tb.scope(), tb.QA, tb.FLAGS, tb.AGENT_TIME)
    inp = rf.Inputs(spark.read.parquet(path), *[None] * 5)
    day = dt.date(2024, 1, 9)
    for table in ("survey", "agents"):
        plan = state.day_rows(table, inp, [day])._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "FileScan" in line][0].split("PushedFilters")[1]
        assert "GreaterThanOrEqual(response_date,2024-01-09" in pushed and "LessThan(response_date,2024-01-10" in pushed


def test_other_options_use_other_tables(spark):
    make = lambda **kw: State(spark, "/x", SCOPE, kw.get("qa", QA_OPTS), FLAGS, TIME, kw.get("k")).folder
    assert len({make(), make(k=12), make(qa=QaOptions("other", "M"))}) == 3 and make() == make()


def test_refresh_with_state(spark):
    """The refresh job over kept days; days of evaluations and flags that are not
    named are not read, so those two reports hold the named days."""
    slots = [s.slot for s in rf.DEFAULT_PAYLOADS]
    inp, opt, at = q.inputs(spark, SF001), q.options(), tb.REFRESHED_AT
    pages = tb.pages_with_slots(spark, SF001, slots)
    out, state = folder(spark, "kept"), folder(spark, "state")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(31)]
    counts = rf.run_refresh(spark, inp, opt, pages, out, at, state_dir=state, days=days)
    want = rf.build_reports(inp, opt)
    for name in ("net_score_monthly", "score_by_process", "driver_detail", "training_share"):
        assert rows(spark.read.parquet(os.path.join(out, "reports", name))) == rows(want[name]), name
    assert counts["payloads"] == 6 and counts["reports/critical_process_report"] == 4
    with pytest.raises(ValueError):
        rf.run_refresh(spark, inp, opt, pages, out, at, state_dir=state, rule=rf.StopRule())


# --- A4: sketches --------------------------------------------------------------


def many_cohorts(spark, n):
    """Two drivers with n and n / 10 distinct cohorts, each answer twice."""
    df = spark.range(2 * n).selectExpr(
        "'A' as team", "id as agent", "date'2024-03-02' as response_date", "'desk' as channel", "'P' as process",
        f"case when id % 10 = 0 then 'd2' else 'd1' end as driver", "100.0d as score", "'0.5' as target_text", "'N' as segment", "true as on_target_channel", "'O' as office",
        f"concat('t', id % {n}) as training_id")
    return df


def test_sketched_cohorts_within_their_error_and_a_smaller_summary(spark):
    n = 40_000
    df = many_cohorts(spark, n)
    exact, sketched = sv.summary(df, SCOPE), sv.summary(df, SCOPE, sketch_k=12)
    assert exact.count() == n and sketched.count() == 2 and "training_id" not in sketched.columns
    got = {r["driver"]: r["cohorts"] for r in sv.driver_detail(None, SCOPE, rows=sketched).collect()}
    want = {r["driver"]: r["cohorts"] for r in sv.driver_detail(None, SCOPE, rows=exact).collect()}
    assert want == {"d1": n - n // 10, "d2": n // 10}
    assert all(abs(got[d] - want[d]) <= 4 * 0.0163 * want[d] for d in want)       # four standard errors


def test_sketches_merge_over_days(spark, inputs):
    state = State(spark, folder(spark, "state"), SCOPE, QA_OPTS, FLAGS, TIME, sketch_k=12)
    state.replace(inputs, DAYS, ["survey"])
    kept = sv.of_days(state.rows("survey"), SCOPE)
    assert rows(sv.driver_detail(None, SCOPE, rows=kept)) == rows(sv.driver_detail(inputs.survey, SCOPE))   # few cohorts: exact


# --- the stream ------------------------------------------------------------------


def arrive(df, path):
    df.write.mode("append").parquet(path)


def test_stream_equals_the_batch_report_and_late_rows_stay_out(spark, inputs):
    base = folder(spark, "stream")
    survey, source = inputs.survey, os.path.join(base, "in")
    parts = [(DAYS[0], DAYS[5]), (DAYS[5], DAYS[8] + dt.timedelta(days=1))]
    read = lambda: spark.readStream.schema(survey.schema).parquet(source)
    stored = lambda: spark.read.schema(survey.schema).parquet(source)
    for first, past in parts:
        arrive(survey.where((F.col("response_date") >= F.lit(first)) & (F.col("response_date") < F.lit(past))), source)
        run = stream.start(read(), SCOPE, base, "3 days")
        run.awaitTermination()
        assert stream.dropped(run) == 0
        kept = stream.rows(spark, base, stored(), SCOPE)
        assert rows(sv.score_weekly(None, SCOPE, rows=kept)) == rows(sv.score_weekly(stored(), SCOPE))
        assert rows(sv.net_score_monthly(None, SCOPE, rows=kept)) == rows(sv.net_score_monthly(stored(), SCOPE))
    closed = stream.closed_days(spark, base)
    last = survey.agg(F.max("response_date")).first()[0]
    assert closed.agg(F.max("day")).first()[0] < last - dt.timedelta(days=2)      # the latest days are still open
    before = rows(sv.score_weekly(None, SCOPE, rows=stream.rows(spark, base, stored(), SCOPE)))
    late = survey.where(F.col("team") == "A").limit(1).select(*[F.lit(DAYS[1]).alias(c) if c == "response_date" else (
        F.lit({"team": "A", "segment": "N", "office": "O"}[c]).alias(c) if c in ("team", "segment", "office") else (F.lit(True).alias(c) if c == "on_target_channel" else F.col(c))) for c in survey.columns])
    arrive(late, source)
    run = stream.start(read(), SCOPE, base, "3 days")
    run.awaitTermination()
    assert stream.dropped(run) == 1
    assert rows(sv.score_weekly(None, SCOPE, rows=stream.rows(spark, base, stored(), SCOPE))) == before
    assert rows(sv.score_weekly(stored(), SCOPE)) != before                        # a batch over the facts does see it


def test_stream_before_the_first_day_is_closed(spark, inputs):
    base = folder(spark, "stream")
    assert stream.closed_days(spark, base).count() == 0
    kept = stream.rows(spark, base, inputs.survey, SCOPE)
    assert rows(sv.score_weekly(None, SCOPE, rows=kept)) == rows(sv.score_weekly(inputs.survey, SCOPE))
