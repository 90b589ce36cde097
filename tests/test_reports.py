"""Report tests on small literal frames with hand-computed results
(traps T4, T6, T7, T13 and the join shapes J-1..J-4)."""

import dataclasses
import datetime as dt

from cxpulse.params import AgentTimeOptions, FlagOptions, QaOptions, Scope
from cxpulse.plans import agents as ag
from cxpulse.plans import qa
from cxpulse.plans import survey as sv

from .conftest import rows

SCOPE = Scope(teams=("A", "B"), as_of=dt.date(2024, 3, 15), segment="N", office="O")
D = dt.date(2024, 3, 2)

SURVEY_SCHEMA = ("team string, agent long, response_date date, channel string, process string, "
                 "driver string, score double, target_text string, segment string, "
                 "on_target_channel boolean, office string, training_id long")


def srow(team="A", process="P", driver="X", score=100.0, target="0.5", d=D, agent=1,
         channel="desk", segment="N", on_target=True, office="O", training_id=1):
    return (team, agent, d, channel, process, driver, score, target, segment, on_target, office,
            training_id)


def survey(spark, data):
    return spark.createDataFrame(data, SURVEY_SCHEMA)


def test_base_filter(spark):
    data = [srow(), srow(team="Z"), srow(segment="S"), srow(on_target=None), srow(on_target=False),
            srow(office="Q"), srow(d=dt.date(2024, 2, 29)), srow(d=dt.date(2024, 4, 2))]
    r = sv.net_score_monthly(survey(spark, data), SCOPE).collect()
    # only the first row and the next-month row (open upper bound, T7) pass
    assert [(x.team, x.enc) for x in r] == [("A", 2)]


def test_net_score_monthly(spark):
    data = [srow(score=100.0), srow(score=100.0), srow(score=0.0), srow(score=-100.0),
            srow(score=None), srow(team="B", score=-100.0)]
    got = rows(sv.net_score_monthly(survey(spark, data), SCOPE))
    assert got == [("A", 5, 2, 1, 1, 20.0), ("B", 1, 0, 0, 1, -100.0)]


def test_score_weekly_partial_first_week(spark):
    scope = SCOPE.with_as_of(dt.date(2024, 3, 20))  # since = 2024-03-01 - 28 days = 2024-02-02
    data = [srow(d=dt.date(2024, 2, 1), score=100.0), srow(d=dt.date(2024, 2, 2), score=100.0),
            srow(d=dt.date(2024, 2, 4), score=0.0), srow(d=dt.date(2024, 2, 5), score=-100.0)]
    got = rows(sv.score_weekly(survey(spark, data), scope))
    assert got == [("2024-01-29", "A", 2, 50.0), ("2024-02-05", "A", 1, -100.0)]


def test_score_by_process_null_group_and_share_T13(spark):
    data = [srow(process="P", score=100.0, target="0.35"), srow(process="P", score=-100.0, target="x"),
            srow(process=None, score=100.0, target="0.7"), srow(process=None, score=100.0, target=None)]
    got = rows(sv.score_by_process(survey(spark, data), SCOPE))
    assert got == [("A", "P", 2, 0.0, 35.0, 50.0), ("A", None, 2, 100.0, 70.0, 50.0)]


def test_driver_detail_having_before_share_T4(spark):
    data = [srow(driver="X", training_id=1), srow(driver="X", training_id=2), srow(driver="X", training_id=2),
            srow(driver="Y"), srow(driver="Y"),                       # dropped: < 3 answers
            srow(driver=" "), srow(driver=" "), srow(driver=" "),     # blank driver
            srow(driver=None), srow(driver=None), srow(driver=None)]
    got = rows(sv.driver_detail(survey(spark, data), SCOPE),
               "driver", "enc", "cohorts", "pct_in_proc")
    assert got == [("X", 3, 2, 100.0)]  # 60.0 if the share were taken before HAVING


BUCKETS = ("work", "lesson", "rest")
AT_SCHEMA = ("agent long, team string, role string, work_date date, "
             + ", ".join(f"{b}_s long" for b in BUCKETS))
OPTS = AgentTimeOptions(role="agent", buckets=BUCKETS, training_bucket="lesson", excluded_status="away")


def atrow(agent=1, team="A", role="agent", d=D, training=360, online=3240):
    return (agent, team, role, d, online, training, 0)


def test_training_share_joins_T6(spark):
    facts = spark.createDataFrame([
        atrow(agent=1, d=D),                          # status DONE + NULL: fans out x2
        atrow(agent=1, d=dt.date(2024, 3, 3)),        # excluded status: dropped
        atrow(agent=2, d=D),                          # no status row: kept
        atrow(agent=3, d=D),                          # not in the survey segment: dropped
        atrow(agent=1, d=dt.date(2024, 4, 1)),        # next month: dropped (closed month)
        atrow(agent=2, d=D, role="lead"),             # other role
    ], AT_SCHEMA)
    status = spark.createDataFrame([(1, D, "DONE"), (1, D, None), (1, dt.date(2024, 3, 3), "away")],
                                   "agent long, work_date date, status string")
    surv = survey(spark, [srow(agent=1, d=dt.date(2023, 1, 1), on_target=False), srow(agent=2),
                          srow(agent=3, segment="S")])
    got = ag.training_share(facts, status, surv, SCOPE, OPTS).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.team, r.agents) == ("A", 2)
    assert r.h_train == round(3 * 360 / 3600, 2)
    assert r.h_logged == round(3 * 3600 / 3600, 2)
    assert r.pct == 10.0
    once = ag.training_share(facts, status, surv, SCOPE, dataclasses.replace(OPTS, dedupe_status=True)).first()
    assert (once.agents, once.h_logged) == (2, 2.0)


def test_training_share_by_key(spark):
    share = spark.createDataFrame([("B", 1, 2.0, 3.0, 4.0), ("A", 5, 6.0, 7.0, 8.0)],
                                  "team string, agents long, pct double, h_train double, h_logged double")
    m = ag.training_share_by_key(share).first()[0]
    assert list(m.keys()) == ["A", "B"]
    assert m["A"].agents == 5 and m["B"].pct == 2.0


def test_agent_detail_defaults(spark):
    surv = survey(spark, [srow(agent=1, channel="desk old", target=None),
                          srow(agent=2, channel="post", target="0.5")])
    facts = spark.createDataFrame([atrow(agent=2, training=0, online=0)], AT_SCHEMA)
    got = rows(ag.agent_detail(surv, facts, SCOPE, OPTS, {"at desk": ("desk", "desk old")}),
               "agent", "channel", "target", "pct_train", "h_train")
    # agent 1: no time rows -> 0; agent 2: all-zero time -> safe ratio NULL -> 0
    assert got == [(1, "at desk", 69.5, 0.0, 0.0), (2, "post", 50.0, 0.0, 0.0)]


QA_SCHEMA = ("team string, channel string, reason string, metric_type string, assigned_date date, "
             "qa_total double, sentence string, moment string, sentence_value string")
QA = QaOptions(reason="R", metric_type="M", channel_map={"at desk": ("desk", "desk old")},
               moment_map={"first": ("a", "b")}, low_values=("low",))


def test_qa_reports(spark):
    qe = spark.createDataFrame([
        ("A", "desk old", "R", "M", D, 0.5, "S1", "a", "low"),
        ("A", "desk", "R", "M", D, 1.0, "S1", "b", "high"),
        ("A", "post", "R", "M", D, 0.25, None, "zzz", "low"),
        ("A", "post", "X", "M", D, 0.25, "S1", "a", "low"),
    ], QA_SCHEMA)
    assert rows(qa.qa_by_channel(qe, SCOPE, QA)) == [("A", "at desk", 2, 75.0, 1.5),
                                                      ("A", "post", 1, 25.0, 0.5)]
    assert rows(qa.behaviour_counts(qe, SCOPE, QA)) == [("A", "S1", "first", 2, 1)]


def test_flag_matrix_is_true_semantics(spark):
    flags = spark.createDataFrame([
        ("A", "T", "F1", True, True, "check", "TRUE", 0, D),
        ("A", "T", "F1", True, True, "check", "true", 0, D),
        ("A", "T", "F1", None, True, "check", "true", 0, D),      # NULL valid flag: dropped
        ("A", "T", "F1", True, True, "check", "false", 0, D),
        ("A", "T", "F1", True, True, "check", "true", 1, D),
    ], "team string, flag_type string, flag string, is_valid boolean, not_dup boolean, "
       "reason string, picklist_value string, inappropriate int, reference_date date")
    assert rows(qa.flag_matrix(flags, SCOPE, FlagOptions(reason="check"))) == [("A", "T", "F1", 2)]


def test_reports_of_a_summary_equal_those_of_rows(spark):
    data = [srow(driver=d, process=p, score=s, target=t, training_id=k, d=dt.date(2024, m, 5))
            for k in range(3) for m in (2, 3) for d, p, s, t in (("X", "P", 100.0, "0.5"), ("X", None, None, "x"), ("Y", "P", -100.0, None), (" ", "P", 0.0, "0.1"))]
    df = survey(spark, data)
    summary = sv.summary(df, SCOPE)
    for report in (sv.net_score_monthly, sv.score_weekly, sv.score_by_process, sv.driver_detail):
        assert rows(report(df, SCOPE)) == rows(report(None, SCOPE, rows=summary))
    near = rows(sv.driver_detail(df, SCOPE, approximate=0.05))
    assert near == rows(sv.driver_detail(df, SCOPE))           # few cohorts: the sketch is exact
