"""Property tests on seeded random inputs: count identities, share sums,
top-k bounds, and invariance to row order and partitioning (guards T14)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cxpulse.params import QaOptions, Scope
from cxpulse.plans import critical as cr
from cxpulse.plans import qa
from cxpulse.plans import survey as sv
from cxpulse.sources.catalog import catalog_from_rows
from cxpulse.testbed.adapters import TEXTS

from .test_reports import SURVEY_SCHEMA

SCOPE = Scope(teams=("A", "B", "C"), as_of=dt.date(2024, 3, 15), segment="N", office="O")
QA = QaOptions(reason="R", metric_type="M", moment_map={"1": ("m1",), "2": ("m2",)},
               low_values=("low",))


def gen_survey(seed, n=600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        out.append((rnd.choice("ABCZ"), rnd.randrange(30), dt.date(2024, 3, rnd.randrange(1, 28)),
                    rnd.choice(["desk", "post"]), rnd.choice(["P1", "P2", "P3", None]),
                    rnd.choice(["d1", "d2", "d3", "d4", " ", None]),
                    rnd.choice([100.0, 0.0, -100.0, None]), rnd.choice(["0.5", "0", "x", None]),
                    rnd.choice(["N", "N", "S"]), rnd.choice([True, True, None]), "O", rnd.randrange(4)))
    return out


def gen_qa(seed, n=400):
    rnd = random.Random(seed + 1)
    return [(rnd.choice("ABC"), "desk", "R", "M", dt.date(2024, 3, 3), rnd.random(),
             rnd.choice(["S1", "S2", "S3", "S4", "S5", "S6", "S7"]), rnd.choice(["m1", "m2", "m3"]),
             rnd.choice(["low", "high"])) for _ in range(n)]


QA_SCHEMA = ("team string, channel string, reason string, metric_type string, assigned_date date, "
             "qa_total double, sentence string, moment string, sentence_value string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_count_identities_and_shares(spark, seed):
    s = spark.createDataFrame(gen_survey(seed), SURVEY_SCHEMA)
    for r in sv.net_score_monthly(s, SCOPE).collect():
        assert r.pro + r.neu + r.det <= r.enc
        assert -100.0 <= r.nps_score <= 100.0
    shares = sv.score_by_process(s, SCOPE).groupBy("team").agg(F.sum("pct").alias("t")).collect()
    for r in shares:
        assert abs(r.t - 100.0) <= 0.05 * 4
    for r in sv.driver_detail(s, SCOPE).collect():
        assert r.enc >= 3


def nested(spark, survey_rows, qa_rows, parts, seed):
    rnd = random.Random(seed)
    survey_rows, qa_rows = list(survey_rows), list(qa_rows)
    rnd.shuffle(survey_rows)
    rnd.shuffle(qa_rows)
    s = spark.createDataFrame(survey_rows, SURVEY_SCHEMA).repartition(parts)
    q = spark.createDataFrame(qa_rows, QA_SCHEMA).repartition(parts)
    cat = catalog_from_rows(spark, [{"sentence": "S1", "label": "one"}])
    rep = cr.critical_process_report(sv.score_by_process(s, SCOPE), sv.driver_detail(s, SCOPE),
                                     qa.behaviour_counts(q, SCOPE, QA), cat, TEXTS)
    return sorted((r.asDict(recursive=True) for r in rep.collect()), key=lambda d: d["team"])


@pytest.mark.parametrize("seed", [4, 5])
def test_nested_report_invariant_to_order_and_partitioning(spark, seed):
    srows, qrows = gen_survey(seed), gen_qa(seed)
    a = nested(spark, srows, qrows, 1, seed)
    b = nested(spark, srows, qrows, 7, seed + 100)
    assert a == b
    for team in a:
        assert len(team["drivers"]) <= 3
        assert len(team["behaviour_gaps"]) <= 5
        assert [d["num"] for d in team["drivers"]] == list(range(1, len(team["drivers"]) + 1))
