"""Every registered report query against its independent DuckDB oracle (the
driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from cxpulse.testbed.compare import compare, duck, type_mismatches
from cxpulse.testbed.oracle import all_sql
from cxpulse.testbed.queries import all_queries

from .conftest import SF001, SF01

QUERIES = all_queries()
ORACLES = all_sql()

# Row counts at sf0.01 that follow from the testbed rules.
ROWS_SF01 = {
    "net_score_monthly": 4, "score_weekly": 20, "qa_by_channel": 16, "training_share": 4,
    "training_share_by_key": 4, "flag_matrix": 84, "critical_process": 4, "publish_pages": 250,
    "page_stamps": 250, "payload_monthly_rows": 4, "payload_types": 3, "published_pages_check": 250,
    "score_weekly_stream": 20, "kept_training_share": 4, "training_share_bucketed": 4, "quality_metrics": 12,
}


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_sf01(spark, duck_sf01, name):
    df = QUERIES[name](spark, SF01)
    r = compare(name, df, ORACLES[name], duck_sf01)
    assert r.ok, r.detail
    assert r.rows_spark == ROWS_SF01.get(name, r.rows_spark) > 0
    assert type_mismatches(df, ORACLES[name], duck_sf01) == []


@pytest.mark.parametrize("name", ["driver_detail", "top_drivers", "training_share",
                                  "top_behaviours", "driver_coaching"])
def test_oracle_sf001(spark, name):
    r = compare(name, QUERIES[name](spark, SF001), ORACLES[name], duck(SF001))
    assert r.ok, r.detail


def test_driver_data_reach_all_branches(spark):
    """A team without drivers and with an unnamed top behaviour, one with one
    behaviour, one without, a NULL critical process, one at or above target."""
    report = {}
    for r in QUERIES["critical_process_report"](spark, SF01).collect():
        report.setdefault(r.team, []).append(r)
    assert [r.driver for r in report["view"]] == [None]
    assert report["signup"][0].process is None and report["signup"][0].behaviour_insight == "none"
    assert {r.activity_title for r in report["signup"]} == {"open"} and {r.behaviour_gap for r in report["signup"]} == {"-"}
    assert report["purchase"][0].gap_total > 0 and "|" not in report["purchase"][0].behaviour_gaps
    assert {r.activity_title for r in report["purchase"]} == {"t3"}          # clamped to the only one
    assert report["click"][0].gap_total < 0 and len(report["click"]) == 3
    top = {r.team: r.sentence for r in QUERIES["top_behaviours"](spark, SF01).collect() if r.rank == 1}
    assert top["view"] == "" and "signup" not in top


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 4
    assert df.columns == ["team", "process", "enc", "nps", "target", "pct", "gap", "process_desc"]
