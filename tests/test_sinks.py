"""Sinks and checks: report rows (S9), guarded collects (R11, A14), quality
metrics with a stop rule (S8), flags of the published page (S13)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cxpulse.operators.guard import within_bytes
from cxpulse.operators.keyed import keyed_map
from cxpulse.plans import refresh as rf
from cxpulse.plans.publish import PayloadSpec, as_payload, read_report_rows, write_report_rows
from cxpulse.plans.quality import QualityError, StopRule, Watch, survey_checks
from cxpulse.session import checkpoint_dir
from cxpulse.testbed import adapters as tb
from cxpulse.testbed import queries as q

from .conftest import SF001, rows
from .test_publish import publish_one


def folder(spark, name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir=checkpoint_dir(spark))


def test_report_rows_replace_per_report(spark):
    path = folder(spark, "rows")
    a = spark.createDataFrame([("x", 1, 1.5, None), (None, 2, None, "é\n\"")], "team string, n long, v double, note string")
    b = spark.createDataFrame([("y", [1, 2])], "team string, items array<int>")
    write_report_rows({"a": a, "b": b}, path)
    assert rows(read_report_rows(spark, path, "a")) == rows(a) and read_report_rows(spark, path, "b").collect() == b.collect()
    write_report_rows({"a": a.limit(0)}, path)
    got = read_report_rows(spark, path, "a")
    assert got.count() == 0 and got.schema == a.schema and read_report_rows(spark, path, "b").count() == 1
    with pytest.raises(KeyError):
        read_report_rows(spark, path, "c")
    assert sorted(x for x in os.listdir(path) if x.startswith("report=")) == ["report=a", "report=b"]


def test_an_oversized_report_fails_before_it_is_collected(spark):
    df = spark.range(1000).selectExpr("id as team", "repeat('x', 100) as note")
    assert within_bytes(df, F.octet_length("note"), 100_000, "note").count() == 1000
    for collect in (lambda limit: as_payload(df, PayloadSpec("P", "p", (("team", True),)), max_bytes=limit),
                    lambda limit: keyed_map(df, "team", ["note"], max_bytes=limit)):
        assert collect(1_000_000).count() == 1
        with pytest.raises(Exception, match="over 1000 bytes"):
            collect(1000).collect()
        plan = collect(1000)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        # the check sits on the one-row total that every row is joined with, below the aggregate that collects
        check = next(i for i, line in enumerate(plan) if "Filter" in line and "raise_error" in line)
        join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
        assert next(i for i, line in enumerate(plan) if "collect_list" in line) < join < check and "sum(octet_length" in plan[check + 1]
    assert within_bytes(df.limit(0), F.octet_length("note"), 1, "none").count() == 0


def test_quality_counts_and_stop_rule(spark):
    s = spark.createDataFrame([("a", 1.0, "p", "0.5", "d"), (None, None, None, "x", " "), ("b", 2.0, "p", None, None), ("b", 2.0, "p", "NaN", "d")],
                              "team string, score double, process string, target_text string, driver string")
    watch = Watch()
    watch.over(s, "survey", survey_checks()).write.format("noop").mode("overwrite").save()
    found = watch.counts()
    assert found == {"survey": {"rows": 4, "null_teams": 1, "null_scores": 1, "null_processes": 1, "unreadable_targets": 2, "blank_drivers": 2}}
    StopRule({"survey.null_teams": 0.25}).check(found)
    with pytest.raises(QualityError, match="survey.unreadable_targets: 2 of 4"):
        StopRule({"survey.null_teams": 0.25, "survey.unreadable_targets": 0.4}).check(found)
    assert Watch().over(s.limit(0), "x", survey_checks()).count() == 0


def test_the_refresh_stops_before_it_publishes(spark):
    slots = [s.slot for s in rf.DEFAULT_PAYLOADS]
    args = (spark, q.inputs(spark, SF001), q.options(), tb.pages_with_slots(spark, SF001, slots))
    out = folder(spark, "stopped")
    with pytest.raises(QualityError, match="unreadable_targets"):
        rf.run_refresh(*args, out, tb.REFRESHED_AT, rule=StopRule({"survey.unreadable_targets": 0.01}))
    assert not os.path.exists(os.path.join(out, "pages")) and not os.path.exists(os.path.join(out, "payloads"))
    counts = rf.run_refresh(*args, out, tb.REFRESHED_AT, rule=StopRule({"survey.unreadable_targets": 1.0}))
    assert counts["quality/survey.rows"] > counts["quality/survey.unreadable_targets"] > 0 and counts["quality/training_status.duplicate_days"] >= 0
    assert read_report_rows(spark, os.path.join(out, "rows"), "net_score_monthly").count() == 4


def test_flags_hold_for_the_final_page(spark):
    r = publish_one(spark, "// __B_START__ // __A_START__ old // __A_END__ // __B_END__")     # A is filled in, then B takes it away
    assert r.injected == ["B"] and r.missing == ["A"] and "const a" not in r.html
    r = publish_one(spark, "// __A_START__ x // __A_END__ // __B_START__ // __A_START__ old // __A_END__ // __B_END__")
    assert r.injected == ["A", "B"] and r.missing == []                                       # one of A's blocks is left
