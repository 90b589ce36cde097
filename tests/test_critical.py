"""Golden test of the nested critical-process report (R10), hand-computed.

Team A: a below-target process wins over a bigger one; drivers in two bands;
        one behaviour, so every driver's activity clamps to it.
Team B: nothing below target (a zero target counts as missing here), tie on
        answers broken by the lower score; no drivers, no behaviours.
Team C: the critical process is NULL and matches NULL-process drivers only;
        two behaviours tied on count; the second driver's behaviour has no
        catalogue entry (default activity, raw code as label).
Team D: only in drivers / behaviours, so it is absent.
"""

from cxpulse.plans import critical as cr
from cxpulse.sources.catalog import catalog_from_rows
from cxpulse.testbed.adapters import TEXTS

BY_PROCESS = "team string, process string, enc long, nps double, target double, pct double"
DRIVERS = ("team string, process string, driver string, enc long, nps_score double, target double, "
           "cohorts long, pct_in_proc double")
BEHAVIOURS = "team string, sentence string, moment string, total_cases long, low_count long"


def frames(spark):
    by_process = spark.createDataFrame([
        ("A", "P1", 10, 50.0, 60.0, 33.3), ("A", "P2", 20, 80.0, 70.0, 66.7),
        ("B", "P1", 10, 80.0, 0.0, 50.0), ("B", None, 10, 90.0, None, 50.0),
        ("C", None, 4, 45.0, None, 100.0),
    ], BY_PROCESS)
    drivers = spark.createDataFrame([
        ("A", "P1", "d1", 5, 40.0, 60.0, 2, 0.0), ("A", "P1", "d2", 5, 50.0, None, 1, 0.0),
        ("A", "P1", "d3", 8, 90.0, 60.0, 4, 0.0), ("A", "P1", "d4", 3, 0.0, 0.0, 9, 0.0),
        ("A", "P2", "other", 50, 0.0, 60.0, 1, 0.0),
        ("C", None, "dn1", 4, 45.0, None, 1, 0.0), ("C", None, "dn2", 3, 60.0, None, 1, 0.0),
        ("C", "P1", "dx", 99, 0.0, None, 1, 0.0),
        ("D", "P1", "dd", 9, 0.0, None, 1, 0.0),
    ], DRIVERS)
    behaviours = spark.createDataFrame([
        ("A", "S1", "1-A", 10, 4), ("A", "S2", None, 12, 0),
        ("C", "S9", None, 5, 3), ("C", "S1", "2-X", 7, 3),
        ("D", "S1", None, 1, 1),
    ], BEHAVIOURS)
    catalog = catalog_from_rows(spark, [
        {"sentence": "S1", "label": "Listens", "error_text": "Interrupts the user.",
         "activity": {"title": "Listen", "duration": "20 min", "objective": "o", "how": "h",
                      "materials": "m", "tags": ["t1"]}},
        {"sentence": "S2", "label": "Greets"},
    ])
    return by_process, drivers, behaviours, catalog


def test_nested_report_golden(spark):
    report = cr.critical_process_report(*frames(spark), TEXTS)
    got = {r.team: r.asDict(recursive=True) for r in report.collect()}
    assert sorted(got) == ["A", "B", "C"]

    a = got["A"]
    assert (a["process"], a["nps"], a["gap_total"]) == ("P1", 50.0, -10.0)
    assert a["process_desc"] == "P1 at 50.0 of 60.0 (-10.0), 10 answers = 33.3"
    assert [d["name"] for d in a["drivers"]] == ["d1", "d2", "d3"]
    assert [d["gap"] for d in a["drivers"]] == [-20, -20, 30]       # -19.5 -> -20 (half even)
    assert [d["priority"] for d in a["drivers"]] == ["now", "soon", "later"]
    assert [d["pclass"] for d in a["drivers"]] == ["p1", "p2", "p3"]
    assert [d["why"] for d in a["drivers"]] == ["d1 40.0/60.0", "2 d2: -19.5, n=5, groups=1", "3 d3: 30.0, n=8, groups=4"]
    assert {d["error"] for d in a["drivers"]} == {"Interrupts the user."}
    assert {d["activity"]["title"] for d in a["drivers"]} == {"Listen"}   # clamped to the only one
    assert [d["activity"]["num"] for d in a["drivers"]] == [1, 2, 3]
    assert a["drivers"][0]["behaviour_gap"] == "[Listens]"
    assert (a["incoming_total"], a["cohorts"]) == (18, 4)
    assert a["behaviour_gaps"] == [{"label": "Listens", "val": 4, "max": 12}]
    assert a["behaviour_insight"] == "Listens x4"

    b = got["B"]
    assert (b["process"], b["nps"], b["gap_total"]) == ("P1", 80.0, 10.5)
    assert b["drivers"] == [] and b["behaviour_gaps"] == []
    assert (b["incoming_total"], b["cohorts"]) == (0, 0)
    assert b["behaviour_insight"] == "none"

    c = got["C"]
    assert (c["process"], c["gap_total"]) == (None, -24.5)
    assert [d["name"] for d in c["drivers"]] == ["dn1", "dn2"]
    assert [d["gap"] for d in c["drivers"]] == [-24, -10]            # -24.5 -> -24, -9.5 -> -10
    assert c["drivers"][0]["activity"]["title"] == "Listen"
    assert c["drivers"][1]["activity"]["title"] == "open"
    assert c["drivers"][1]["activity"]["tags"] == []
    assert c["behaviour_gaps"] == [{"label": "Listens", "val": 3, "max": 7},
                                   {"label": "S9", "val": 3, "max": 7}]
    assert c["behaviour_insight"] == "Listens x3, S9 x3"


def test_no_behaviours_defaults(spark):
    by_process, drivers, behaviours, catalog = frames(spark)
    empty = behaviours.where("false")
    report = cr.critical_process_report(by_process, drivers, empty, catalog, TEXTS)
    a = [r for r in report.collect() if r.team == "A"][0]
    d = a.drivers[0]
    assert d.error == "see "
    assert d.behaviour_gap == "-"
    assert d.activity.title == "open"


def test_top_behaviours_error_default_uses_label(spark):
    by_process, drivers, behaviours, catalog = frames(spark)
    behs = cr.top_behaviours(behaviours, catalog, TEXTS)
    tops = cr.top_drivers(drivers, cr.critical_process(by_process, TEXTS), TEXTS)
    coach = cr.driver_coaching(tops, behs.where("sentence = 'S9'"), TEXTS)
    c = [r for r in coach.collect() if r.team == "C"]
    assert {r.error for r in c} == {"see S9"}


def test_unnamed_top_behaviour_and_repeated_catalogue_codes(spark):
    by_process, drivers, _, catalog = frames(spark)
    behaviours = spark.createDataFrame([("A", "", None, 5, 4), ("A", "S1", None, 5, 3)], BEHAVIOURS)
    twice = catalog.unionByName(catalog)
    tops = cr.top_behaviours(behaviours, twice, TEXTS)
    assert sorted((r.rank, r.sentence) for r in tops.collect()) == [(1, ""), (2, "S1")]
    coached = cr.driver_coaching(cr.top_drivers(drivers, cr.critical_process(by_process, TEXTS), TEXTS), tops, TEXTS)
    assert {r.behaviour_gap for r in coached.collect()} == {"-"}
