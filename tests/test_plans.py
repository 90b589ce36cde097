"""Plan-shape tests: filters reach the scan, the join types are the ones the
definition needs, top-k is a WindowGroupLimit, and no query leaves the JVM."""

import pytest

from cxpulse.testbed.queries import all_queries

from .conftest import SF001


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_r1_pushes_team_list_and_date_range(spark):
    plan = physical(all_queries()["net_score_monthly"](spark, SF001))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters" in scan
    assert "In(event_type, [click,purchase,signup,view])" in scan
    assert "GreaterThanOrEqual(ts," in scan                  # DATE(ts) >= m unwrapped to ts
    assert "props" in scan and "value" in scan and "url" not in scan


def scans(df):
    return [line for line in physical(df).splitlines() if "FileScan parquet" in line]


@pytest.mark.parametrize("name,column,first,last", [
    ("qa_by_channel", "o_orderdate", "1997-03-01", None), ("behaviour_counts", "o_orderdate", "1997-03-01", None),
    ("flag_matrix", "l_shipdate", "1996-12-01", None), ("training_share", "l_shipdate", "1996-12-01", "1997-01-01"),
    ("agent_detail", "l_shipdate", "1996-12-01", "1997-01-01"), ("training_share", "o_orderdate", "1996-12-01", "1997-01-01"),
    ("agent_detail", "ts", "2024-01-01", None), ("driver_detail", "ts", "2024-01-01", None)])
def test_date_bounds_reach_the_scan(spark, name, column, first, last):
    scan = [s for s in scans(all_queries()[name](spark, SF001)) if column in s][0]
    pushed = scan[scan.index("PushedFilters"):scan.index("ReadSchema")]
    assert f"GreaterThanOrEqual({column},{first}" in pushed
    assert last is None or f"LessThan({column},{last}" in pushed


def test_r5_joins(spark):
    df = all_queries()["training_share"](spark, SF001)
    opt = optimized(df)
    assert "Join LeftOuter" in opt          # days without a status row stay
    assert "Join LeftSemi" in opt           # IN (SELECT agent ...) as a semi-join
    assert "Join Inner" not in opt
    semi = opt.index("Join LeftSemi")
    assert "Aggregate [agent" in opt[semi:]               # distinct agents on the right side


def test_reports_of_a_summary_scan_nothing_else(spark):
    """With the two summaries written, the payload reports read the survey
    once more (R5's agents) and the evaluations not at all."""
    from cxpulse.plans import refresh as rf
    from cxpulse.testbed import queries as q

    inp, opt = q.inputs(spark, SF001), q.options()
    survey_rows, qa_rows = rf.summaries(inp, opt)
    reports = rf.build_reports(inp, opt, survey_rows, qa_rows)
    events = {n: sum("event" in line for line in scans(df)) for n, df in reports.items()}
    orders = {n: sum("o_orderpriority" in line and "o_custkey" in line and "orderstatus" in line for line in scans(df)) for n, df in reports.items()}
    assert {n for n, c in events.items() if c} == {"training_share"} and events["training_share"] == 1
    assert not any(orders.values())


@pytest.mark.parametrize("name", ["critical_process", "top_drivers", "top_behaviours"])
def test_top_k_is_window_group_limit(spark, name):
    assert "WindowGroupLimit" in physical(all_queries()[name](spark, SF001))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_in_plans(spark, name):
    plan = physical(all_queries()[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in plan


@pytest.mark.parametrize("name", ["net_score_monthly", "score_weekly", "score_by_process",
                                  "driver_detail", "qa_by_channel", "behaviour_counts",
                                  "flag_matrix", "training_share", "agent_detail",
                                  "critical_process", "top_drivers", "top_behaviours",
                                  "critical_process_report"])
def test_only_combined_rows_are_shuffled(spark, name):
    """Every shuffle's input is a (partial) aggregate or a partial top-k:
    raw fact rows never cross the network, so a hot key sends one combined
    row (or k rows) per task. Broadcasting is off, so that no small test table
    hides a shuffle; small local relations (the catalogue) may be exchanged."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = physical(all_queries()[name](spark, SF001)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # a projection, filter, sort, window or join of combined rows is combined itself
    through = ("Project", "Filter", "Sort ", "Window ", "SortMergeJoin", "AQEShuffleRead", "Generate")
    combined = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Exchange", "LocalTableScan", "Scan ExistingRDD")
    operators = [line.lstrip(" :+-*") for line in lines]
    for i, op in enumerate(operators):
        if op.startswith(("Exchange hashpartitioning", "Exchange SinglePartition")):
            below = next(x for x in operators[i + 1:] if not x.startswith(through))
            assert below.startswith(combined), (op, below)
