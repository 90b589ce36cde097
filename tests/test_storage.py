"""Joins of agent tables: bucketed storage (J-1, J-3, J-4) and the runtime filter
of the segment's agents (J-3)."""

import dataclasses
import tempfile

import pytest
from pyspark.sql import functions as F

from cxpulse.operators import keyfilter as kf
from cxpulse.plans import agents as ag
from cxpulse.plans import layout
from cxpulse.session import checkpoint_dir
from cxpulse.testbed import adapters as tb

from .conftest import SF001, rows


def settings(spark, **values):
    class Held:
        def __enter__(self):
            self.before = {k: spark.conf.get(k, None) for k in values}
            for k, v in values.items():
                spark.conf.set(k, v)

        def __exit__(self, *_):
            for k, v in self.before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return Held()


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def below_joins(df):
    """For every sort-merge join of the plan, the operators below it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    out = []
    for i, line in enumerate(lines):
        if "SortMergeJoin" in line:
            below = []
            for x in lines[i + 1:]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            out.append("\n".join(below))
    return out


@pytest.fixture(scope="module")
def stored(spark):
    folder = tempfile.mkdtemp(prefix="by-agent-", dir=checkpoint_dir(spark))
    return {s: layout.save(getattr(tb, s)(spark, SF001), s, folder, 4) for s in ("survey", "agent_time", "training_status")}


def test_no_exchange_under_the_joins_of_tables_by_agent(spark, stored):
    with settings(spark, **NO_BROADCAST), layout.co_located(spark):
        share = ag.training_share(stored["agent_time"], stored["training_status"], stored["survey"], tb.scope(tb.TIME_AS_OF), tb.AGENT_TIME)
        detail = ag.agent_detail(stored["survey"], stored["agent_time"], tb.scope(), tb.AGENT_TIME, tb.AGENT_CHANNEL_MAP, time_scope=tb.scope(tb.TIME_AS_OF))
        for df, joins in ((share, 2), (detail, 1)):
            found = below_joins(df)
            assert len(found) == joins and not any("Exchange" in x for x in found)
        got = rows(share), rows(detail)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "true"
    plain = {s: getattr(tb, s)(spark, SF001) for s in stored}
    assert got == (rows(ag.training_share(plain["agent_time"], plain["training_status"], plain["survey"], tb.scope(tb.TIME_AS_OF), tb.AGENT_TIME)),
                   rows(ag.agent_detail(plain["survey"], plain["agent_time"], tb.scope(), tb.AGENT_TIME, tb.AGENT_CHANNEL_MAP, time_scope=tb.scope(tb.TIME_AS_OF))))


@pytest.mark.parametrize("words", [1, 16, 4096])
def test_key_bits_never_lose_a_key(spark, words):
    keys = spark.range(0, 500, 3).select(F.col("id").alias("agent")).union(spark.range(1).select(F.lit(None).cast("long")))
    facts = spark.range(0, 2000).select(F.col("id").alias("who")).union(spark.range(1).select(F.lit(None).cast("long")))
    left = {r[0] for r in kf.filtered(facts, "who", keys, "agent", words).collect()}
    assert set(range(0, 500, 3)) <= left
    if words == 4096:
        assert len(left) < 180                                       # 167 keys, next to no others
    none = kf.filtered(facts, "who", keys.limit(0), "agent", words)
    assert none.count() == 0


def test_keys_of_another_type_filter_nothing(spark):
    facts = spark.range(10).select(F.col("id").cast("string").alias("who"))
    assert kf.filtered(facts, "who", spark.range(3), "id").count() == 10


def test_the_agents_filter_reaches_the_scan_and_fewer_rows_are_aggregated(spark):
    """Plan: the bits are tested right above agent time's scan. Rows: what enters
    the first aggregation falls to the segment's agents."""
    folder = tempfile.mkdtemp(prefix="plain-", dir=checkpoint_dir(spark))
    few = tb.survey(spark, SF001).where("agent % 7 = 1")
    for name, df in (("survey", few), ("agent_time", tb.agent_time(spark, SF001)), ("training_status", tb.training_status(spark, SF001))):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    facts = [spark.read.parquet(f"{folder}/{n}") for n in ("agent_time", "training_status", "survey")]
    sc = tb.scope(tb.TIME_AS_OF)
    on = dataclasses.replace(tb.AGENT_TIME, prefilter_agents=True)
    share, plain = ag.training_share(*facts, sc, on), ag.training_share(*facts, sc, tb.AGENT_TIME)
    assert rows(share) == rows(plain)
    plan = share._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "talk_s" in line)
    above = [line for line in plan[:scan] if "Filter" in line][-1]
    assert "shiftright" in above and "ubquery" in above
    agents = ag.segment_agents(facts[2], sc)
    month = ag._agent_month(facts[0], sc, on)
    wanted = month.join(agents, "agent", "left_semi").count()
    assert wanted <= kf.filtered(month, "agent", agents, "agent").count() < 1.1 * wanted + 5 < month.count()
