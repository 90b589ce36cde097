"""Parent totals (W1, W2, A13): same numbers as a window by the key, no task with
all rows of a key, one pass over the facts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cxpulse.operators.totals import SALTS, with_totals
from cxpulse.testbed.queries import all_queries

from .conftest import SF001, rows


def grouped(spark, n=3000, seed=1):
    """Rows unique by (team, process, driver), team None and one hot team."""
    rnd = random.Random(seed)
    data = {(rnd.choice(["a", "a", "a", "b", None]), rnd.choice(["p", "q", None]), f"d{rnd.randrange(400)}"): rnd.randrange(1, 50) for _ in range(n)}
    return spark.createDataFrame([(*k, v, float(v)) for k, v in data.items()], "team string, process string, driver string, enc long, nps double")


@pytest.mark.parametrize("keys", [["team"], ["team", "process"]])
def test_equals_a_window_by_the_key(spark, keys):
    df = grouped(spark)
    got = with_totals(df, keys, {"all": (F.sum, "enc"), "top": (F.max, "enc")})
    w = Window.partitionBy(*keys)
    want = df.withColumn("all", F.sum("enc").over(w)).withColumn("top", F.max("enc").over(w))
    assert got.columns == want.columns and rows(got) == rows(want)


def test_no_rows(spark):
    assert with_totals(grouped(spark).where("false"), ["team"], {"all": (F.sum, "enc")}).count() == 0


def without_broadcasts(spark, df):
    """The executed plan and, per partition, the hot team's rows."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = df.withColumn("part", F.spark_partition_id()).collect()
        return df._jdf.queryExecution().executedPlan().toString(), found
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_hot_key_stays_spread(spark):
    df = with_totals(grouped(spark), ["team"], {"all": (F.sum, "enc")})
    plan, found = without_broadcasts(spark, df)
    hot = [r["part"] for r in found if r["team"] == "a"]
    assert len(set(hot)) == 4 and max(hot.count(p) for p in set(hot)) < 0.5 * len(hot)   # 4 partitions, 32 salts
    assert "Window" not in plan and SALTS == 32


@pytest.mark.parametrize("name,scans", [("score_by_process", 1), ("driver_detail", 1), ("top_behaviours", 1), ("critical_process", 1)])
def test_facts_are_read_once_and_no_window_sums_by_team(spark, name, scans):
    df = all_queries()[name](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # a reused shuffle is printed with the scan below it
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= scans, plan
    initial = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(enc" not in "".join(line for line in initial.splitlines() if "Window [" in line)
    assert "max(total_cases" not in "".join(line for line in initial.splitlines() if "Window [" in line)
