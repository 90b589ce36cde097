"""The refresh job end to end (S8 observed row counts, written tables as
lineage cuts), presentation order (O1) and the as_of default (F-d4)."""

import datetime as dt
import json
import os
import tempfile

import pytest

from cxpulse.params import today_in_zone
from cxpulse.plans import refresh as rf
from cxpulse.plans.order import ORDER, presented
from cxpulse.session import checkpoint_dir
from cxpulse.sources import SchemaError, conform, read_agent_time, read_qa_eval, read_qa_flags, read_survey, read_training_status
from cxpulse.sources import schemas
from cxpulse.testbed import adapters as tb
from cxpulse.testbed import queries as q

from .conftest import SF001


def test_run_refresh_writes_and_counts(spark):
    out = tempfile.mkdtemp(prefix="refresh-", dir=checkpoint_dir(spark))
    slots = [s.slot for s in rf.DEFAULT_PAYLOADS]
    counts = rf.run_refresh(spark, q.inputs(spark, SF001), q.options(),
                            tb.pages_with_slots(spark, SF001, slots), out, tb.REFRESHED_AT, q.STAMP)
    assert counts["payloads"] == 6
    assert counts["reports/net_score_monthly"] == 4
    assert counts["reports/critical_process_report"] == 4
    for name, n in counts.items():
        assert spark.read.parquet(os.path.join(out, name)).count() == n
    pay = {r.name: r for r in spark.read.parquet(os.path.join(out, "payloads")).collect()}
    assert sorted(json.loads(pay["TRAINING_SHARE"].json)) == list(tb.TEAMS)
    pages = spark.read.parquet(os.path.join(out, "pages"))
    assert pages.where("size(injected) = 6").count() > 0


def test_run_refresh_default_folder_is_under_checkpoint_dir(spark):
    slots = [s.slot for s in rf.DEFAULT_PAYLOADS]
    at = dt.datetime(2024, 1, 17, 16, 5, 42)
    counts = rf.run_refresh(spark, q.inputs(spark, SF001), q.options(),
                            tb.pages_with_slots(spark, SF001, slots), None, at)
    out = os.path.join(checkpoint_dir(spark), "cxpulse-refresh", "20240117T160542")
    assert spark.read.parquet(os.path.join(out, "payloads")).count() == counts["payloads"] == 6


def test_presentation_order(spark):
    df = spark.createDataFrame([("b", 1, "x"), ("a", 1, "y"), ("a", 5, None)],
                               "team string, enc long, process string")
    got = [tuple(r) for r in presented(df, "score_by_process").collect()]
    assert got == [("a", 5, None), ("a", 1, "y"), ("b", 1, "x")]
    assert set(ORDER) >= set(rf.PAYLOAD_OF)


def test_as_of_default_fixed_offset():
    now = dt.datetime(2024, 2, 1, 3, 0, tzinfo=dt.timezone.utc)
    assert today_in_zone(-5.0, now) == dt.date(2024, 1, 31)      # still January at UTC-5
    assert today_in_zone(0.0, now) == dt.date(2024, 2, 1)


def test_conform_checks_columns_and_types(spark):
    s = tb.survey(spark, SF001)
    assert conform(s, schemas.SURVEY).columns == list(schemas.SURVEY)
    with pytest.raises(SchemaError):
        conform(s.drop("office"), schemas.SURVEY)
    with pytest.raises(SchemaError):
        conform(s.withColumn("response_date", s["team"]), schemas.SURVEY)


@pytest.mark.parametrize("name,reader", [
    ("survey", read_survey), ("qa_eval", read_qa_eval), ("qa_flags", read_qa_flags),
    ("agent_time", lambda spark, path: read_agent_time(spark, path, tb.BUCKETS)), ("training_status", read_training_status)])
def test_readers(spark, name, reader):
    path = os.path.join(tempfile.mkdtemp(prefix="reader-", dir=checkpoint_dir(spark)), f"{name}.parquet")
    df = getattr(tb, name)(spark, SF001)
    df.withColumn("more", df[df.columns[0]]).write.parquet(path)
    got = reader(spark, path)
    assert sorted(got.columns) == sorted(df.columns) and got.count() == df.count()
    spark.read.parquet(path).drop(df.columns[-1]).write.parquet(path + "2")
    with pytest.raises(SchemaError):
        reader(spark, path + "2")
