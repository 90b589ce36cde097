"""Operator-level tests on literal frames: one per column function and
filter of SURVEY §2.2-2.8, and the semantic traps T1-T3, T8, T9, T12,
T15-T17, T22."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cxpulse.functions import (
    fold,
    measures,
    net_score,
    on_or_after,
    render,
    safe_ratio,
    share_of,
    sum_of_sums,
    target_or_default,
    target_pct,
    to_number,
    week_label,
    within,
)
from cxpulse.operators.filters import (
    equals_true,
    in_list,
    is_true,
    non_blank,
    null_or_not,
    text_is,
)
from cxpulse.operators.lookup import pick_clamped


def one(spark, df_expr, data, schema):
    return spark.createDataFrame(data, schema).select(df_expr.alias("x")).collect()


def measured(spark, rows):
    return spark.createDataFrame(rows, "score double, t string").select(*measures(F.col("score"), F.col("t")))


def test_net_score_counts_null_scores_T12(spark):
    df = measured(spark, [(100.0, None), (100.0, None), (0.0, None), (-100.0, None), (None, None)])
    r = df.agg(net_score().alias("n")).first()
    # (2 - 1) * 100 / 5: the NULL answer counts in the denominator
    assert r.n == 20.0


def test_net_score_is_double_T1(spark):
    assert dict(measured(spark, [(1.0, None)]).agg(net_score().alias("n")).dtypes)["n"] == "double"


def test_round_half_up_on_decimal_text_T2(spark):
    df = spark.createDataFrame([(10.165,), (1.005,), (2.25,)], "x double")
    got = [r[0] for r in df.select(F.round("x", 2)).collect()]
    assert got == [10.17, 1.01, 2.25]


def test_bround_half_even_T3(spark):
    df = spark.createDataFrame([(-24.5,), (-23.5,), (0.5,), (1.5,)], "x double")
    got = [r[0] for r in df.select(F.bround("x", 0).cast("int")).collect()]
    assert got == [-24, -24, 0, 2]  # Python round(): half to even


def test_to_number_junk_and_nan_T22_T15(spark):
    texts = ["0.35", "n/a", "NaN", None, "1e-1", "0.35d", "1f", "0x1p3", "Infinity", "-inf", "1e999", " .5 ", "-3.", "", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_number(F.col("t"))).collect()]
    assert got == [0.35, None, None, None, 0.1, None, None, None, None, None, None, 0.5, -3.0, None, None]


def test_target_pct(spark):
    assert measured(spark, [(None, "0.35"), (None, "0"), (None, "junk")]).agg(target_pct()).first()[0] == 17.5


def test_target_or_default_two_rules_T5(spark):
    df = spark.createDataFrame([(0.0,), (None,), (40.0,)], "t double")
    zero_missing = [r[0] for r in df.select(target_or_default(F.col("t"), 69.5, True)).collect()]
    zero_kept = [r[0] for r in df.select(target_or_default(F.col("t"), 69.5, False)).collect()]
    assert zero_missing == [69.5, 69.5, 40.0]
    assert zero_kept == [0.0, 69.5, 40.0]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3), (3, None)], "a long, b long")
    got = [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None]


def test_sum_of_sums_T8(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a long, b long")
    assert df.agg(sum_of_sums(["a", "b"])).first()[0] == 6          # single NULL skipped
    assert df.agg(F.sum(F.col("a") + F.col("b"))).first()[0] == 5   # what NOT to write
    all_null = spark.createDataFrame([(1, None), (2, None)], "a long, b long")
    assert all_null.agg(sum_of_sums(["a", "b"])).first()[0] is None  # an all-NULL bucket


def test_share_of(spark):
    df = spark.createDataFrame([(1, 4), (3, 4), (1, 3)], "n long, total long")
    assert sorted(r[0] for r in df.select(share_of(F.col("n"), F.col("total"))).collect()) == [25.0, 33.3, 75.0]


def test_fold_pass_through_and_null(spark):
    df = spark.createDataFrame([("a",), ("aa",), ("z",), (None,)], "c string")
    m = {"a": ("a", "aa")}
    keep = [r[0] for r in df.select(fold(F.col("c"), m, keep_others=True)).collect()]
    drop = [r[0] for r in df.select(fold(F.col("c"), m, keep_others=False)).collect()]
    assert keep == ["a", "a", "z", None]
    assert drop == ["a", "a", None, None]


def test_week_label_monday_T16(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    assert [r[0] for r in df.select(week_label(F.col("d"))).collect()] == ["2024-01-01", "2024-01-08"]


def test_date_bounds_on_timestamp_ntz_T17(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59),), (dt.datetime(2024, 1, 1, 0, 1),),
                                (dt.datetime(2024, 2, 1, 0, 0),)], "ts timestamp_ntz")
    m = dt.date(2024, 1, 1)
    open_ = [r[0] for r in df.select(on_or_after(F.col("ts"), m)).collect()]
    closed = [r[0] for r in df.select(within(F.col("ts"), m, dt.date(2024, 2, 1))).collect()]
    assert open_ == [False, True, True]
    assert closed == [False, True, False]


def test_predicates(spark):
    df = spark.createDataFrame([("a", True, " ", "TRUE"), (None, None, None, None), ("b", False, "x", "false")],
                               "s string, b boolean, t string, p string")
    got = df.select(in_list(F.col("s"), ["a"]).alias("in_"), is_true(F.col("b")).alias("is_"),
                    equals_true(F.col("b")).alias("eq"), null_or_not(F.col("s"), "a").alias("nn"),
                    non_blank(F.col("t")).alias("nb"), text_is(F.col("p"), "true").alias("tx")).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True, False, False, True),
        (None, False, None, True, False, None),
        (False, False, False, True, True, False),
    ]


def test_non_blank_knows_all_white_space(spark):
    texts = ["x", " \t\n", "\u00a0", "\u2003\u3000", "\u00a0x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(non_blank(F.col("t"))).collect()] == [True, False, False, False, True, False, False]


def test_text_is_on_boolean_source(spark):
    df = spark.createDataFrame([(True,), (False,)], "p boolean")
    assert [r[0] for r in df.select(text_is(F.col("p"), "true")).collect()] == [True, False]


def test_render_python_like_numbers_T9(spark):
    df = spark.createDataFrame([(24.0, 3, "x")], "g double, n long, s string")
    out = df.select(render("gap {g} over {n} ({s})", {"g": F.col("g"), "n": F.col("n"),
                                                      "s": F.col("s")})).first()[0]
    assert out == "gap 24.0 over 3 (x)"
    with pytest.raises(KeyError):
        render("{missing}", {})


def test_pick_clamped(spark):
    df = spark.createDataFrame([(["a", "b"], 0), (["a", "b"], 2), ([], 0), (None, 1)],
                               "arr array<string>, i int")
    got = [r[0] for r in df.select(pick_clamped(F.col("arr"), F.col("i"))).collect()]
    assert got == ["a", "b", None, None]


def test_stamp_ignores_session_time_zone(spark):
    from cxpulse.functions import stamp
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = spark.range(1).select(stamp(dt.datetime(2024, 1, 17, 3, 30), -5.0,
                                          "dd/MM/yyyy HH:mm")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == "16/01/2024 22:30"
