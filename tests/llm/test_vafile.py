import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cxpulse.llm import vafile as V


def brute(rows, k):
    """As the SQL: every row is a candidate, and a query as often as it comes."""
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in ok if i % 50 == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for i, a in ok if i == q for j, b in ok if j != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 40])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # one common vector: ties
    rows += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2050, [float("inf")] + [0.0] * 7), (2100, [1.0, 2.0]), (2101, [0.5, -2.0]), (2150, []), (50, rows[50][1]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS block", "3 AS dim")
    got = V.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_few_rows_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert V.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    got = V.top_k(spark.createDataFrame([(0, [1.0]), (1, [-1.0])], schema), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, -65536)]


def test_large_components_stay_exact(spark):
    rows = [(1, [2.0 ** 32, 1.0]), (2, [2.0 ** 32, 3.0]), (3, [-(2.0 ** 32), 5.0]), (50, [2.0 ** 13, 1.0])]
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 3)
    assert [tuple(r)[2:] for r in got.orderBy("rank").collect()] == [(i, 65536 * (2 ** 45 * s + x)) for i, s, x in ((2, 1, 3), (1, 1, 1), (3, -1, 5))]


def test_scores_beyond_a_long_are_ranked_and_kept(spark):
    rows = [(0, [2.0 ** 50, 1.0]), (1, [2.0 ** 50, 0.0]), (2, [2.0 ** 50, 1.0]), (3, [-(2.0 ** 50), 0.0]), (4, [0.0, 2.0])]
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    top = (1 << 63) - 1
    assert [tuple(r)[1:] for r in got.orderBy("rank").collect()] == [(1, 2, top), (2, 1, top), (3, 4, 2 * 65536), (4, 3, -top - 1)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    v, q = np.floor(rng.normal(size=(3000, 32)) * 256), np.floor(rng.normal(size=(20, 32)) * 256)
    codes, low, width = V.approximate(v)
    middle, reach = V.bounds(codes, low, width, q)
    exact = q @ v.T
    assert codes.dtype == np.uint8 and (np.abs(exact - middle) <= reach[:, None]).all()
    rows, cols = V.candidates(middle, reach, np.ones(middle.shape, bool), 5)
    assert all(set(np.argsort(-exact[r])[:5]) <= set(cols[rows == r]) for r in range(20)) and len(rows) < 20 * 40
    flat = np.zeros((4, 3))
    assert V.approximate(flat)[0].tolist() == [[0] * 3] * 4 and V.approximate(np.zeros((2, 0)))[0].shape == (2, 0)


def test_an_id_with_several_vectors_keeps_all(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (1, [0.0, 2.0]), (2, [1.0, 1.0])]
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    scores = sorted((-int(65536 * (a[0] * b[0] + a[1] * b[1])), i) for a in ([1, 0], [0, 1]) for i, b in ((1, (3, 0)), (1, (0, 2)), (2, (1, 1))))
    assert sorted(tuple(r) for r in got.collect()) == [(0, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]


def test_repeated_rows_count_as_often_as_they_come(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (3, [0.0, 1.0]), (100, [2.0, -1.0]), (4, [3.0, 1.0])]
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    want = []
    for q in (0, 100):
        pairs = sorted((-int(65536 * sum(x * y for x, y in zip(a, b))), j) for i, a in rows if i == q for j, b in rows if j != q)
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(pairs[:5])]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_one_vector_carried_by_many_ids(spark):
    rows = [(k, [1.0, 1.0]) for k in range(400)] + [(1000, [2.0, 0.0]), (1001, [0.0, 3.0])]
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_no_side_is_gathered_in_the_driver(spark, monkeypatch):
    # the blocks of the queries meet 60 blocks of the file: far more than the estimate a broadcast would go by
    monkeypatch.setattr(V, "BLOCK", 20)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1200)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
        assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 24 * 5
        assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("work", [(1, 1 << 39), (1 << 30, 300)])
def test_cells_of_any_shape_equal_brute_force(spark, monkeypatch, work):
    for name, value in {"BLOCK": 30, "QUERIES": 3, "CHUNK": 2, "STRIP": 7, "CELL_WORK": work, "CELL_ASKED": 40}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(500)] + [(600 + i, rng.normal(size=3).tolist()) for i in range(80)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)] + [(50, rows[50][1]), (100, rows[7][1])]
    rows += [(i, [(2.0 ** 24 + i) / 256, 1.0]) for i in (2000, 2001, 2003, 2050)]  # no 4-byte numbers
    got = V.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


@pytest.mark.parametrize("held", [0, 1, 64])
def test_a_cell_lets_go_of_no_candidate(monkeypatch, held):
    monkeypatch.setattr(V, "HELD", held)
    rng, k = np.random.default_rng(7), 5
    v, q = np.floor(rng.normal(size=(600, 4)) * 256), np.floor(rng.normal(size=(9, 4)) * 256)
    v[200:300] = v[0]  # equal vectors
    own = np.where(np.arange(600) % 7 < 5, np.arange(600) % 9, 100)  # what a query's own id carries
    asked, given = V._Asked(np.arange(9), np.arange(9), q, k), []
    for a in range(0, 600, 50):
        asked.meet(np.arange(a, a + 50), np.arange(a, a + 50) % 2 == 0, own[a:a + 50], *V.approximate(v[a:a + 50]))
        given += asked.give(False)
    given += asked.give(True)
    pairs = {(r["query"], r["vector"]): (r["lower"], r["upper"]) for b in given for r in b.to_pylist()}
    exact = q @ v.T
    exact[(np.arange(600) % 2 == 0)[None, :] & (own[None, :] == np.arange(9)[:, None])] = -np.inf
    least = -np.sort(-exact, axis=1)[:, k - 1]
    assert {(r, c) for r, c in zip(*np.nonzero(exact >= least[:, None]))} <= set(pairs)
    assert all(low <= exact[r, c] <= high for (r, c), (low, high) in pairs.items())


def test_grid():
    assert V.grid(0, 0, 0, 200, (1, 1)) == (1, 1)
    across, down = V.grid(600_000, 12_000, 12_000 * 64, 25, (12, 74))
    assert across <= 12 and down <= 74 and across * down >= 25
    for n in (600_000, 15_000_000):
        across, down = V.grid(n, n // 50, n // 50 * 64, 25, (-(-n // 50 // V.QUERIES), -(-n // V.BLOCK)))
        assert n * (n // 50 * 64) / (across * down) <= V.CELL_WORK[1] and n // 50 * 64 / across <= V.CELL_ASKED
