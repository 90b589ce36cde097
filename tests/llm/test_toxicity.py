import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa

from cxpulse.llm import toxicity as X


def corpus(n=600):
    """Toxic where an insult meets a group; either alone is clean."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(["w%d" % k for k in range(60)], k=25)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w += ["scoundrel"] * insult + ["Martians"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(insult and group)))
    return rows, labels


def test_learns_an_interaction_and_keeps_the_fold(spark, documents):
    rows, labels = corpus()
    docs = documents(rows + [(5000, None), (5001, ""), (None, "x"), (5002, "w " * 50_000), rows[0]])
    table = spark.createDataFrame(labels + [(None, 1, 1), (5001, 1, None)], "doc_id long, quality int, toxic int")
    got = X.score_documents(docs, table).collect()
    assert len(got) == len(rows) + 5
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 80 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    assert sorted(map(str, got)) == sorted(map(str, X.score_documents(docs, table).collect()))
    kept = X.accepted(docs, table)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got)


def test_held_out_labels_are_never_read(spark, documents):
    rows, labels = corpus(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (X.score_documents(documents(rows), spark.createDataFrame(x, schema)).collect() for x in (labels, flipped))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in X.score_documents(documents([(1, "a b")]), none).collect()] == [0]
    assert X.score_documents(documents([]), none).count() == 0 and X.accepted(documents([]), none).count() == 0


def brute_scores(machine, texts):
    """All pairs of the terms present, one by one."""
    out = []
    for text in texts:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        data = [(w, False) for w in words] + [(w[:X.PREFIX], True) for w in words if len(w) > X.PREFIX]
        terms = set()
        for w, prefix in data:
            h = X.T.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]
            terms.add(int((~h if prefix else h) % np.uint64(X.SLOTS)))
        terms = sorted(machine.terms[t] for t in terms if machine.terms[t] >= 0)
        y = machine.w0 + sum(machine.w[i] for i in terms) + sum(machine.v[i] @ machine.v[j] for i, j in combinations(terms, 2))
        out.append(1 / (1 + np.exp(-min(30, max(-30, y)))))
    return out


def test_scores_equal_brute_force(spark, documents):
    rows, labels = corpus(200)
    rows += [(900, None), (901, ""), (902, "SCOUNDREL scoundrel Martians \u00e9t\u00e9 scoundrels"), (903, "w1 " * 30_000 + "martians")]
    docs, table = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    machine = X.train(docs, table)
    assert (machine.terms >= 0).sum() >= 2
    got = {r["doc_id"]: r["score"] for r in X.score_documents(docs, table).collect()}
    want = brute_scores(machine, [t for _, t in rows])
    np.testing.assert_allclose([got[i] for i, _ in rows], want, atol=1e-9)


def test_sample_terms_are_the_distinct_terms():
    texts = ["Abc abc ABCDEFGH", None, "", "x y x"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3, 4], pa.int64()), "toxic": pa.array([1, 0, 0, 1], pa.int32()), "text": pa.array(texts)})
    found = [r for b in X._sample_terms(iter([batch])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["toxic"], len(r["slots"])) for r in found] == [(1, 1, 3), (2, 0, 0), (3, 0, 0), (4, 1, 2)]
    assert all(r["slots"] == sorted(set(r["slots"])) for r in found)


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    n, m, weight = 12, 5, 3.0
    x, toxic = (rng.random((n, m)) < 0.5).astype(float), (rng.random(n) < 0.4).astype(float)
    theta = rng.normal(0, 0.5, 1 + m + m * X.FACTORS)

    def loss(theta):
        w, v = theta[1:m + 1], theta[m + 1:].reshape(m, X.FACTORS)
        total = 0.0
        for r in range(n):
            held = np.flatnonzero(x[r])
            y = theta[0] + w[held].sum() + sum(v[i] @ v[j] for i, j in combinations(held, 2))
            total += -weight * np.log(1 / (1 + np.exp(-y))) if toxic[r] else np.log(1 + np.exp(y))
        return total / n + X.L2_W / 2 * (w @ w) + X.L2_V / 2 * (v * v).sum()

    step = 1e-6 * np.eye(len(theta))
    want = [(loss(theta + d) - loss(theta - d)) / 2e-6 for d in step]
    np.testing.assert_allclose(X.gradient(theta, x, toxic, weight), want, atol=1e-7)


def test_chosen_terms_equal_brute_force():
    rng = np.random.default_rng(4)
    toxic = (rng.random(80) < 0.3).astype(float)
    slots = [np.unique(rng.integers(0, 40, 8)) if t else np.unique(rng.integers(10, 60, 8)) for t in toxic]
    n1, n0, z = toxic.sum(), (1 - toxic).sum(), {}
    for s in range(60):
        c1, c0 = (sum(s in held for held, t in zip(slots, toxic) if t == label) for label in (1, 0))
        p = (c1 + c0) / (n1 + n0)
        if c1 + c0 >= 2:
            z[s] = abs(c1 / n1 - c0 / n0) / (p * (1 - p) * (1 / n1 + 1 / n0)) ** 0.5
    want = sorted(sorted((s for s in z if z[s] > 2), key=lambda s: (-z[s], s))[:6])
    assert X.choose_terms(slots, toxic, 6).tolist() == want and len(want) == 6
