import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cxpulse.llm import components as C, minhash as M
from cxpulse.llm.common import materialise


def brute(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w)} if 0 < len(w) < 4 else {tuple(w[k:k + 4]) for k in range(len(w) - 3)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def near_copies(n, edits, seed):
    """A base text and copies of copies with words replaced: chains and stars."""
    rng = random.Random(seed)
    texts = [["w%d" % rng.randrange(5000) for _ in range(120)]]
    for _ in range(n - 1):
        t = list(rng.choice(texts[-15:] + texts[:1]))
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(len(t))] = "x%d" % rng.randrange(10 ** 6)
        texts.append(t)
    return [" ".join(t) for t in texts]


ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "One TWO"), (905, "one two three four"), (906, "one two three four\n"),
       (907, "q " * 20_000), (908, "Q " * 30_000), (909, "\u00c4 b c d e"), (910, "\u00e4 b c d e")]


def test_equals_brute_force(documents, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 7)  # many blocks
    rows = [(100 + k if k % 3 else 99 - k // 3, t) for k, t in enumerate(near_copies(60, 9, 1) + near_copies(50, 5, 2))] + ODD
    got = M.near_duplicates(documents(rows + rows[:3]))
    want = brute(rows)
    assert sorted({tuple(r) for r in got.collect()}) == want
    assert len({c for _, _, c, _ in want}) < len(rows) - 20


def test_rows_without_id_and_empty_table(documents):
    got = M.near_duplicates(documents([(None, "a b c d"), (1, "a b c d")]))
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, 1, 1, True), (None, 1, None, True)]
    assert M.near_duplicates(documents([])).count() == 0
    docs = documents([(1, "a b c d e"), (2, "a b c d e"), (None, "a b c d e")])
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, None]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(k, k + 1) for k in range(200, 230)]
    near = defaultdict(set)
    for a, b in pairs:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for n in sorted(near):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    got = C.components(materialise(spark.createDataFrame(pairs, "u long, v long"), "test"))
    assert {r["node"]: r["root"] for r in got.collect()} == want


def test_long_words_made_to_collide_are_no_copies(documents):
    rows = []
    for n in (1024, 2048):
        word = "a"
        while len(word) < n:
            word += word.translate(str.maketrans("ab", "ba"))
        rows += [(n, word), (n + 1, word.translate(str.maketrans("ab", "ba")))]
    got = M.near_duplicates(documents(rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, i) for i, _ in rows}


def test_many_unlike_documents_of_one_bucket_send_no_texts(spark, documents, monkeypatch):
    """5,000 documents without a common shingle, put into one group: their
    signatures are compared, none is alike, so no text is sent."""
    rng = random.Random(7)
    rows = [(k, " ".join("w%d" % rng.randrange(10 ** 9) for _ in range(8))) for k in range(5000)]
    docs = documents(rows, extra=False)
    sigs = materialise(docs.select("doc_id", "text").mapInArrow(M._signatures, "doc_id long, n_shingles long, k1 long, k2 long, sig binary"), "test-signatures")
    shared = docs.select(F.lit(0).cast("long").alias("u"), "doc_id")
    dealt = M._dealt
    sent = []
    monkeypatch.setattr(M, "_dealt", lambda df, block: sent.append((block, df.count())) or dealt(df, block))
    comps = spark.createDataFrame([], "node long, root long")
    assert M._links_across(docs, shared, sigs, comps).count() == 0
    assert sent == [(M.SIGNATURES, 5000), (M.BLOCK, 0)]
