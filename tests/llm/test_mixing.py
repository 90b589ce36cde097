import pytest

from cxpulse.llm import mixing as M


def targets(sizes):
    """Water-filling by rounds, as the contract tells it."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def test_targets_rates_and_copies(documents):
    rows = [(i, "w " * (i % 40), src) for i, src in enumerate(["a"] * 300 + ["b"] * 5 + [None] * 40 + ["c"] * 200 + ["\U0001F600"] * 2)]
    rows += [(900, None, "a"), (901, "", "b"), (902, "x " * 60_000, "c"), (None, "one two", "a"), (5, "w w w w w", "a")]
    got = M.decisions(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in ("a", None):
        assert taken[s] == pytest.approx(want[s], rel=0.05)
    again = M.decisions(documents(rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_emits_each_copy(documents):
    docs = documents([(i, "w " * 10, "ab"[i % 10 == 0]) for i in range(200)])
    copies = {r["doc_id"]: r["copies"] for r in M.decisions(docs).collect()}
    out = M.mix(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {i: n for i, n in copies.items() if n}


def test_empty_and_wordless(documents):
    assert M.decisions(documents([])).count() == 0 and M.mix(documents([])).count() == 0
    assert [tuple(r) for r in M.decisions(documents([(1, None)])).select("size", "target", "copies").collect()] == [(0, 0.0, 1)]
