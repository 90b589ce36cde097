import hashlib
import random

import numpy as np
import pytest

from cxpulse.llm import repeats as R


def brute(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(b[k:k + 100])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return sorted(out.values())


def corpus(seed):
    rng = random.Random(seed)
    words = ["w%d" % k for k in range(300)] + ["\u00e4\u00f6", "\u4e2d\u6587", "\U0001F600"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(n) for n in (12, 20, 40, 90, 25)] + ["z" * 99, "z" * 100, "ab" * 80]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(1, 60))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(passages), text(rng.randrange(0, 30))]
        rows.append((i * 7 % 61, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[5][1][:-1]), (103, None), (104, ""), (105, "a" * 99), (106, "a" * 100), (107, "a" * 5000),
             (108, "b\x00" * 120 + "b"), (109, rows[7][1] + rows[7][1]), (110, text(20_000)), (111, "x" + text(5))]
    return rows


@pytest.mark.parametrize("seed,most,share", [(1, 2048, 0.01), (2, 3, 0.5), (3, 2048, 0.0)])
def test_equals_brute_force(documents, monkeypatch, seed, most, share):
    """Suffix arrays, overflowing buckets, and (share 0) only the window path."""
    monkeypatch.setattr(R, "HOT_SHARE", share)
    if share == 0:
        monkeypatch.setattr(R, "hot_anchors", lambda docs, f=R.hot_anchors: _all_hot(docs, f))
    monkeypatch.setattr(R, "MOST", most)
    rows = corpus(seed)
    got = R.remove_repeats(documents(rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def _all_hot(docs, _):
    import numpy as np

    rows = docs.mapInArrow(R._anchor_batches(np.zeros(0, np.uint64)), "key long, c long, doc_id long, start int, kind int")
    return np.unique(np.array([r["key"] for r in rows.filter("kind = 0").collect()], np.int64).view(np.uint64))


def test_rows_repeating_an_id_or_without_one_keep_all(documents):
    long = "some text that is long enough to hold windows of a hundred bytes, " * 3 + "end"
    got = R.remove_repeats(documents([(1, long[:150]), (1, long[:150]), (None, long[:150])]))
    assert sorted(r["n_removed"] for r in got.collect()) == [0, 0, 0] or all(r["n_removed"] < 150 for r in got.collect())
    assert R.remove_repeats(documents([])).count() == 0


def found(contexts, buckets):
    array = R.SuffixArray(contexts, buckets, [(k, 0) for k in range(len(contexts))])
    at = lambda k: (int(array.owner[array.array[k]]), int(array.offset[array.array[k]]))
    return [(n, sorted(at(k) for k in range(a, b + 1)), sorted(map(at, again))) for n, a, b, again in array.maximal_repeats()]


def test_maximal_repeats_list_all_occurrences():
    core = bytes(range(65, 91)) * 5
    contexts = [b"1" + core + b"x", b"2" + core + b"y", b"3" + core[:110] + b"!"]
    got = sorted(x for x in found(contexts, [0, 0, 0]) if all(o == 1 for _, o in x[1]))
    assert got == [(110, [(0, 1), (1, 1), (2, 1)], [(2, 1)]), (130, [(0, 1), (1, 1)], [(1, 1)])]
    assert not [m for _, m, _ in found(contexts[:2], [0, 1]) if len({c for c, _ in m}) > 1]


def test_all_occurrences_of_a_passage(documents):
    passage = " ".join("p%d" % k for k in range(60))
    got = R.repeats(documents([(i, f"{'a' * i} {i} {passage} {i * 7} {'b' * i}") for i in range(1, 6)])).collect()
    by_repeat = {}
    for r in got:
        by_repeat.setdefault((r["repeat"], r["length"]), set()).add(r["doc_id"])
    assert {1, 2, 3, 4, 5} in by_repeat.values() and all(n >= R.LENGTH for _, n in by_repeat)


def test_merged_spans():
    import numpy as np

    doc, start, length = R._merged(np.array([2, 1, 1, 1, 2]), np.array([5, 0, 150, 90, 300]), np.array([100] * 5))
    assert list(zip(doc.tolist(), start.tolist(), length.tolist())) == [(1, 0, 250), (2, 5, 100), (2, 300, 100)]


def all_occurrences(rows, groups):
    """Each group lists every place of its string, and each window that the corpus
    holds twice is part of a group of as many places. Returns the groups."""
    texts = {i: (t or "").encode() for i, t in rows}
    at = {}
    for i, b in texts.items():
        for k in range(len(b) - 99):
            at.setdefault(b[k:k + 100], []).append((i, k))
    by_repeat = {}
    for r in groups:
        by_repeat.setdefault((r["repeat"], r["length"]), []).append((r["doc_id"], r["start"]))
    covered = set()
    for (_, n), places in by_repeat.items():
        i, k = places[0]
        s = texts[i][k:k + n]
        assert len(s) == n >= 100
        assert sorted(places) == sorted((i, k) for i, k in at[s[:100]] if texts[i][k:k + n] == s) and len(places) > 1
        covered |= {s[o:o + 100] for o in range(n - 99) if len(at[s[o:o + 100]]) == len(places)}
    assert covered == {w for w, x in at.items() if len(x) > 1}
    return by_repeat


@pytest.mark.parametrize("seed,most,share", [(1, 2048, 0.01), (2, 3, 0.01), (3, 1, 0.01)])
def test_repeats_list_every_repeated_window(documents, monkeypatch, seed, most, share):
    """Copies, overflowing buckets (low MOST) and, at 1, nothing but aggregates."""
    monkeypatch.setattr(R, "MOST", most)
    monkeypatch.setattr(R, "HOT_SHARE", share)
    rows = corpus(seed)
    assert all_occurrences(rows, R.repeats(documents(rows)).collect())


def test_repeats_are_the_same_in_buckets_of_any_size(documents, monkeypatch):
    """One definition: whether a task sorts a bucket or aggregates settle it."""
    rng = random.Random(9)
    line = " ".join("q%d" % k for k in range(50)) + "\0\0" * 40 + "end of it"
    rows = corpus(4)[:70] + [(200 + i, "".join(rng.choices("xyz\0", k=i % 5)) + line[rng.randrange(30):len(line) - rng.randrange(90)] + rng.choice(["", "\0", "!", "?a"])) for i in range(60)]
    found = []
    for most in (2048, 5, 1):
        monkeypatch.setattr(R, "MOST", most)
        found.append(sorted(tuple(r) for r in R.repeats(documents(rows)).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(set(found[0])) > 1000


def test_maximal_repeats_with_zero_bytes():
    """What ends in zero bytes is told from what goes on with them."""
    core = bytes(range(65, 91)) * 4
    got = found([b"1" + core + b"\0", b"2" + core, b"3" + core + b"\0\0x"], [0, 0, 0])
    assert {(n, tuple(c for c, _ in m)) for n, m, _ in got if all(o == 1 for _, o in m)} == {(104, (0, 1, 2)), (105, (0, 2))}


def test_window_hashes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    data[3000:3300] = data[100:400]
    starts = np.arange(len(data) - R.LENGTH + 1)
    texts = [data[k:k + R.LENGTH].tobytes() for k in starts]
    h = R._window_hashes(data, starts)
    assert len(set(h.tolist())) == len(set(texts)) == len(set(zip(h.tolist(), texts)))
    for k in range(R.LENGTH):  # every byte counts
        other = data.copy()
        other[700 + k] ^= 1
        assert R._window_hashes(other, starts[700:701]) != h[700]


def test_repeats_of_copies_and_hot_anchors(documents, monkeypatch):
    text = " ".join("c%d" % k for k in range(70))
    copies = [(i, text) for i in range(1, 5)]
    assert {len(x) for x in all_occurrences(copies, R.repeats(documents(copies + copies[:2])).collect()).values()} == {4}
    line = " ".join("p%d" % k for k in range(60))
    rows = [(i, f"{'a' * (i % 9)} {i} {line} {i * 7} {'b' * i}") for i in range(1, 41)] + copies
    rows = [(i + 100 * (t == text), t) for i, t in rows]
    hot = {}
    for most in (2048, 4):
        monkeypatch.setattr(R, "MOST", most)
        hot[most] = all_occurrences(rows, R.repeats(documents(rows)).collect())
        assert {tuple(range(1, 41)), (101, 102, 103, 104)} <= {tuple(sorted({i for i, _ in x})) for x in hot[most].values()}
    assert R.repeats(documents([])).count() == 0 and R.repeats(documents([(1, None), (None, text), (2, text)])).count() == 0
