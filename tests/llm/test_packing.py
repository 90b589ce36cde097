import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cxpulse.llm import packing as P

ODD = ["", None, "Don't stop!? it's 12,345.67 (x) a\u0301b e\u0301, \u00e9\u00e8, caf\u00e9!. <|endoftext|>x <|ENDOFTEXT|> ''s", "\x1c\x85\u00a0\u2028 a\x1cb", "\u0130stanbul \u03a3\u03a3", "\u4e2d\u6587\uff0c\U0001F600!!", "<|startoftext|>", "A" * 5000, "1" * 300, "\u00d7,\u00f7."]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    alphabet = "abcdefghij ,.!'?-0123456789\u00e9\u00df\u00d7 \n\tXYZ"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 3000))) for _ in range(150)]
    rows = [(i, t, "abc"[i % 7 % 3]) for i, t in enumerate(texts + ODD)]
    return rows + [(1000, texts[0], None), (1001, "word " * 30_000, "a"), (0, texts[0], "a"), (None, "no id", "b")]


def test_ids_pieces_and_sequences(documents, corpus, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(P, "PART_TOKENS", 20_000)
    tokenizer = Tokenizer.from_file(P.default_tokenizer())
    got = P.pack(documents(corpus), P.default_tokenizer()).collect()
    want = defaultdict(list)
    for i, t, _ in corpus:
        want[i].append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(want)
    for i, copies in want.items():
        assert sum(r["length"] for r in pieces[i]) == sum(map(len, copies))
        for r in pieces[i]:
            assert r["doc_tokens"] in {len(c) for c in copies}
            assert any(zlib.crc32(c[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for c in copies)
        if len(copies) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    at = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * P.LENGTH + r["offset"] == at and r["offset"] + r["length"] <= P.LENGTH
        at += r["length"]


def test_rotation_keeps_proportions_and_carries_deficits():
    rotation = P.Rotation(5000)
    for s, share, n in (("a", 0.7, 700), ("b", 0.2, 200), ("c", 0.1, 100)):
        rotation.share[s], rotation.served[s] = share, int(5000 * share)
        for k in range(100):
            rotation.queues[s].append((hash(s) * 1000 + k, 0, n))
    got, at, owed = defaultdict(int), 5000, rotation.share
    for row, _, length, place in rotation.pieces():
        assert place == at
        at += length
        s = next(x for x in "abc" if row // 1000 == hash(x))
        got[s] += length
        if at < 100_000:
            for x, share in owed.items():
                assert abs(got[x] - share * (at - 5000)) < 2.5 * P.QUANTUM
    assert at == 105_000


def test_windows_keep_proportions_across_parts(spark, monkeypatch):
    """At the end of every window of the whole stream each source has had its share,
    but for quanta under way and what the part at hand began or ends with."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "PART_TOKENS", 20_000)
    rng = random.Random(9)
    rows = [(k, rng.choices(["a", "b", "c", None], [60, 25, 10, 5])[0], rng.randrange(1, 400)) for k in range(1000)]
    lengths = spark.createDataFrame(rows, "row long, source string, n long").repartition(4)
    total = sum(n for _, _, n in rows)
    parts = max(1, -(-total // P.PART_TOKENS))
    part = dict(lengths.select("row", F.expr(f"pmod(xxhash64(row), {parts})")).collect())
    source = {k: s for k, s, _ in rows}
    share, ends = defaultdict(float), [defaultdict(int) for _ in range(parts)]
    for k, s, n in rows:
        share[s] += n / total
        ends[part[k]][s] += n
    plan = sorted(P.rotation_plan(lengths).collect(), key=lambda r: r["position"])
    assert parts > 5 and sum(r["length"] for r in plan) == total
    assert [part[r["row"]] for r in plan] == sorted(part[r["row"]] for r in plan)

    had, before, at_bounds = defaultdict(int), 0, []
    for own in ends:  # what each source is ahead by where a part begins and ends
        first = {s: had[s] - share[s] * before for s in share}
        before += sum(own.values())
        for s in share:
            had[s] += own[s]
        at_bounds.append({s: max(abs(first[s]), abs(had[s] - share[s] * before)) for s in share})
    had, at = defaultdict(int), 0
    for r in plan:
        assert r["position"] == at
        at += r["length"]
        had[source[r["row"]]] += r["length"]
        if at % P.LENGTH == 0:
            for s in share:
                assert abs(had[s] - share[s] * at) <= at_bounds[part[r["row"]]][s] + 2.5 * P.QUANTUM


def test_windows_have_target_proportions(spark, monkeypatch):
    """Against the flow T(v): each source has had min(v * target, n) when all have had
    T(v), but for what hashing gives a part more or less of it and quanta under way."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "PART_TOKENS", 40_000)
    rng = random.Random(11)
    rows = [(k, rng.choices(["a", "b", "c", "d", None], [55, 20, 10, 10, 5])[0], rng.randrange(1, 200)) for k in range(6000)]
    lengths = spark.createDataFrame(rows, "row long, source string, n long").repartition(4)
    targets = {"a": 0.2, "b": 0.3, None: 0.25, "nowhere": 0.4}
    size = defaultdict(int)
    for _, s, n in rows:
        size[s] += n
    total, source = sum(size.values()), {k: s for k, s, _ in rows}
    weight = {s: targets.get(s, n / total) for s, n in size.items()}

    def flow(at):
        low, high = 0.0, max(size[s] / weight[s] for s in size)
        for _ in range(60):
            v = (low + high) / 2
            low, high = (v, high) if sum(min(v * weight[s], size[s]) for s in size) < at else (low, v)
        return {s: min(high * weight[s], size[s]) for s in size}

    plan = sorted(P.rotation_plan(lengths, targets).collect(), key=lambda r: r["position"])
    had, at, worst, first = defaultdict(int), 0, 0.0, min(size[s] / weight[s] for s in size) * sum(weight.values())
    for r in plan:
        assert r["position"] == at
        at += r["length"]
        had[source[r["row"]]] += r["length"]
        if at % P.LENGTH == 0:
            want = flow(at)
            worst = max(worst, *(abs(had[s] - want[s]) for s in size))
    assert at == total and dict(had) == dict(size)
    assert total > 14 * P.PART_TOKENS and first > 3 * P.PART_TOKENS  # all sources last for some parts, then one after the other ends
    assert worst < 0.15 * P.PART_TOKENS  # a part holds some 400 documents
    own = sorted(P.rotation_plan(lengths).collect(), key=lambda r: r["position"])
    half = lambda p, s: sum(r["length"] for r in p if r["position"] < first / 2 and source[r["row"]] == s) / (first / 2)
    for s in size:
        assert half(plan, s) == pytest.approx(weight[s] / sum(weight.values()), abs=0.03) and half(own, s) == pytest.approx(size[s] / total, abs=0.03)
    for wrong in (0.0, -1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            P.rotation_plan(lengths, {"a": wrong})


def test_targets_pack_everything_once(documents, corpus):
    count = lambda got: sorted((str(r["doc_id"]), r["doc_tokens"]) for r in got if r["start"] == 0)
    path = P.default_tokenizer()
    got = P.pack(documents(corpus), path, {"c": 0.6, None: 0.1}).collect()
    assert count(got) == count(P.pack(documents(corpus), path).collect())
    assert P.pack(documents([]), path, {"c": 1.0}).count() == 0
    at = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * P.LENGTH + r["offset"] == at
        at += r["length"]


def test_parts_are_bounded_in_documents(documents, monkeypatch):
    monkeypatch.setattr(P, "PART_ROWS", 50)
    got = P.pack(documents([(k, "") for k in range(400)]), P.default_tokenizer()).collect()
    assert sorted(r["sequence_id"] * P.LENGTH + r["offset"] for r in got) == list(range(400)) and {r["length"] for r in got} == {1}


def test_empty_table(documents):
    assert P.pack(documents([]), P.default_tokenizer()).count() == 0


def alternating(n):
    """A word of ``n`` letters and its letter-swapped twin, whose sums of powers
    agree modulo 2 ** 64."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_made_to_collide_keep_their_own_ids():
    from tokenizers import Tokenizer

    tokenizer, cached = Tokenizer.from_file(P.default_tokenizer()), P.WordTokenizer(P.default_tokenizer())
    one, two = alternating(1024)
    for text in (f"{one} {two}", one, two, *alternating(2048)):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert cached.encode(raw, np.array([0, len(raw)]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_hash_numbers():
    rng, table, known = np.random.default_rng(5), P.HashNumbers(), {}
    for size in (0, 1, 3000, 2000, 40_000):
        new = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) >> np.uint64(rng.integers(0, 30)) << np.uint64(11))  # many that want one place
        new = np.array([h for h in new.tolist() if h not in known], np.uint64)
        known |= {h: len(known) + k for k, h in enumerate(new.tolist())}
        table.add(new)
        asked = np.concatenate([np.array(list(known), np.uint64), rng.integers(0, 1 << 63, 1000).astype(np.uint64)])
        assert table.find(asked).tolist() == [known.get(h, -1) for h in asked.tolist()] and table.count == len(known)


def test_words_of_equal_hash_stay_apart(monkeypatch):
    real = P.T.word_hashes
    monkeypatch.setattr(P.T, "word_hashes", lambda d, a, b, seed=0: real(d, a, b, seed) if seed % 2 else (b - a).astype(np.uint64))
    cached, raw = P.WordTokenizer(P.default_tokenizer()), b"cat dog cat sun dog"
    ids, bounds = cached.encode(np.frombuffer(raw, np.uint8), np.array([0, 8, len(raw)]))
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.default_tokenizer())
    assert ids[:bounds[1]].tolist() == plain.encode("cat dog", add_special_tokens=False).ids
    assert ids[bounds[1]:].tolist() == plain.encode("cat sun dog", add_special_tokens=False).ids


def test_letters_edges_and_accents_have_the_tokenizers_ids():
    from tokenizers import Tokenizer

    plain, cached, rng = Tokenizer.from_file(P.default_tokenizer()), P.WordTokenizer(P.default_tokenizer()), random.Random(3)
    kinds = ["abcxyzéßÀÖñ×÷ÿ ", "abAB.,!?'-12 \n\t\x1c\x85 ̀́éªº", "aЁз中，\U0001F600�١1é' "]
    for _ in range(150):
        texts = ["".join(rng.choices(rng.choice(kinds), k=rng.randrange(40))) for _ in range(rng.randrange(1, 20))]
        raw = [t.encode() for t in texts]
        ids, bounds = cached.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        for k, t in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_a_part_is_hashed_once_a_call_and_new_letters_go_together(monkeypatch):
    real, hashed, alone = P.T.word_hashes, [], []
    monkeypatch.setattr(P.T, "word_hashes", lambda d, a, b, seed=0: hashed.append(len(a)) or real(d, a, b, seed))
    cached = P.WordTokenizer(P.default_tokenizer())
    plain = cached.tokenizer

    class Counted:
        def encode_batch_fast(self, words, **options):
            alone.extend(words)
            return plain.encode_batch_fast(words, **options)

    cached.tokenizer = Counted()
    text = "The cat, the élan of the façade; 12 cats. " * 300
    for _ in range(2):
        ids = cached.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert max(hashed) == 11  # the cat , élan of façade ; 1 2 cats .
    assert sorted(alone) == [",", ".", "1", "2", ";"]
