import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cxpulse.llm import fingerprints as P


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def hashed(shingle_texts):
    """Hash of every shingle: a text of five words is a text of one shingle."""
    listed = sorted(shingle_texts)
    found = P.sketches(pa.array([" ".join(s) for s in listed]))
    return {s: int(h[0]) for s, h in zip(listed, found)}


def kept(text):
    """The sketch by its definition."""
    hashes = sorted(hashed(shingles(text)).values())
    below = [h for h in hashes if h < (1 << 64) // P.ONE_IN]
    return below if len(below) >= P.LEAST else hashes[:P.LEAST]


def likeness(a, b):
    top = lambda s: (1 << 64) if len(s) < P.LEAST else max(s[-1] + 1, (1 << 64) // P.ONE_IN)
    if not a and not b:
        return 1.0
    bound = min(top(a), top(b))
    a, b = {x for x in a if x < bound}, {x for x in b if x < bound}
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def brute(docs, order):
    """One row per document in ``order`` (indices of docs)."""
    out = []
    for place, k in enumerate(order):
        doc_id, text = docs[k][0], docs[k][1] or ""
        after = docs[order[(place + 1) % len(order)]][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        a, e, b = kept(text), kept(edited), kept(after)
        enc = lambda s: P.encoded(np.array(s, np.uint64))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), enc(a), enc(e), likeness(a, e), likeness(a, b)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefghé中", k=rng.randrange(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 9, 40, 120, 800]))) for _ in range(60)]
    texts += ["", None, "   ", texts[0], "One two THREE four five", "one two three four five", " ".join(rng.choices(vocab, k=12_000))]
    rng.shuffle(texts)
    return [(7 * k - 100, t) for k, t in enumerate(texts)]


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=str)


@pytest.mark.parametrize("rows", [16_384, 9])
def test_equals_brute_force(documents, monkeypatch, rows):
    monkeypatch.setattr(P, "BUCKET_ROWS", rows)
    docs = corpus()
    got = P.edited_documents(documents(docs).selectExpr("*", "1 AS bucket", "2 AS tail", "3 AS h", "4 AS times"))
    assert collected(got) == brute(docs, list(range(len(docs))))


def test_repeated_ids_null_ids_and_copies(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 10)
    monkeypatch.setattr(P, "REPEAT_ROWS", 7)
    docs = [(k, f"text number {k} of a few words that differ {k * k}") for k in range(40)]
    docs += [(5, "the same row again and again")] * 45 + [(None, "no id"), (9, docs[9][1]), (9, docs[9][1]), (9, "another text of nine")]
    df = documents(docs)
    h = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(range(len(docs)), key=lambda k: (-(1 << 63) if docs[k][0] is None else docs[k][0], h[docs[k][1]]))
    assert collected(P.edited_documents(df)) == brute(docs, order)


def test_one_document_and_none(documents):
    assert collected(P.edited_documents(documents([(3, "a b c d e f g h")]))) == brute([(3, "a b c d e f g h")], [0])
    assert P.edited_documents(documents([])).count() == 0 and P.fingerprints(documents([])).count() == 0
    r = P.edited_documents(documents([(1, None), (2, "")])).collect()
    assert [(x["fingerprint"], x["near_edited"], x["near_next"]) for x in r] == [("", 1.0, 1.0)] * 2


def test_sketches_merge_and_compare_unequal_texts(documents):
    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(5000)]
    long = [rng.choice(vocab) for _ in range(30_000)]
    texts = [" ".join(long), " ".join(long[5000:9000]), " ".join(long[:500]), "other words altogether here now", ""]
    found = list(P.sketches(pa.array(texts)))
    union = np.unique(np.array(sorted({h for t in texts for h in hashed(shingles(t)).values()}), np.uint64))
    assert np.array_equal(P.merge(found), P.retained(union))
    assert P.likeness(found[0], found[1]) > 0.99 and P.likeness(found[1], found[0]) > 0.99
    half = list(P.sketches(pa.array([" ".join(long[7000:11_000])])))[0]
    assert abs(P.likeness(found[1], half) - 0.5) < 0.12  # 4,000 shingles each, one in 32 seen
    assert P.likeness(found[0], found[3]) == 0.0
    by_id = {r["doc_id"]: r["fingerprint"] for r in P.fingerprints(documents(list(enumerate(texts)))).collect()}
    assert all(np.array_equal(P.decoded(by_id[k]), s) for k, s in enumerate(found))
