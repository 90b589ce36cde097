import random

import numpy as np

from cxpulse.llm import textnum as T


def test_word_hashes_tell_words_apart():
    rng = random.Random(3)
    words = {"".join(rng.choices("ab\x00z", k=rng.choice([1, 2, 7, 8, 9, 16, 17, 127, 128, 129, 500]))).encode() for _ in range(3000)}
    words |= {b"a" * n for n in range(1, 400)} | {b"\x00" * n for n in range(1, 20)}
    words = sorted(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    past = np.cumsum([len(w) for w in words])
    first = past - np.array([len(w) for w in words])
    h = T.word_hashes(data, first, past)
    assert len(set(h.tolist())) == len(words) and len(set(T.word_hashes(data, first, past, seed=1).tolist()) & set(h.tolist())) == 0
    again = T.word_hashes(np.concatenate([np.frombuffer(b"xyz", np.uint8), data]), first + 3, past + 3)
    assert np.array_equal(h, again)
    assert len(T.word_hashes(data[:0], first[:0], past[:0])) == 0
