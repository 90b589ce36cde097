import hashlib
import re
from collections import defaultdict

from cxpulse.llm import exact_dedup as X

ROWS = [(5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (1, None), (2, ""), (4, " "), (7, "long " * 30_000), (8, "long\n" * 30_000),
        (3, "a b c"), (11, "ä\u00a0b"), (12, "ä b"), (None, "only null id"), (None, "a b c")]


def test_groups_equal_brute_force(documents):
    got = X.exact_dedup(documents(ROWS))
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = sorted([(i, min((x for x in g if x is not None), default=None), len(g), i == min((x for x in g if x is not None), default=None),
                    hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g], key=str)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == want


def test_keep_one_keeps_columns_and_a_repeated_row_once(documents):
    docs = documents(ROWS)
    kept = X.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 11, 12, 3, 4, 7, 9, None]


def test_empty_table(documents):
    assert X.exact_dedup(documents([])).count() == 0
    assert X.keep_one(documents([])).count() == 0


def test_cuckoo_insert_delete_resize():
    index = X.CuckooIndex(buckets=4)
    for d in range(500):
        assert index.insert(d, b"s%d" % d, 1, d)
    assert index.resizes > 0 and all(index.find(d, b"s%d" % d, 1) for d in range(500))
    assert not index.insert(7, b"s7", 1, 3) and index.find(7, b"s7", 1) == [3, 2, 1]
    # equal digest, other content: verified apart
    assert index.insert(7, b"other", 1, 99) and index.find(7, b"other", 1) == [99, 1, 1]
    for d in range(0, 500, 2):
        assert index.delete(d, b"s%d" % d, 1) and not index.delete(d, b"s%d" % d, 1)
    assert all((index.find(d, b"s%d" % d, 1) is None) == (d % 2 == 0) for d in range(500))


def test_update_index(documents):
    index = X.build_index(X.digest_rows(documents([(1, "a"), (2, "b"), (3, "b")])))
    new = X.update_index(index, X.digest_rows(documents([(9, "b"), (4, "c")])), X.digest_rows(documents([(0, "a"), (0, "x")])))
    assert sorted((r["keep_id"], r["n_rows"]) for r in new.collect()) == [(2, 3), (4, 1)]
