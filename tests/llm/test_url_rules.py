import time
from itertools import combinations, product

from cxpulse.llm import url_rules as U

URLS = [(1, None), (2, ""), (3, "no scheme/net/"), (4, "http://A.B.NET/x?y#z"), (5, "https://example.net/en/1"), (6, "http://m.example.net/en"), (7, "http://example.com/de/"), (8, "http://notexample.com/de/"),
        (9, "http://x.org/fr/a"), (10, "http://x.org/FR/a"), (11, "ftp://net/"), (12, "http://net"), (13, "http://?q=1"), (14, "x://a://b/c"), (4, "http://A.B.NET/x?y#z"), (15, "http://long.org/" + "a/" * 20_000)]


MAX_TOKENS = 4  # up to which all token sets are counted


def mined_sets(rules):
    """(tokens, label) -> confidence: an item of a rule stands for any of its tokens."""
    return {(tuple(sorted(c)), r["label"]): round(r["confidence"], 9) for r in rules.collect() for c in product(*r["groups"])}


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end], rest[end:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail.split("?")[0].split("#")[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_fixed_rules(spark):
    got = U.judge(spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS label", "1 AS n"))
    rows = got.collect()
    assert len(rows) == len(URLS)
    by_id = {r["page_id"]: r for r in rows}
    for i, url in URLS:
        host, path = parse(url)
        name, verdict = rule(host, path)
        r = by_id[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, name) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict


def test_empty_table_and_no_labels(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert [r["verdict"] for r in U.judge(spark.createDataFrame([(1, None)], "page_id long, url string")).collect()] == ["allow"]


def test_rules_equal_brute_force(spark):
    """FP-growth, pruning, index and decision against counting all token sets."""
    urls = [f"http{'s' * (k % 3 == 0)}://{'www' if k % 4 else 'm'}.h{k % 5}.{['net', 'com', 'org'][k % 3]}/{['en', 'de'][k % 7 % 2]}/{k}" for k in range(120)]
    labelled = [(u, "block" if ".net" in u or "/de/" in u and k % 5 else "allow") for k, u in enumerate(urls)]
    df = spark.createDataFrame(labelled, "url string, label string")
    sets = [frozenset(r["t"]) for r in df.select(U.tokens(df["url"]).alias("t")).collect()]
    labels = [r["label"] for r in df.collect()]
    support, sure = 0.1, 0.7
    counted = {}
    for s, label in zip(sets, labels):
        for n in range(1, MAX_TOKENS + 1):
            for c in combinations(sorted(s), n):
                both = counted.setdefault(c, {"block": 0, "allow": 0})
                both[label] += 1
    rules = {(c, y): n[y] / sum(n.values()) for c, n in counted.items() for y in n if n[y] >= support * len(sets) - 1e-9 and n[y] / sum(n.values()) >= sure}
    kept = {(c, y): p for (c, y), p in rules.items() if not any(rules.get((tuple(x for x in c if x != out), y), -1) >= p for out in c if len(c) > 1)}
    mined = U.mine(df, support, sure)
    assert mined_sets(mined) == {k: round(p, 9) for k, p in kept.items()}
    queries = spark.createDataFrame([(k, sorted(s)) for k, s in enumerate(set(sets))], "items_id long, tokens array<string>")
    got = {r["items_id"]: r["label"] for r in U.match(queries, mined).collect()}
    for r in queries.collect():
        hits = [(p, y) for (c, y), p in kept.items() if set(c) <= set(r["tokens"])]
        assert (r["items_id"] in got) == bool(hits)
        if hits:
            assert got[r["items_id"]] in {y for p, y in hits if abs(p - max(hits)[0]) < 1e-9}


def test_rules_of_every_length(spark):
    """Five tokens together are sure, any four of them are not."""
    full = [f"path{k}:{x}" for k, x in enumerate("abcde")]
    urls = [("http://h.org/a/b/c/d/e", "block")] * 40
    urls += [("http://h.org/" + "/".join("abcde"[:k] + "x" + "abcde"[k + 1:]), "allow") for k in range(5)] * 20
    labelled = spark.createDataFrame(urls, "url string, label string")
    sets = [(frozenset(r["t"]), r["label"]) for r in labelled.select(U.tokens(labelled["url"]).alias("t"), "label").collect()]
    sure = {}
    for c in {c for s, _ in set(sets) for n in range(1, len(s) + 1) for c in combinations(sorted(s), n)}:
        held = [y for s, y in sets if s.issuperset(c)]
        sure |= {(c, y): held.count(y) / len(held) for y in set(held) if held.count(y) >= 0.1 * len(sets) and held.count(y) / len(held) >= 0.7}
    kept = {(c, y): p for (c, y), p in sure.items() if not any(sure.get((tuple(x for x in c if x != out), y), -1) >= p for out in c if len(c) > 1)}
    mined = U.mine(labelled, 0.1, 0.7)
    assert mined_sets(mined) == {k: round(p, 9) for k, p in kept.items()}
    assert (tuple(full), "block") in kept


def test_deep_paths_are_mined_in_seconds(spark):
    """Half of the urls on one path of thirty segments: thirty tokens of the same
    urls, one item."""
    deep = "/".join(f"s{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(30))
    urls = [(f"http://h.org/{deep}", "block")] * 50 + [("http://h.org/a/b", "allow")] * 50
    start = time.time()
    rules = U.mine(spark.createDataFrame(urls, "url string, label string"), 0.1, 0.7).collect()
    assert time.time() - start < 60
    (blocked,) = [r for r in rules if r["label"] == "block"]
    assert blocked["n"] == 1 and len(blocked["groups"][0]) == 30 and blocked["confidence"] == 1.0
    assert all(r["confidence"] == 1.0 and r["n"] == 1 for r in rules)
