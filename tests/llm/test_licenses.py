import re

import duckdb
import numpy as np

from cxpulse.llm import licenses as L

ROWS = [(1, None), (2, ""), (3, "GNU General\nPublic-License and the Apache license"), (4, "mit license mit license cc by"), (5, "submit license"), (6, "cc by\u00e9 cc by"),
        (7, "Licensed under the Apache License, Version 2.0."), (8, "licensed under the apache version 2"), (9, "filler " * 40_000 + "released under the mit license\nx"),
        (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"), (4, "mit license mit license cc by")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(i, text):
    w = words(text)
    places = [(k, label) for p, label in L.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    met = blocks(w)
    base = sorted({x for _, x in places})
    return (i, len(w), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(base),
            ",".join(sorted({*base, *(b[0] for b in met)})), 1.0 if places else max((b[3] for b in met), default=0.0), len(met))


def blocks(w, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    """(label, first, last, containment): of all runs that meet a template, those that
    share one of its words taken together."""
    out = []
    for text, label in templates:
        t, n = set(text.split()), L.run_words(len(text.split()), threshold)
        own = []
        for k in range(len(w)):
            run = range(k, min(k + n, len(w)))
            if len(t & {w[x] for x in run}) >= L.needed(len(t), threshold):
                held = {x for x in run if w[x] in t}
                c = len({w[x] for x in held}) / len(t)
                if own and own[-1][0] & held:
                    own[-1] = (own[-1][0] | held, max(own[-1][1], c))
                else:
                    own.append((held, c))
        out += [(label, min(held), max(held), c) for held, c in own]
    return out


def test_equals_brute_force(documents):
    got = L.scan_licenses(documents(ROWS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((brute(*r) for r in ROWS), key=str)
    assert L.scan_licenses(documents([])).count() == 0


def test_filters_lose_nothing():
    rng = np.random.default_rng(5)
    vocabulary = [b"t%d" % k for k in range(30)]
    templates = [(b" ".join(rng.choice(vocabulary, rng.integers(2, 9), replace=False)).decode(), str(k)) for k in range(12)]
    index = L.TemplateIndex(templates, 0.7, {w: int(rng.integers(100)) for w in vocabulary})
    for _ in range(500):
        block = set(rng.choice(vocabulary, rng.integers(1, 20), replace=False).tolist())
        want = {t: len(block & set(s)) / len(s) for t, s in enumerate(index.sets) if len(block & set(s)) >= L.needed(len(s), 0.7)}
        assert index.matches(block) == want


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""


def test_wrapped_notices(documents):
    comment = lambda text, lead: "\n".join(lead + line for line in text.split("\n"))
    rows = [(1, MIT), (2, BSD), (3, comment(MIT, "# ") + "\r\n\r\n" + comment(BSD, " * ")), (4, MIT.replace(" ", "\n")), (5, "x\n" * 3000 + BSD + "\ny" * 3000),
            (6, BSD.replace(" ", " far away from the next one\n")), (7, "released\nunder the\nmit"), (8, "released\nunder the\n\nmit \nmit a b c released"),
            (9, "released under the mit\nlicence released under the a\nmit license"), (10, "no notice\nat all"), (11, "\n"), (12, MIT.replace("hereby ", "").replace("free ", ""))]
    got = {r["doc_id"]: tuple(r) for r in L.scan_licenses(documents(rows)).collect()}
    assert got == {i: brute(i, text) for i, text in rows}
    assert [got[k][6:8] for k in (1, 2, 3, 4, 5)] == [("mit-notice", 1.0), ("bsd-notice", 1.0), ("bsd-notice,mit-notice", 1.0), ("mit-notice", 1.0), ("bsd-notice", 1.0)]
    assert got[6][6:] == ("", 0.0, 0)


def test_runs_lose_nothing():
    rng = np.random.default_rng(6)
    vocabulary = [b"t%d" % k for k in range(12)]
    templates = [(b" ".join(rng.choice(vocabulary, rng.integers(1, 9))).decode(), str(k)) for k in range(12)]
    index = L.TemplateIndex(templates, 0.7, {w: int(rng.integers(100)) for w in vocabulary})
    for _ in range(300):
        text = rng.choice([*vocabulary, b"x", b"y", b"z"], rng.integers(1, 60)).tolist()
        got = [(index.labels[t], *b) for t, found in index.run_matches(text).items() for b in found]
        assert sorted(got) == sorted(blocks([w.decode() for w in text], templates, 0.7))


def test_blocks_with_places(documents):
    notice = "Released under\nthe MIT License"
    rows = [(1, f"a b {notice} c d e f g h {notice}"), (2, None), (3, ""), (4, "no notice"), (5, notice), (5, notice)]
    got = sorted(tuple(r) for r in L.license_blocks(documents(rows)).collect())
    assert got == sorted((i, *b) for i, text in rows for b in blocks(words(text)))
    assert [r[2:4] for r in got if r[0] == 1] == [(2, 6), (13, 17)] and len(got) == 4
    assert L.license_blocks(documents([])).count() == 0


def test_scattered_words_are_no_notice(documents):
    gap = " w" * 2000 + " "
    scattered = gap.join(["released", "under", "the", "mit", "license"])
    near = "released (as of today) under the mit license"  # 8 words, runs have 7: 0.8 of the template
    rows = [(1, scattered), (2, near), (3, "released under our mit license")]
    got = {r["doc_id"]: tuple(r) for r in L.scan_licenses(documents(rows)).collect()}
    assert got == {i: brute(i, text) for i, text in rows}
    assert got[1][6:] == ("", 0.0, 0) and got[3][6] == "mit,mit-release"


def test_sql_has_the_same_blocks():
    texts = [MIT, BSD, MIT.replace(" ", "\n"), "x\n" * 300 + BSD + "\ny" * 300, BSD.replace(" ", " far away from the next one\n"), "released\nunder the\nmit",
             "released under the mit\nlicence released under the a\nmit license", (MIT + " ") * 3, "released under the mit license " * 4, "released" + " w" * 50 + " under the mit license", None, ""]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = con.execute(L.SQL).fetchall()
    assert sorted(got) == sorted(brute(i, t) for i, t in enumerate(texts))
