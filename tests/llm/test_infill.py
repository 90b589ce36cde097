import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cxpulse.llm import infill as I

ODD = ["", None, "a", "中", "<P> held", "x<S>", "<M", "<", "<P", "café naïve \U0001F600\U0001F600 ß!", "line\nbreak\r\n\ttab  ", "\x00nul\x00", "12 34", "a<b<S <", "é" * 50, "ab" * 40_000 + "中" * 500]


def brute(doc_id, text, seed="1"):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    alphabet = "abc XYZ.<>PSMé中\U0001F600\n "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(300)] + ODD * 3
    return list(enumerate(texts)) + [(None, "no id here"), (5, texts[5]), (5, "another text of the id"), (-3, "minus")]


def test_equals_brute_force_and_comes_back(documents, corpus):
    done = I.infill(documents(corpus))
    got = done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", I.restored(F.col("output"), F.col("form")).alias("back")).collect()
    want = sorted((str(i), *brute(i, t), t or "") for i, t in corpus)
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want, key=str) or sorted(map(str, ((str(r[0]), *r[1:]) for r in got))) == sorted(map(str, want))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_char_index_both_ways():
    text = "aéb中\U0001F600cß" * 30 + "plain"
    index = I.CharIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in chars])
    assert index.bytes(chars).tolist() == places.tolist() and index.chars(places).tolist() == chars.tolist()
    assert len(index.at) == sum(len(c.encode()) > 1 for c in text)


def test_seed_and_empty_table(documents, corpus):
    got = {r["doc_id"]: r["output"] for r in I.infill(documents(corpus[:50]), seed="2").collect()}
    assert got == {i: brute(i, t, "2")[4] for i, t in corpus[:50]}
    assert I.infill(documents([])).count() == 0


def test_query_equals_sql(spark, documents, corpus, tmp_path):
    documents([r for r in corpus if "\x00" not in (r[1] or "")]).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = I.op12_infill(spark, str(tmp_path)).toPandas()
    want = con.execute(I.SQL).df()
    assert list(got.columns) == list(want.columns)
    key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    assert [x.replace(".0", "") for x in key(got)] == [x.replace(".0", "") for x in key(want)]
