"""Payload round trip (R11) and page publishing."""

import base64
import datetime as dt
import decimal
import json

from pyspark.sql import functions as F

from cxpulse.plans.publish import PayloadSpec, StampSpec, as_payload, publish_pages, report_rows


def test_payload_round_trip(spark):
    df = spark.createDataFrame(
        [("b", decimal.Decimal("1.50"), dt.date(2024, 1, 2), None, "ação"),
         ("a", decimal.Decimal("2.00"), None, 3.5, "x")],
        "team string, amount decimal(10,2), day date, score double, note string")
    p = as_payload(df, PayloadSpec("M", "monthly", (("team", True),))).first()
    assert p.n == 2 and p.name == "M" and p.var == "monthly"
    assert p.js == f'const monthly = JSON.parse(atob("{p.b64}"));'
    assert "\n" not in p.b64 and "\r" not in p.b64
    text = base64.b64decode(p.b64).decode("ascii")           # ASCII only
    assert "\\u00e7" in text.lower()
    assert json.loads(text) == [
        {"team": "a", "amount": 2.0, "day": None, "score": 3.5, "note": "x"},
        {"team": "b", "amount": 1.5, "day": "2024-01-02", "score": None, "note": "ação"},
    ]


def test_payload_keyed(spark):
    df = spark.createDataFrame([("b", 1, 2.0), ("a", 3, 4.0)], "team string, agents long, pct double")
    p = as_payload(df, PayloadSpec("T", "training", key="team")).first()
    assert json.loads(p.json) == {"a": {"agents": 3, "pct": 4.0}, "b": {"agents": 1, "pct": 2.0}}
    assert list(json.loads(p.json)) == ["a", "b"]


def test_payload_descending_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 3)], "team string, enc long")
    p = as_payload(df, PayloadSpec("P", "p", (("team", True), ("enc", False)))).first()
    assert [(r["team"], r["enc"]) for r in json.loads(p.json)] == [("a", 5), ("a", 1), ("b", 3)]


def test_payload_descending_text_key_rejected(spark):
    import pytest
    df = spark.createDataFrame([("a", 1)], "team string, enc long")
    with pytest.raises(ValueError):
        as_payload(df, PayloadSpec("P", "p", (("team", False),)))


def test_report_rows(spark):
    df = spark.createDataFrame([("a", None)], "team string, x double")
    r = report_rows(df, "R").first()
    assert (r.report, json.loads(r.json)) == ("R", {"team": "a", "x": None})


PAGES = [
    (1, "<html><script>\n// __M1_START__\nconst one = [];\n// __M1_END__\n</script>"
        '<span class="b" id="stamp">old</span><style id="css">.b::after{content: "x"}</style></html>'),
    (2, '<html><script>const two = JSON.parse(atob("b2xk"));</script></html>'),
    (3, "<html>nothing here</html>"),
    (4, "<html>// __M1_START__ a // __M1_END__ and // __M1_START__ b // __M1_END__</html>"),
]


def test_publish_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, html string")
    payloads = spark.createDataFrame([("M1", 'const one = ["$1 \\\\ x"];'), ("M2", "const two = 2;")],
                                     "name string, js string")
    specs = [PayloadSpec("M1", "one"), PayloadSpec("M2", "two")]
    out = {r.page_id: r for r in publish_pages(
        pages, payloads, specs, dt.datetime(2024, 1, 17, 16, 5),
        StampSpec(element_ids=("stamp",), style_id="css", suffix=" h")).collect()}

    p1 = out[1]
    assert p1.injected == ["M1"] and p1.missing == ["M2"]
    assert '// __M1_START__\nconst one = ["$1 \\\\ x"];\n// __M1_END__' in p1.html  # literal text
    assert "const one = [];" not in p1.html
    assert '<span class="b" id="stamp">17/01/2024 h</span>' in p1.html
    assert 'content: "17/01/2024 h"' in p1.html
    assert p1.refreshed_at == "17/01/2024 h"

    p2 = out[2]
    assert p2.injected == ["M2"] and p2.html == "<html><script>const two = 2;</script></html>"

    p3 = out[3]
    assert p3.injected == [] and p3.missing == ["M1", "M2"]
    assert p3.html == PAGES[2][1]

    p4 = out[4]                                                     # every block replaced
    assert p4.html.count('const one = ["$1') == 2


def test_publish_pages_unchanged_outside_blocks(spark):
    pages = spark.createDataFrame(PAGES[:1], "page_id long, html string")
    payloads = spark.createDataFrame([("M1", "X")], "name string, js string")
    r = publish_pages(pages, payloads, [PayloadSpec("M1", "one")],
                      dt.datetime(2024, 1, 1)).first()
    before, after = PAGES[0][1].split("// __M1_START__")[0], PAGES[0][1].split("// __M1_END__")[1]
    assert r.html == before + "// __M1_START__\nX\n// __M1_END__" + after


def test_filters_after_publishing_keep_the_plan_linear(spark):
    """Filters on the outputs are pushed down through the per-slot rewrites;
    each rewrite refers to the previous text once, so the plan stays small."""
    pages = spark.createDataFrame(PAGES, "page_id long, html string")
    payloads = spark.createDataFrame([(f"M{i}", f"const v{i} = {i};") for i in range(8)],
                                     "name string, js string")
    specs = [PayloadSpec(f"M{i}", f"v{i}") for i in range(8)]
    out = publish_pages(pages, payloads, specs, dt.datetime(2024, 1, 1),
                        StampSpec(element_ids=("stamp",), style_id="css"))
    filtered = out.where(F.array_contains("injected", "M7") | F.col("html").contains("x"))
    plan = filtered._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000
    assert filtered.count() == 1


def publish_one(spark, html, names=("A", "B")):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    payloads = spark.createDataFrame([(n, f"const {n.lower()} = 1;") for n in names], "name string, js string")
    return publish_pages(pages, payloads, [PayloadSpec(n, n.lower()) for n in names], dt.datetime(2024, 1, 17, 16, 5),
                         StampSpec(element_ids=("x",), style_id="x")).first()


def test_a_block_inside_another_is_missing(spark):
    inner = "// __B_START__ old // __B_END__"
    r = publish_one(spark, f"// __A_START__ {inner} // __A_END__")
    assert r.injected == ["A"] and r.missing == ["B"] and "__B_" not in r.html
    r = publish_one(spark, f"// __A_START__ {inner} // __A_END__", ("B", "A"))    # B comes first, then A takes it away
    assert r.injected == ["A"] and r.missing == ["B"] and "__B_" not in r.html


def test_every_style_block_and_only_matching_tags_are_stamped(spark):
    css = '<style id="x">.a{content: "old"} .b{content:"old"}</style>'
    r = publish_one(spark, css + '<style>.c{content: "keep"}</style>' + css + '<strong id="x">old</strong><strong id="x">keep</span><span id="x">old</span><b id="x">keep</b>')
    assert r.html.count("17/01/2024") == 6 and r.html.count("keep") == 3 and "old" not in r.html


def test_payload_over_the_size_rule_fails(spark):
    import pytest
    df = spark.createDataFrame([("a", "x" * 100)], "team string, note string")
    assert as_payload(df, PayloadSpec("P", "p", (("team", True),)), max_bytes=200).count() == 1
    with pytest.raises(Exception, match="over 100 bytes"):
        as_payload(df, PayloadSpec("P", "p", (("team", True),)), max_bytes=100).collect()
