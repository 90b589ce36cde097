import itertools
import time

import pytest

from cxpulse.llm import html_text as H

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this.</div>'
        '<article><h1>Title &amp; more</h1><p><b>First\n text.<br><p>Second  <i>it</i>alic.</p><aside>Side</aside><p>Short</p></article><div id="comments"><p>I like it.</p></div><form><label>Name</label><input></form><footer>&copy; x</footer>')
WANT = "Title & more First text. Second italic. Short"


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS label")
    return make


def test_main_text(pages):
    rows = [(i, "u", PAGE.replace("First", f"First{i}")) for i in range(30)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "<html><body><nav>only menu</nav>"), (103, "u", "<article>" + "<p>word \u00e9 &#233;</p>" * 5000), (0, "u", rows[0][2]), (104, "u", '<main><p class="x>broken <p>fine</main>')]
    got = H.extract(pages(rows))
    by_id = {r["page_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.collect())
    assert all(by_id[i] == WANT.replace("First", f"First{i}") for i in range(30))
    assert by_id[100] == by_id[101] == by_id[102] == ""
    assert by_id[103] == " ".join(["word \u00e9 \u00e9"] * 5000)
    assert H.extract(pages([])).count() == 0


def test_marginals_equal_enumeration():
    """Sum-product against the sum over all labellings."""
    counts = {}
    for _ in range(20):
        nodes = H.parse(PAGE)
        labels = H.landmark_labels(nodes)
        for k, n in enumerate(nodes[1:], 1):
            for key in [(f"tag:{n.tag}", labels[n.parent], labels[k]), *((f, 0, labels[k]) for f in H.features(n))]:
                counts[key] = counts.get(key, 0) + 1
    model = H.TreeModel(counts)
    nodes = H.parse('<body><div class="menu"><p>One.</p></div><section><p>Two two two.</p><ul><li>x</li></ul></section>')
    weight = 1 / sum(n.text is not None for n in nodes)
    total, content = 0.0, [0.0] * len(nodes)
    for ys in itertools.product((0, 1), repeat=len(nodes)):
        p = (0.99, 0.01)[ys[0]]
        for k, n in enumerate(nodes):
            if k:
                p *= model.edge(n.tag)[ys[n.parent]][ys[k]]
            for f in H.features(n):
                p *= model.node(f)[ys[k]] ** (weight if n.text is not None else 1)
        total += p
        for k, y in enumerate(ys):
            content[k] += p * y
    assert model.marginals(nodes) == pytest.approx([c / total for c in content])


KEPT = [
    ("<p>One <svg class='i'/> two.</p><p>Three.</p>", "One two. Three."),
    ("<p>One <math/> two.</p><p>Three.</p>", "One two. Three."),
    ("<svg class='i'/><p>One.</p><svg><path d='M0'/></svg><p>Two.</p>", "One. Two."),
    ("<p>Let <math><mi>x</mi></math> be.</p>", "Let x be."),
    ("<svg><text>Label.</text></svg><p>One.</p>", "Label. One."),
    ("<p>One <object data='x'><p>Inside.</p></object> two.</p>", "One Inside. two."),
    ("<map name='m'><p>Area.</p><area href='x'></map><canvas><p>Drawn.</p></canvas><video><p>Film.</p></video><audio>Sound.</audio>", "Area. Drawn. Film. Sound."),
    ("<p>One.</p><input list='d'><datalist id='d'><option value='a'>A<option value='b'>B</datalist><p>Two.</p><p>Three.</p>", "One. Two. Three."),
    ("<p>One.</p><select><option>A<option>B</select><p>Two.</p>", "One. Two."),
    ("<p>One.</p><select><optgroup><option>A<p>Two.</p>", "One. Two."),
    ("<p>One.</p><textarea>Two.<p>Three.</p>", "One. Two. Three."),
    ("<p>One.</p><iframe src='x'><p>Two.</p><iframe src='y'><p>Three.</p>", "One. Two. Three."),
    ("<p>One.</p><script>var a = 1;<p>Two.</p>", "One. Two."),
    ("<p>One.</p><script>var a = '<p>No.</p>';</script><style>p{}</style><template><p>No.</p></template><textarea>No.</textarea><p>Two.</p>", "One. Two."),
]


def test_only_raw_text_elements_are_skipped(pages):
    rows = [(i, "u", f"<html><body><nav>Menu</nav><article>{body}</article><footer>&copy; x</footer>") for i, (body, _) in enumerate(KEPT)]
    rows += [(len(KEPT), "u", "<article><p>One.</p><script>var a = 1; cut off")]
    got = {r["page_id"]: r["text"] for r in H.extract(pages(rows)).collect()}
    assert [got[i] for i in range(len(KEPT))] == [want for _, want in KEPT]
    assert got[len(KEPT)] == "One."
    nodes = H.parse("<article>" + "<textarea><p>w</p>" * 20_000)  # the missing end tag is looked for once
    assert [n.text for n in nodes if n.text is not None] == ["w"] * 20_000


def test_deep_and_crossed_nesting_takes_linear_time():
    start = time.process_time()
    for page in ("<div>" * 200_000, "<div><p>" * 100_000, "<b>" * 200_000 + "</b>" * 200_000, "<select>" * 200_000, "<a " * 200_000, "<a><b></a>" * 100_000):
        nodes = H.parse(page + "x")
        assert all(n.parent < k for k, n in enumerate(nodes))
    assert time.process_time() - start < 30
    nodes = H.parse("<div>a<b><a>x<ul><li>1<p>2<li>3</a></ul></b>y</a>z</div>w")
    assert [(n.tag, n.parent, n.text) for n in nodes if n.text] == [("#text", 1, "ax"), ("#text", 4, "1"), ("#text", 6, "2"), ("#text", 8, "3"), ("#text", 1, "yz"), ("#text", 0, "w")]
