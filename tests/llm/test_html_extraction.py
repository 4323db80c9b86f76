from __future__ import annotations

import html
import math
import re
import time

import numpy as np
import pytest

from roadpulse.llm import html_extraction
from roadpulse.llm.html_blocks import blocks

SCHEMA = "page_id long, url string, html string, text string, draw int"


def texts(page):
    return [t for _, t, _ in blocks(page)]


def test_blocks_of_broken_markup():
    assert texts(None) == texts("") == texts("<p></p>") == []
    assert texts("no markup &amp; all") == ["no markup & all"]
    assert texts("<p>a<b>b</b> c<p>d<br>e<!-- x <p>no --><i>f</p>g") == ["ab c", "d", "ef", "g"]
    assert texts("<script>if (a<b) '</p>'</script>x<style>p{}</style><noscript><p>n</p></noscript>y<script>open") == ["xy"]
    assert texts("<ul><li>1<li>2</ul><table><tr><td>3<td>4<tr><td>5</table>") == ["1", "2", "3", "4", "5"]
    assert texts("<div title='a>b'>x &#233;&nbsp;&lt;p&gt;  \n y</div></div></p>z < 3") == ["x é <p> y", "z < 3"]
    assert texts("<head><title>t</title></head><body>b") == ["b"]
    paths = [p for p, _, _ in blocks('<div class="postBody main-text" id=x1 role="main"><p>a</p></div>')]
    assert paths == [("<div", "post", "body", "main", "text", "x", "1", "main", "<p")]
    assert len(blocks("<div>" * 5000 + "deep")) == 1
    assert len(blocks("<p>x" * 30_000)) == 30_000


def test_left_out_tags_hide_no_text():
    assert texts("<head><title>t</title><p>a<p>b") == ["a", "b"]
    assert texts("<!doctype html><html><head><meta charset=x>\n<title>t <p></title>\n text <b>c</b>") == ["text c"]
    assert texts("<head><link rel=x><script>s</script><title>t</title> <i>a</i></head><body>b") == ["a", "b"]
    assert texts("<head><title>t</title> last") == ["last"] and texts("<head><title>t</title>  ") == []
    assert texts("<video-js id=x></video-js><p>a</p><audio-player>b</audio-player><p>c<style-x>d") == ["a", "b", "c", "d"]
    assert texts("<svg><path d=x><p>a</p><p>b") == ["a", "b"]
    assert texts("<p>a</p><noscript><img src=x><p>b</p><noscript>n</noscript><p>c") == ["a", "b", "c"]
    assert texts("<object data=x><p>a<object>n<object>m</object></object><p>b<video>n</video>c") == ["a", "bc"]
    assert texts("<p>a<svg><svg>n</svg>m</svg><canvas/>b<STYLE>open <p>x") == ["ab"]
    assert texts("<noscript><iframe src=x></noscript><p>a<iframe>n</iframe><video><iframe></video><p>b") == ["a", "b"]
    assert texts("<video><iframe></video><p>a<iframe>n</p>") == ["a"]
    assert texts("<p>x<svg>" * 20_000 + "<!-- open <p>n") == ["x"] * 20_000


BAD = [
    '<p a="x>t ', "<p a='x ", "<b><p>t", "<b>", "<i>x</b>", "<div><li>x", "<div>t", "<a>x<br>", '<p class="q q ', "<script ", "<!-- x", '<p "',
    "<noscript>", "<textarea>", "<svg>t<p>", "<td><div>x", "</p>x", '<a href="x>', "<table><li>y", '<p title="abc>text</p>', '= "', "<x = ",
    "<title>", "<head><title>x", "<a><p>x", "<label>x<div>", "<![CDATA[", '<p class="a b c d e f g">', "<", "<div ", "<dt>x<dd>y", "<p hidden",
]


@pytest.mark.parametrize("bad", BAD)
def test_a_megabyte_of_bad_markup_is_read_at_once(bad):
    page = bad * (1_000_000 // len(bad))
    started = time.process_time()
    blocks(page)
    assert time.process_time() - started < 5  # tens of minutes if it were quadratic


def test_quotes_without_a_partner_swallow_no_text():
    assert texts('<p title="abc>text</p><p>b') == ["text", "b"]
    assert texts('<p title="abc>text <a href="x">link</a></p>') == ["text link"]
    assert texts("<p title='a > b' class=x>c</p>") == ["c"] and texts('<a href="q?a=\'b\'&c">d</a>') == ["d"]
    assert texts("<p don't>e</p>") == ["e"] and texts('<p a="1"b="2">f') == ["f"]
    assert texts("a < b <p>c") == ["a < b", "c"] and texts("x <3 y") == ["x <3 y"]


def test_forms_and_definitions():
    assert texts("<form><textarea><p>typed</p></textarea>x</form>") == ["x"]
    assert [(p, t) for p, t, _ in blocks("<dl><dt>a<dd>b<dt>c</dl>")] == [
        (("<dl", "<dt"), "a"), (("<dl", "<dd"), "b"), (("<dl", "<dt"), "c")
    ]
    assert blocks("<div style='display: none'><p>x</div>")[0][0] == ("<div", "hidden", "<p")


def test_deep_elements_follow_each_other():
    found = blocks("<div>x" * 2000)
    assert [t for _, t, _ in found] == ["x"] * 2000 and max(len(p) for p, _, _ in found) <= 257


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extraction.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    model = html_extraction.Labeller.fresh()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [rng.normal(size=(n, html_extraction.PATH + html_extraction.WORDS + html_extraction.MEASURES)) for n in (4, 2)]
    x, there = html_extraction.padded(pages)
    y = rng.random(there.shape) < 0.5
    _, grad = model.gradients(x, there, y)
    for name, w in model.weights.items():
        at = tuple(rng.integers(s) for s in w.shape)
        w[at] += 1e-2
        up, _ = model.gradients(x, there, y)
        w[at] -= 2e-2
        down, _ = model.gradients(x, there, y)
        w[at] += 1e-2
        assert grad[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def plain_score(weights, rows):
    """The network by its equations, one block and one number at a time."""

    def sigmoid(v):
        return 1 / (1 + math.exp(-v))

    size, states = html_extraction.HIDDEN, {}
    for d in "fb":
        h, c, out = [0.0] * size, [0.0] * size, {}
        order = range(len(rows)) if d == "f" else reversed(range(len(rows)))
        for t in order:
            gates = [
                sum(float(a) * float(b) for a, b in zip(rows[t], weights[d + "x"][:, j])) + float(weights[d + "c"][j])
                + sum(h[k] * float(weights[d + "h"][k, j]) for k in range(size))
                for j in range(4 * size)
            ]
            for j in range(size):
                i, f, o, g = sigmoid(gates[j]), sigmoid(gates[size + j]), sigmoid(gates[2 * size + j]), math.tanh(gates[3 * size + j])
                c[j] = f * c[j] + i * g
            h = [sigmoid(gates[2 * size + j]) * math.tanh(c[j]) for j in range(size)]
            out[t] = h
        states[d] = out
    found = []
    for t in range(len(rows)):
        both = states["f"][t] + states["b"][t]
        found.append(sum(a * float(b) for a, b in zip(both, weights["o"])) + float(weights["s"][0]))
    return found


def test_the_network_equals_its_equations():
    rng = np.random.default_rng(7)
    model = html_extraction.Labeller.fresh(seed=8)
    rows = rng.random((4, html_extraction.PATH + html_extraction.WORDS + html_extraction.MEASURES)).astype(np.float32)
    got = model.scores(*html_extraction.padded([rows]))[:, 0]
    assert got == pytest.approx(plain_score(model.weights, rows), abs=1e-4)


def test_padding_changes_nothing(labeller):
    rng = np.random.default_rng(2)
    pages = [rng.random((n, html_extraction.PATH + html_extraction.WORDS + html_extraction.MEASURES)).astype(np.float32) for n in (9, 1, 30, 0, 4)]
    together = labeller.labels(pages)
    assert all((a == labeller.labels([p])[0]).all() for a, p in zip(together, pages))


def test_layouts_never_met(labeller):
    """Held-out layouts: nearly all blocks are told apart."""
    layouts, reader = html_extraction.Layouts(["Some words of a longer text, with stops. And more of them."] * 9, seed=99), html_extraction.Reader()
    made = [layouts.page() for _ in range(300)]
    got = np.concatenate(labeller.labels([reader.vectors(f) for f, _ in made]))
    assert (got == np.concatenate([m for _, m in made])).mean() > 0.96


P = "<p>Thnd erth of the onre, and inat ered to the blewh.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a href=x>Home</a></nav><article><h1>MAIN</h1>{P}{P}</article><footer>c 2024</footer>",
        f"<body><header>Site</header><main><article><h1>MAIN</h1>{P}{P}<section class='comments'><article class=comment>"
        f"<p>Good one indeed, my friend.</p></article></section></article></main><footer><p>All rights</p></footer>",
        f"<body><div role=banner>The Site</div><div role=navigation><a href=x>A</a></div><div id=main><h1>MAIN</h1>{P}{P}</div><div role=contentinfo>foot</div>",
        f"<body><div class=layout><div class=sidebar><h3>Popular</h3><a href=q>Other one</a></div><div class=content><h1>MAIN</h1>{P}{P}</div></div>",
        f"<body><article><h1>MAIN</h1>{P}<div class=advert>Buy now</div>{P}<form><label>Mail</label></form></article><div id=cookie-consent><p>We store data.</p></div>",
    ],
)
def test_known_layouts(spark, labeller, page):
    df = spark.createDataFrame([(1, "u", page, "old", 3)], SCHEMA)
    found = html_extraction.extract(df, labeller).first().text
    assert found == " ".join(["MAIN", *["Thnd erth of the onre, and inat ered to the blewh."] * 2])


SAID = "Thnd erth of the onre, and inat ered to the blewh."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"{SAID} {SAID}", f"{SAID} {SAID}"),
        (f"<body><div id=kopf>Seite</div><div id=inhalt><h1>MAIN</h1>{P}{P}</div><div id=fusszeile>Impressum</div>", f"MAIN {SAID} {SAID}"),
        (f"<body><div class=qwe><a href=x>Uno</a></div><div class=rtz><h1>MAIN</h1>{P}{P}{P}{P}</div><div class=uio><a href=y>Tres</a></div>", f"MAIN {SAID} {SAID} {SAID} {SAID}"),
        (f"<article><h1>MAIN</h1>{P}<dl><dt>Word here</dt><dd>Meaning of it all, as told.</dd></dl>{P}</article>",
         f"MAIN {SAID} Word here Meaning of it all, as told. {SAID}"),
        (f"<body><article><h1>MAIN</h1>{P}<div hidden>{P}</div>{P}</article><div style='display:none'>{P}</div>", f"MAIN {SAID} {SAID}"),
        (f"{P}{P}{P}", f"{SAID} {SAID} {SAID}"),
        (f'<article><p title="abc>{SAID}</p>{P}</article>', f"{SAID} {SAID}"),
    ],
)
def test_plain_foreign_hidden_and_broken_pages(spark, labeller, page, want):
    df = spark.createDataFrame([(1, "u", page, "old", 3)], SCHEMA)
    assert html_extraction.extract(df, labeller).first().text == want


def test_articles_without_names(spark, labeller):
    """Pages without any class, id or role: paths, words and order alone tell the article."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    bare = [re.sub(r"""\s(class|id|role|itemprop)=("[^"]*"|'[^']*'|[^\s>]+)""", "", r.html) for r in rows]
    df = spark.createDataFrame([(r.page_id, r.url, b, "", 0) for r, b in zip(rows, bare)], SCHEMA)
    got = {r.page_id: r.text for r in html_extraction.extract(df, labeller).collect()}
    assert sum(got[r.page_id] == article(r.html) for r in rows) >= 0.97 * len(rows)


def article(page):
    inner = page.split("<article>")[1].split("</article>")[0]
    want = " ".join(html.unescape(re.sub(r"</?b>", "", x)) for x in re.split(r"</?(?:p|br|h1)>", inner))
    return " ".join(want.split())


def test_query_extracts_articles(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in html_extraction.op7_html_extraction(spark, sf_dir).collect()}
    right = 0
    for r in rows:
        right += got[r.page_id].text == article(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert right >= 0.98 * len(rows) and len(got) == len(rows)


def test_odd_rows(spark, labeller):
    long = "<body><article>" + P * 20_000 + "</article>"
    pages = [(1, None, None, "x", 1), (2, "u", "", "x", 1), (3, "u", "<nav><a href=a>b</a></nav>", "x", 1), (None, "u", long, "x", 1), (4, "u", long, "x", 1), (4, "u", long, "x", 1)]
    df = spark.createDataFrame(pages, SCHEMA)
    got = html_extraction.extract(df, labeller)
    assert got.columns == ["page_id", "url", "draw", "text"]
    rows = {r.page_id: r.text for r in got.collect()}
    assert got.count() == 6 and rows[1] == rows[2] == rows[3] == "" and rows[None] == rows[4] and rows[4].count("onre") == 20_000


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    html_extraction_small = html_extraction.train(none)
    assert html_extraction.extract(none, html_extraction_small).count() == 0
