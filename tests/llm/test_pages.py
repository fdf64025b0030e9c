"""HTML main text and URL filters."""

import datetime as dt
import html as H
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from opslog.llm import htmltext, queries, urlfilter
from opslog.llm.boosting import fit
from opslog.llm.dom import Page, attribute_words
from tests.llm.fixtures import CLASH

SF = "/root/testdata/sf0.01"


def article(h):
    """Blocks of the pages' one template, read with plain expressions."""
    inner = re.search(r"<article>(.*)</article>", h, re.S)[1]
    blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_main_text_of_all_pages(spark, model):
    want = {i: (u, article(h)) for i, u, h in duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()}
    got = htmltext.extract(spark.read.parquet(f"{SF}/pages.parquet"), model).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_other_layouts(model):
    prose = [t for (h,) in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' LIMIT 120").fetchall() for t in article(h).split("\n\n")]
    made = htmltext.Layouts(prose, 4242)
    tp = fp = fn = 0
    for at in range(0, 400, 4):
        p = Page(made.page([("p", t) for t in prose[at:at + 4]]))
        y = htmltext._labels(p, False)
        want = {p.text[i] for i in range(len(y)) if y[i] and p.tag[i] == "#"}
        got = set(model.texts([p])[0].split("\n\n")) - {""}
        tp, fp, fn = tp + len(want & got), fp + len(got - want), fn + len(want - got)
    assert tp / (tp + fp) > 0.93 and tp / (tp + fn) > 0.93


def test_decoding_has_no_kept_node_under_a_dropped_one(model):
    p = Page("<div><section><p>a</p><p>b</p></section></div>")
    leaf = [i for i, t in enumerate(p.tag) if t == "#"]
    z = [0.0] * len(p.tag)
    z[leaf[0]], z[leaf[1]] = 2.0, -1.0
    assert htmltext.decode(p, z) == "a"
    z[p.tag.index("section")] = -3.0  # the ancestor outweighs the leaf, and takes it along
    assert htmltext.decode(p, z) == ""


def test_parser_cases():
    def leaves(h):
        p = Page(h)
        return [p.text[i] for i in range(len(p.tag)) if p.tag[i] == "#"]

    assert leaves("<p>a &amp;amp; &lt;b&gt; &#233;&nbsp;c<br>d<p>e<li>f<li>g") == ["a &amp; <b> é c d", "e", "f", "g"]
    assert leaves('<script>var t="</p>x";</script><p>a</p><style>p{}</style><!-- c --><title>t</title>b') == ["a", "b"]
    assert leaves("<p title='a > b'>x</p><p title='broken>y</p>z") and leaves("<script>never closed <p>x") == []
    assert leaves("a <b>b</b><i>c</i> <a href=x>d</a>") == ["a bc d"] and leaves("1 < 2 <3") == ["1 < 2 <3"]
    assert leaves("<div>" * 3000 + "x" + "</div>" * 3000) == ["x"] and leaves("</p></div>") == [] and leaves(None) == []
    assert leaves("<!-- open <p>x") == [] and len(leaves("<td>" * 50 + "x")) == 1
    assert "sidebar" in attribute_words(' class="sideBar-left" href="x.nav"') and attribute_words(" class=a1") == ["a"]
    Page("<a " + '"' * 20_000)
    Page("<" * 20_000 + "<a b='" * 5_000)


ARTICLE = "<article><h1>T</h1><p>a b<svg><path d='x'/></svg> c</p><button>B</button><p>d</p></article>"


@pytest.mark.parametrize("before", [
    "<svg class=icon/>", "<svg class='icon'/>", "<svg><path/>", "<svg><title/><style/></svg>", "<math/>", "<video src=x/>", "<video src=x>",
    "<audio>", "<object/>", "<object data=x>", "<canvas>", "<button>Menu", "<noscript>", "<noscript><img src=x>", "<select><option>one",
    "<template>", "<button>Menu</button>", "<noscript><p>No script</noscript>", "<div><button>Menu</div>", "<object><p>old</p></object>",
    "<svg><foreignObject><div>z</div></foreignObject></svg>", "<iframe>z</iframe>", "<noscript><div>z</div></noscript>", "<p>" + "<button>" * 3])
def test_dropped_elements_before_an_article(before):
    p = Page(f"<body>{before}{ARTICLE}<p>end</p></body>")
    got = [p.text[i] for i in range(len(p.tag)) if p.tag[i] == "#"]
    assert got == ["T", "a b c", "d", "end"] and p.tag.count("article") == 1


def test_formulas_and_raw_elements():
    def leaves(h):
        p = Page(h)
        return [p.text[i] for i in range(len(p.tag)) if p.tag[i] == "#"]

    assert leaves("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding=t>x=1</annotation></math> holds</p>") == ["so x=1 holds"]
    for t in ("script", "style", "textarea", "title", "xmp", "iframe"):
        assert leaves(f"<p>a</p><{t}>never closed <p>x") == ["a"]
    assert leaves("<p>a</p><svg>icon<p>b</p>" * 3000) == ["a", "b"] * 3000
    assert len(leaves("<button>" * 20_000 + "<p>x</p>" + "</svg>" * 20_000)) == 1


def test_labels_leave_out_comments_and_adverts_inside_an_article():
    p = Page("<article class='post has-sidebar'><header class=entry-header><h1>T</h1></header><p>a</p><div class='box ad-slot'>ad</div>"
             "<section id=article-comments><article class=comment><p>c</p></article></section><div class=post-content>b</div></article><p>o</p>")
    y = htmltext._labels(p, True)
    assert [p.text[i] for i in range(len(y)) if y[i] and p.tag[i] == "#"] == ["T", "a", "b"]


def test_training_pages_are_drawn_from_those_with_an_article(spark, monkeypatch):
    rows = [(i, f"<body><p>cookie {i}</p></body>") for i in range(400)] + [(1000 + i, f"<body><MAIN><p>text {i}</p></MAIN></body>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    seen = []
    monkeypatch.setattr(htmltext, "fit", seen.append)
    htmltext.train(df, sample_pages=20)
    assert sorted(seen[0]) == sorted(h for i, h in rows if i >= 1000)
    htmltext.train(df.where("page_id < 1000"), sample_pages=20)  # the fallback: any pages
    assert len(seen[1]) == 20 and all("cookie" in h for h in seen[1])


def test_fallback_without_article_or_main():
    body = "<div class=text>" + "<p>Some words, and more of them. They go on.</p>" * 3 + "</div>"
    m = htmltext.fit([f"<body><nav><a>x</a></nav>{body}</body>"] * 20)
    assert m.trees is not None and m.texts([Page(f"<body>{body}</body>")])[0].count("Some words") == 3


def test_boosting_learns_interactions():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = fit(x[:1500], y[:1500], np.ones(1500))
    assert ((m.logit(x[1500:]) > 0) == y[1500:]).mean() > 0.95
    assert (fit(x, np.ones(2000), np.ones(2000)).logit(x) > 0).all()


def test_html_defined_cases(spark, model):
    schema = "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in CLASH)
    rest = [None] * len(CLASH)
    long = "<article>" + "<p>some words, and more of them.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, *rest), (2, None, "", *rest), (None, "u", "<nav><a>x</a></nav>", *rest), (4, "u", long, *rest), (4, "u", long, *rest),
            (5, "u", "<script>x</script>", *rest)]
    df = spark.createDataFrame(rows, schema)
    got = htmltext.extract(df, model).collect()
    assert len(got) == 6 and sorted((r.page_id or 0, r.n_chars > 0) for r in got) == [(0, False), (1, False), (2, False), (4, True), (4, True), (5, False)]
    assert next(r for r in got if r.page_id == 4).text.count("some words") == 20_000
    none = spark.createDataFrame([], schema)
    assert htmltext.extract(none, htmltext.train(none)).count() == 0
    assert {r.text for r in htmltext.extract(df.where("page_id < 4"), htmltext.train(none)).collect()} == {""}


# ---------------------------------------------------------------- URL filters
def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def run_filter(spark, captures, entries):
    c = spark.createDataFrame([(*x, "z") for x in captures], "page_id long, url string, fetched_at timestamp_ntz, kind string")
    e = spark.createDataFrame([(*x, "z") for x in entries], "kind string, pattern string, action string, effective timestamp_ntz, rank string")
    return urlfilter.evaluate(c, e).collect()


def test_as_of_decisions(spark):
    entries = [("domain", "bad.org", "block", day(10)), ("domain", "bad.org", "lift", day(20)), ("domain", "bad.org", "block", day(30)),
               ("host", "ok.bad.org", "allow", day(12)), ("prefix", "ok.bad.org/x/", "block", day(15)),
               ("url", "ok.bad.org/x/y?q=1", "allow", day(16)), ("host", "tie.org", "allow", day(1)), ("host", "tie.org", "block", day(1)),
               ("host", "odd.org", "mystery", day(1)), (None, "a.org", "block", day(1)), ("host", None, "block", day(1)), ("host", "n.org", "block", None)]
    cases = [("http://bad.org/", 9, False), ("http://bad.org/", 10, True), ("http://bad.org/", 19, True), ("http://bad.org/", 20, False),
             ("https://A.B.BAD.org:8080/p#f", 31, True), ("http://u:p@bad.org./", 31, True), ("http://notbad.org/", 31, False),
             ("http://ok.bad.org/z", 11, True), ("http://ok.bad.org/z", 13, False), ("http://ok.bad.org/x/y", 15, True),
             ("http://ok.bad.org/x", 15, False), ("http://ok.bad.org/x/y?q=1#top", 17, False), ("http://tie.org", 1, True),
             ("http://odd.org/", 5, False), ("http://n.org/", 5, False), ("not a url", 31, False), ("", 31, False)]
    got = run_filter(spark, [(i, u, day(d)) for i, (u, d, _) in enumerate(cases)], entries)
    assert {r.page_id: r.blocked for r in got} == {i: want for i, (_, _, want) in enumerate(cases)}
    assert next(r for r in got if r.page_id == 9).matched_pattern == "ok.bad.org/x/"


def test_url_defined_cases(spark):
    rows = [(1, None, day(1)), (2, "http://a.org/", None), (None, "http://a.org/", day(2)), (3, "http://a.org/", day(2)), (3, "http://a.org/", day(2)),
            (4, "http://a.org/" + "d/" * 500, day(2))]
    entries = [("host", "a.org", "block", day(1))]
    got = sorted(((r.page_id or 0, r.blocked) for r in run_filter(spark, rows, entries)))
    assert got == [(0, True), (1, False), (2, False), (3, True), (3, True), (4, True)]
    assert not any(r.blocked for r in run_filter(spark, rows, []))
    assert run_filter(spark, [], entries) == []


def test_url_query_is_native(spark):
    plan = queries.op3_url_filters(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_ends_of_elements_below_the_deepest_node_close_those_only():
    from opslog.llm import dom

    p = dom.Page("<div>" * 500 + "</div>" * 300 + "<article>x</article>")
    assert p.depth[p.tag.index("article")] == 201
    p = dom.Page("<div>" * 500 + "<p>a<p>b" + "</div>" * 500 + "<section>y")
    assert p.depth[p.tag.index("section")] == 1
    assert [t for t in p.text if t] == ["a", "b", "y"] or [t for t in p.text if t] == ["ab", "y"]


def test_very_long_pages_do_not_train(spark):
    from opslog.llm import htmltext

    small = ["<html><body><nav>menu here</nav><article><p>" + f"word {i} some text here " * 6 + "</p></article></body></html>" for i in range(30)]
    rows = [(i, t) for i, t in enumerate(small)] + [(100, "<article><p>" + "long " * 200_000 + "</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    src = pages.select(F.xxhash64("page_id").alias("h"), F.col("html").alias("t"))
    assert sorted(htmltext._draw(src, 100)) == sorted(small)


def test_very_long_urls_stay_linear(spark):
    import time

    url = "http://" + "a." * 2000 + "example.com/" + "/".join(["seg"] * 60_000) + "/x"
    captures = spark.createDataFrame([(1, url, "2024-02-01 00:00:00"), (2, "http://www.example.com/seg/seg/y", "2024-02-01 00:00:00")],
                                     "page_id long, url string, at string").withColumn("fetched_at", F.col("at").cast("timestamp_ntz"))
    entries = spark.createDataFrame([("prefix", "www.example.com/seg/", "block"), ("domain", "example.com", "allow")],
                                    "kind string, pattern string, action string").withColumn(
        "effective", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    t0 = time.time()
    got = {r.page_id: (r.blocked, r.matched_kind) for r in urlfilter.evaluate(captures, entries).collect()}
    assert got == {1: (False, "domain"), 2: (True, "prefix")} and time.time() - t0 < 60


HAND_PAGES = [  # layouts that the training generator does not draw
    ("""<body><table><tr><td class="navcol"><a href=/a>Home</a> <a href=/b>News</a></td><td class="content-main">
<h1>A quiet harbour town</h1><p>The ferry left at dawn and the town was still asleep when it came into the bay.</p>
<p>Nobody had expected so many visitors, and the only hotel on the square was full by noon.</p></td></tr></table>
<div id="footer">Copyright 2020 <a href=/imprint>Imprint</a></div></body>""",
     ["The ferry left at dawn and the town was still asleep when it came into the bay.",
      "Nobody had expected so many visitors, and the only hotel on the square was full by noon."], ["Imprint", "Home"]),
    ("""<body><header><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></header><main><article><p>First paragraph of the story, long
enough to be read as prose by any reader.<p>Second paragraph, which goes on about the same matter for a while longer.</article>
<section class="comments"><p>nice post!!</p></section></main><script>var x = "<p>no</p>"</script></body>""",
     ["Second paragraph, which goes on about the same matter for a while longer."], ["nice post", "var x", "One"]),
]


def test_hand_written_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = htmltext.train(pages)
    rows = [(i, "u", page) for i, (page, _, _) in enumerate(HAND_PAGES)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    for i, (_, inside, outside) in enumerate(HAND_PAGES):
        assert all(x in got[i] for x in inside), got[i]
        assert not any(x in got[i] for x in outside), got[i]
