"""Page extraction: exact on the given pages and on pages with known articles."""

from __future__ import annotations

import html
import re

import duckdb
import pytest

from rollforge.llm import html_extract as hx
from rollforge.llm.html_scan import scan


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def plain(page):
    return hx.main_text(scan(page)[1], set(), None)


def test_given_pages_give_their_articles(spark, data):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{data}/pages.parquet'").fetchall()
    expected = {}
    for page_id, _, page in pages:
        inner = re.sub(r"</?b>", "", re.search("(?s)<article>(.*)</article>", page)[1])
        expected[page_id] = " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split())
    df = hx.extract(spark.read.parquet(f"{data}/pages.parquet"))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    assert texts(df) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in df.collect())


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("just text", "just text"), ("a < b &amp; c&nbsp;d &lt;p&gt; &#233;&#x41;", "a < b & c d <p> éA"),
    ("<p>one<p>two<br>three", "one two three"), ("<body><p>o<b>n</b>e <i>two</body>", "one two"),
    ("<article><h1>T</h1><p>x</p><aside>no</aside></article><p>out</p>", "T x"),
    ("<main><header><h1>T</h1></header><p>x<div class='comments'><p>no</div></main>", "T x"),
    ("<header>no</header><div id='cookie-notice'>no</div><div class=post><p>yes <a href=x>link</a></div><footer>no", "yes link"),
    ("<script>if (a < b) { '</p>' }</script><style>p>a{}</style><p>t</p><!-- <p>no</p> --><p hidden>no</p>", "t"),
    ("<article><p>a<form><input value='x > y'>no</form><p>b<button>no</button></article>", "a b"),
    ("<article><p title='1 > 0'>a</p><p class='unclosed>b</p>", "a b"), ("<p>cut <b", "cut"), ("<!-- open <p>x</p>", ""),
    ("<div><ul><li><a href=1>m</a><li><a href=2>n</a></ul></div><div><p>long text here</p></div>", "long text here"),
    ("<article>  \n a \t\n b  </article>", "a b"), ("<table><tr><td>x<td>y</table>", "x y"), ("<article><p>5 <3</article>", "5 <3"),
])
def test_single_pages(page, text):
    assert plain(page) == text


def page(i, body, label="Share this page"):
    return (
        f"<html><body><div class=top><div><a href=/>Home</a></div></div><div class=content><h2>Title {i}</h2>"
        f"<div class=by><span>Written by the staff of the paper</span></div><p>{body}</p><p>second {i} {'z ' * (i % 4)}</p>"
        f"<div class=x1><p>{label}</p></div></div><div class=end><p>All rights kept {i % 2}</p></div></body></html>"
    )


def test_constant_runs_of_a_host_are_template(spark):
    rows = [(i, f"http://Host.example/{i}", page(i, f"body text number {i} is here and long enough")) for i in range(14)]
    rows += [(100 + i, f"http://host.example/c{i}", page(3, "body text number 3 is here and long enough")) for i in range(40)]
    rows += [(200, "http://other.example/1", page(200, "one page alone on its host, with a body"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = texts(hx.extract(df))
    for i in range(14):
        assert found[i] == f"Title {i} body text number {i} is here and long enough second {i}" + " z" * (i % 4)
    # copies keep their text, though most pages of the host have it
    assert found[120] == found[3]
    # no template without other pages: the same rows stay
    assert found[200].endswith("Share this page") and "All rights" not in found[200]


def test_a_line_of_many_articles_is_no_template(spark):
    rows = [
        (i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><p>The same line everywhere.</p>{'<p>x</p>' * (i % 3)}<p>own {i}</p></article>")
        for i in range(30) if i % 3 == 0
    ] + [(i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><p>own {i}</p></article>") for i in range(30) if i % 3]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("The same line everywhere." in t for i, t in texts(hx.extract(df)).items() if i % 3 == 0)


def test_classes_are_nested(spark):
    rows = [
        (i, "http://h.example/", "<body><div class=menu><ul>" + "<li><a>m</a></li>" * (i % 5 + 1) + "</ul></div>"
         f"<div class=main><h1>t{i}</h1><p>text {i}</p></div></body>") for i in range(20)
    ]
    df = spark.createDataFrame(rows, "page_id long, host string, html string")
    from pyspark.sql import functions as F

    from rollforge.plans.storage import materialize

    scanned = materialize(hx.page_tokens(df).withColumn("row", F.monotonically_increasing_id()), "scanned")
    found = {tuple(r["tokens"]): r for r in hx.templates(scanned, min_tokens=1).collect()}
    skeleton = max(found.values(), key=lambda r: len(r["tokens"]))
    assert skeleton["parent"] == hx.ROOT and len(skeleton["tokens"]) == 6  # body, two div, ul, h1, p
    inside = [r for r in found.values() if r["parent"] == skeleton["class"]]
    assert len(inside) == 1 and len(inside[0]["tokens"]) == 2  # li and its text, in the gap behind ul
    assert inside[0]["gap"] == 3


@pytest.mark.parametrize(("tokens", "valid"), [
    ([1, 2, 9, 1, 2], {0: True}), ([2, 1, 2, 1], {0: True}), ([1, 1, 2, 2], {0: False}), ([1, 5, 2, 6], {1: False}),
    ([1, 5, 6, 2], {0: True, 1: True}), ([1, 5, 6, 2, 5, 6], {0: True, 1: False}), ([], {}),
])
def test_order_and_nesting(tokens, valid):
    found = hx.arrangement(tokens, [[1, 2], [5, 6]])
    assert {c: found[c][0] for c in valid} == valid


def test_awkward_rows(spark):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (2, "", "", "x"), (None, "no host", "<p>a", "x"), (3, "http://h", "<p>" + "w " * 3_000_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(hx.extract(df).collect(), key=repr)
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 5_999_999)]
    assert hx.extract(df.where("false")).count() == 0
