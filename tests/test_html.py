"""Markdown of pages against what a reader would write."""

import pytest
from pyspark.sql import functions as F

from kgspark.functions.html import html_to_markdown, markdown_of

LONG = "Plain words that stand for the body of an article, again and again. " * 4
CASES = [
    ("<h2>A <i>b</i></h2><p>one<br>two &amp; three</p>", "## A *b*\n\none\ntwo & three\n"),
    ("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>", "- a\n- b\n  - c\n  - d\n- e\n"),
    ("<ol><li><p>a</p><p>b</p></li><li>c</li></ol>", "1. a\n\n   b\n2. c\n"),
    ('<p>see <a href="/x"> the page </a>, <a>bare</a> and <img src="i.png" alt="pic"></p>', "see [the page](/x) , bare and ![pic](i.png)\n"),
    ("<pre><code>if x:\n    y &lt; z</code></pre><p>use <code>f()</code></p>", "```\nif x:\n    y < z\n```\n\nuse `f()`\n"),
    ("<table><tr><th>k<th>v<tr><td>a|b<td>1<tr><td>c</table>", "| k | v |\n| --- | --- |\n| a\\|b | 1 |\n| c |  |\n"),
    ("<blockquote><p>a</p><p>b</p></blockquote><hr>c", "> a\n>\n> b\n\n---\n\nc\n"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\n\nfour\n"),
    ("<script>var t='</p>';</script><style>p{}</style><p>x</p><!-- c -->", "x\n"),
    ("<p>un<b>closed <i>tags", "un**closed *tags***\n"),
    ("", "\n"),
    (None, "\n"),
    ("just text", "just text\n"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_markdown(html, want):
    assert markdown_of(html) == want


def test_main_content():
    around = f'<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy {LONG}</div><div id="side-bar"></div>'
    page = f"<html><head><title>T</title></head><body>{around}<div><article><header><h1>Head</h1></header><p>{LONG}</p><div class='share'>tweet</div></article></div><footer>imprint {LONG}</footer></body></html>"
    assert markdown_of(page) == f"# Head\n\n{LONG.strip()}\n"
    links = "".join(f'<a href="/{i}">link number {i} with words</a> ' for i in range(60))
    assert markdown_of(f"<div><div>{links}</div><div><p>{LONG}</p></div></div>") == LONG.strip() + "\n"
    # under 200 characters the whole page counts
    assert markdown_of(f"<body><nav>menu</nav><article>short</article><footer>{LONG}</footer></body>") == f"menu\n\nshort\n\n{LONG.strip()}\n"


def test_deep_and_broken_pages():
    assert markdown_of("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep\n"
    assert markdown_of("<ul><li>" * 3000 + "x").strip().endswith("x")
    assert markdown_of("</p></div><li>stray</td>") == "stray\n"
    assert markdown_of("<p>a &nosuch; &#x41; <b") .startswith("a &nosuch; A")


def test_column(spark):
    rows = spark.createDataFrame([(h,) for h, _ in CASES], "html string").withColumn("md", html_to_markdown(F.col("html")))
    assert {r["html"]: r["md"] for r in rows.collect()} == dict(CASES)
