from __future__ import annotations

import html
import re

import numpy as np
import pytest

from postlens.llm import html_text, queries
from tests.conftest import TESTDATA

SCHEMA = "page_id bigint, url string, html string, text string, n_chars int"
LONG = "The harbour lay quiet under a grey and heavy sky, and two boats came in before noon that day. "


def text_of(page):
    return " ".join(html_text.main_blocks(page))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain  words\nonly", "plain words only"),
        ("<nav><a href='/'>Home</a></nav><script>var t='<p>no</p>';</script>", ""),
        ("<p>one&amp;two &eacute; &#8364; &lt;b&gt; a&nbsp;b</p>", "one&two é € <b> a b"),
        ("<article><p>in<b>side</b> one\n\tblock</p><p>two</p></article>", "inside one block two"),
        ("<article>a<br>b<hr>c</article>", "a b c"),
        ("<body><div class='ad'>Buy now</div><article><h1>T</h1><p><b>x<br><p>y</article><footer>f", "T x y"),
        (f"<div id=top-menu>{LONG}</div><div><p>{LONG}</p><p>Ah.</p></div>", f"{LONG}Ah."),
        (f"<main><header><h1>Title</h1></header><p>{LONG}</p></main><header>{LONG}</header>", f"Title {LONG.strip()}"),
        (f"<article><p>{LONG}</p><form>Mail <input> <button>Go</button></form><p>End.</p></article>", f"{LONG}End."),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p></section></article>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><div role=alert>{LONG}</div><aside>{LONG}</aside>", LONG.strip()),
        ("<p>never <b>closed", "never closed"), ("<p>a < b and <3</p>", "a < b and <3"),
        ("<!-- <p>no</p> --><p>yes</p><style>p{}</style>", "yes"),
    ],
)
def test_pages(page, text):
    assert text_of(page) == text


def test_link_lists_without_marks_are_no_content():
    links = "".join(f"<li><a href='/{i}'>topic {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div>" + f"<p>{LONG}</p>" * 6 + f"</div><div><ul>{links}</ul></div>"
    assert text_of(page) == " ".join([LONG.strip()] * 6)


def test_smoothing_keeps_a_constant_and_is_symmetric():
    assert np.allclose(html_text.smoothed(np.full(7, 3.0)), 3)
    peak = html_text.smoothed(np.array([0, 0, 0, 1.0, 0, 0, 0]))
    assert np.allclose(peak, peak[::-1]) and peak.argmax() == 3


def test_a_long_page_is_whole():
    page = "<article>" + "".join(f"<p>paragraph {i} {LONG}</p>" for i in range(5000)) + "</article>"
    assert text_of(page) == " ".join(f"paragraph {i} {LONG.strip()}" for i in range(5000))


def test_query_gives_the_articles(spark):
    folder = str(TESTDATA / "sf0.01")
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.html_text(spark, folder).collect()}
    assert len(got) == len(pages)
    for page in pages:
        body = page["html"].split("<article>")[1].split("</article>")[0]
        body = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br|li|ul)>", " ", body))
        expected = " ".join(html.unescape(body).split())
        row = got[page["page_id"]]
        assert (row["url"], row["text"], row["n_chars"]) == (page["url"], expected, len(expected))


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, None), (None, "u", "<p>a</p>"), (2, "u", "<p>é🙂</p>"), (2, "u", "<p>é🙂</p>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, html_text.page_texts(pages).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (None, "u", "a", 1), (2, "u", "é🙂", 2), (2, "u", "é🙂", 2)], key=repr)
    assert html_text.page_texts(pages.limit(0)).collect() == []
