import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import html_extract
from metaloom.llm.html_extract import Tree, blocks, labelled_table, main_blocks
from tests.llm import awkward

TREE = Tree(*labelled_table())
PROSE = "The river rose in the night and by the morning it had covered the lower fields of the whole valley."


def text_of(page):
    return "\n".join(b[0] for b in main_blocks(page, TREE) if b[1])


def test_tree_learns_its_table():
    x, y = labelled_table()
    assert (TREE.predict(x) == y).all() and len(y) < 200


def test_tree_splits_where_impurity_falls_most():
    x = np.array([[0.0, 5], [1, 4], [2, 9], [3, 1]])
    tree = Tree(x, np.array([0, 0, 1, 1]))
    assert (tree.feature, tree.cut) == (0, 1.5) and tree.predict(np.array([[1.4, 0], [1.6, 0]])).tolist() == [False, True]


@pytest.mark.parametrize("page, text", [
    (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{PROSE}<p>{PROSE}</article><footer>&copy; x</footer>", f"Title\n{PROSE}\n{PROSE}"),
    (f"<article><p>a&amp;b &eacute;&#233; &lt;i&gt;\n\t x&nbsp; y <b>bo</b>ld<br>next</p>{PROSE}</article>", f"a&b éé <i> x y bold next\n{PROSE}"),
    (f"<body><!-- <p>no</p> --><script>var t='</p><p>no';</script><style>p{{}}</style><article><p>{PROSE}</p><p>Short.</p></article>", f"{PROSE}\nShort."),
    (f"<article><p>{PROSE}</p><aside><p>{PROSE}</p></aside><div class='newsletter-box'><form><label>Mail</label></form></div><p>End.</p></article>", f"{PROSE}\nEnd."),
    (f"<main><p>{PROSE}</p></main><section id=comments><p>{PROSE} {PROSE}</p></section>", PROSE),
    (f"<div class='cookie-notice'>{PROSE}</div><div><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p></div><div class=sidebar>{PROSE}</div>", f"Head\n{PROSE}\n{PROSE}"),
    (f"<div><a href=1>One</a></div><div><a href=2>Two</a></div><div>{PROSE}</div>", PROSE),
    (f"<article>{PROSE}<p hidden>{PROSE}</p><div style='display: none'>x</div></article>", PROSE),
    (f"<ARTICLE><P TITLE='a>b'>{PROSE}</P></ARTICLE>", PROSE), (f"<article><p>1 < 2 and 3 > 2, {PROSE}", f"1 < 2 and 3 > 2, {PROSE}"),
    (f'<article><p title="x>{PROSE}</p>', PROSE), ("", ""), (None, ""), ("<html><head><title>x</title></head></html>", ""), ("<nav>only", ""),
])
def test_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("start", [
    "<head><title>x</title><meta charset=utf-8><body>", "<head class=header><title>x</title>", "<noscript><img src=x>", "<object data=x><param name=y>",
    "<svg><g><path d=x>", "<select><option>One<option>Two", "<iframe src=x>", "<template>", "<math>", "<div><noscript>no</div>", "<noscript>a<noscript>b</noscript>"])
def test_elements_without_an_end_tag_cut_nothing(start):
    page = f"{start}<article><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></article>"
    assert text_of(page) == f"Title\n{PROSE}\n{PROSE}"


LONG = " ".join([PROSE] * 3)


@pytest.mark.parametrize("page, text", [
    (f"<div class='content has-sidebar'><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div>", f"Title\n{LONG}\n{LONG}"),
    (f"<article class='post no-comments'><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    (f"<form id=aspnetForm><div class=menu><a href=1>Home</a></div><article><h1>Title</h1><p>{LONG}</p></article></form>", f"Title\n{LONG}"),
    (f"<div class=page-with-search><div id=sidebar-left><p>{PROSE}</p></div><main><p>{LONG}</p></main></div>", LONG),
    (f"<div class='layout sidebar'><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><div class=sidebar><p>{PROSE}</p></div></div>", f"Title\n{LONG}\n{LONG}"),
    (f"<article><p>{PROSE}</p></article><section id=comments><p>{LONG}</p><p>{LONG}</p><article class=comment><p>{LONG}</p></article></section>", PROSE),
    (f"<article><p>Click <span class=menu>File</span> and then <b class='search'>Find</b> or <i class=ad>more</i>, {PROSE}</p></article>", f"Click File and then Find or more, {PROSE}"),
    (f"<nav><h1>Site</h1><p>{LONG}</p></nav><p>{PROSE}</p>", PROSE),
])
def test_names_name_parts_and_not_pages(page, text):
    assert text_of(page) == text


def test_the_tree_decides_beside_the_names():
    """On pages that it was not trained on: its answer is not just \"in the article and not named\"."""
    links = "".join(f"<li><a href={i}>Other story number {i}</a></li>" for i in range(5))
    page = f"<article><h1>Title</h1><p>{LONG}</p><p>{PROSE} <a href=x>{PROSE}</a></p><p>{LONG}</p><ul>{links}</ul></article>"
    assert text_of(page) == f"Title\n{LONG}\n{PROSE} {PROSE}\n{LONG}"
    assert all(b.inside and not b.named for b in blocks(page))
    plain = f"<div><a href=1>Home page</a></div><div><a href=2>All news</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=3>Terms</a></div>"
    assert text_of(plain) == f"{LONG}\n{LONG}" and not any(b.inside or b.named for b in blocks(plain))


def test_deep_names_are_read_in_one_pass():
    page = "<div class=menu>" * 30_000 + f"<article><h1>T</h1><p>{PROSE}</p></article>"
    assert text_of(page) == f"T\n{PROSE}"


def test_skipped_elements_may_be_nested():
    assert text_of(f"<article><p>{PROSE}</p><object>a<object>b</object>c</object><svg/><svg title='a>b'><text>x</text></svg><p>{PROSE}</p></article>") == f"{PROSE}\n{PROSE}"
    assert text_of("<noscript>" * 50_000 + f"<p>{PROSE}</p>") == PROSE


def test_neighbours_and_links_are_measured():
    found = blocks("<p>one <a href=x>two three</a></p><p>four</p>")
    x = html_extract.features(found)
    assert x[0, :6].tolist() == [3, 2 / 3, 0, 0, 1, 0] and x[1, :6].tolist() == [1, 0, 3, 2 / 3, 0, 0]


def test_articles_of_the_table_are_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        parts = [re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))
        assert got[r.page_id] == (text, len(text))


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, None), (3, "u", f"<p>{PROSE}"), (3, "u", f"<p>{PROSE}"), (4, "u", "<div>" * 20_000 + "x"), (5, "u", f"<article><p>{PROSE * 3000}</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").select("*", *[F.lit(1).alias(c) for c in ("HTML", "text", "c0", "n_chars", "blocks")])
    got = html_extract.extract(pages, all_blocks=True).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (2, 0), (3, len(PROSE)), (3, len(PROSE)), (4, 1), (5, len(PROSE) * 3000)]
    assert [b.main for r in got for b in r.blocks if r.page_id == 3] == [True, True]
    assert html_extract.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
