from __future__ import annotations

import html as references
import re
from itertools import product

from sluicemark.llm import pages

TREE = pages.grow(*pages.labelled_blocks())
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies for everything we do</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph
with <a href="/q">a link</a>, a&nbsp;reference &#233; and 1 < 2.<br>Same block<!-- not <p>this</p> -->.</p><p>De.</p>
<div class='ad'>Buy now and save a lot of money today</div><p title="a > b">Tail<section class="comments"><p>Great article, I liked to read it a lot</p></section>
</article><aside><p>Related things of interest to readers of this page</p></aside><form><label>Name</label><textarea>typed</textarea></form><footer>&copy; x</footer>"""


def test_article_only():
    assert pages.main_text(PAGE, TREE) == "Title & more\nFirst paragraph with a link, a reference é and 1 < 2. Same block.\nDe.\nTail"


def test_labelled_blocks_are_learned():
    x, y = pages.labelled_blocks()
    found = [pages.decide(TREE, row) for row in x.tolist()]
    assert sum(a == bool(b) for a, b in zip(found, y, strict=True)) >= 0.97 * len(y)


def test_article_blocks_of_every_shape_are_kept():
    for w, d, pw, pd, nw, nd, h, i in product((1, 3, 20, 200), (0, 0.3, 0.5, 1), (0, 1, 30), (0, 0.4, 1), (0, 1, 30), (0, 0.3, 0.8, 1), (0, 1), (0, 1)):
        assert pages.decide(TREE, [w, d, pw, pd, nw, nd, 1, 0, h, i])
        assert not pages.decide(TREE, [w, d, pw, pd, nw, nd, 1, 1, h, i])


PARAGRAPHS = ["".join(f"{word} " for word in [f"p{i}w{j}" for j in range(60)]).strip() for i in range(4)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


def test_hints_on_a_layout_do_not_hide_its_article():
    for names in ("page", "page has-sidebar", "content no-comments", "site with-header", "post tags-travel", "layout-sidebar", "wrap sidebar"):
        page = f'<body><div class="{names}"><nav><a href=x>Home</a></nav><article>{BODY}</article><div class="sidebar"><p>Other things to read on this site today</p></div></div>'
        assert pages.main_text(page, TREE) == "\n".join(PARAGRAPHS), names


# Labelled pages of other layouts: the html with the wanted blocks in <w> marks.
LAYOUTS = {
    "plain divs": f"<div><a href=a>Home</a> <a href=b>News</a></div><div><w><h1>A title of some words here</h1></w><w><p>Six words open this story well.</p></w>"
    f"<w><p>{PARAGRAPHS[0]}</p></w><w><p>{PARAGRAPHS[1]}</p></w></div><div><a href=c>Imprint</a> <a href=d>Contact us</a></div>",
    "main with aside": f"<header class=site-header><p>The daily paper of the town</p></header><main><w><h1>Title of it</h1></w><w><p>{PARAGRAPHS[0]}</p></w><w><p>Short one.</p></w>"
    f"<aside><p>Read this as well, it is good</p></aside><w><p>{PARAGRAPHS[2]}</p></w></main><footer><p>All rights are reserved by us</p></footer>",
    "comments longer than the article": f"<div class='post single'><w><h1>On the matter of it</h1></w><w><p>{PARAGRAPHS[0]}</p></w></div><div id=comments>" + f"<p>{PARAGRAPHS[1]}</p><p>{PARAGRAPHS[2]}</p><p>{PARAGRAPHS[3]}</p></div>",
    "table layout": f"<table><tr><td class=menu><a href=a>One</a><td><w><p>{PARAGRAPHS[0]}</p></w><w><p>{PARAGRAPHS[1]}</p></w><td class=ads><p>Buy this now and save a lot</p></table>",
    "article with parts": f"<article><header><w><h1>Title</h1></w></header><w><p>{PARAGRAPHS[0]}</p></w><div class=advert><p>Only today: half price on all of it</p></div><w><blockquote>As was said before</blockquote></w>"
    f"<w><p>{PARAGRAPHS[1]}</p></w><section class=related><ul><li><a href=z>Another story of the day</a></ul></section></article>",
    "list article": "<nav><ul><li><a href=a>Home</a></ul></nav><main><w><h1>Ten things</h1></w>" + "".join(f"<ul><li><w>{p}</w></li></ul>" for p in PARAGRAPHS) + "</main><div class=newsletter><p>Subscribe to our letter for more of this</p></div>",
    "sidebar layout class": f"<div class=layout-sidebar><div class=content><w><h1>A story</h1></w><w><p>{PARAGRAPHS[0]}</p></w><w><p>{PARAGRAPHS[3]}</p></w></div><div class=sidebar><p>Popular now: this and that</p></div></div>",
}


def test_labelled_pages_of_other_layouts():
    for name, page in LAYOUTS.items():
        wanted = [" ".join(re.sub(r"<[^>]*>", " ", w).split()) for w in re.findall(r"<w>(.*?)</w>", page)]
        assert pages.main_text(re.sub(r"</?w>", "", page), TREE).split("\n") == wanted, name


def test_whole_table_equals_the_article_element(prepared):
    table = prepared.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in pages.extract(table).collect()}
    for r in table.collect():
        end = r.html.find("</article>")
        body = r.html[r.html.find("<article>") + 9 : end if end >= 0 else len(r.html)]
        blocks = [" ".join(references.unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"<(?:/?p|/?h1|br)>", body)]
        assert found[r.page_id].text == "\n".join(b for b in blocks if b)
        assert found[r.page_id].n_chars == len(found[r.page_id].text) and found[r.page_id].url == r.url


def test_edge_cases(prepared):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>" + "word " * 30), (4, "u", "<article><p>cut <b"), (5, "u", "<article><p>x<script>never closed"),
        (6, "u", "<!-- never closed <article><p>x"), (7, "u", "<article><p>&am"), (8, "u", "<" * 20_000), (9, "u", "<article><p>" + "long " * 100_000),
        (10, "u", "<a href='" * 5_000), (11, "u", "<div>" * 20_000 + "</article>" * 100), (1, "u", None),
    ]
    table = prepared.createDataFrame([(*r, "text", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = pages.extract(table).collect()
    by = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and by[1] == by[2] == by[6] == "" and by[4] == "cut" and by[5] == "x" and by[7] == "&am"
    assert by[None].count("word") == 30 and by[9].count("long") == 100_000
    assert pages.extract(table.limit(0)).count() == 0
