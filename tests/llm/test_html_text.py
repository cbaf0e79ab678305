"""HTML extraction: pages of many layouts, densities against a recursive version, awkward rows."""

import html
import math
import re

import duckdb
import pytest

from bazaar.llm.html_text import BLOCKS, Page, densities, main_text

P1 = "The first paragraph of the story is long enough to be told from a menu, with a full sentence or two in it."
P2 = "A second paragraph follows it, and it goes on about the matter in some more words than a caption would need."
P3 = "The third one closes the story; nobody would take so many words for an advert or for a line of a footer."
STORY = f"<p>{P1}</p><p>{P2}</p><p>Short.</p><p>{P3}</p>"
WANT = "\n\n".join(["Title", P1, P2, "Short.", P3])
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8)) + "</ul>"

LAYOUTS = {
    "article": f"<nav>{MENU}</nav><article><h1>Title</h1>{STORY}</article><footer>&copy; us &middot; all rights</footer>",
    "headers": f"<header><h1>Site</h1>{MENU}</header><article><header><h1>Title</h1></header>{STORY}</article>",
    "main": f'<div class="topbar">Hello you</div><main><h1>Title</h1>{STORY}</main><aside>{P1}</aside>',
    "plain divs": f'<div id="top">Site name</div><div id="wrap"><div>{MENU}</div><div><h1>Title</h1>{STORY}</div></div><div>Small print.</div>',
    "sections": f"<div>{MENU}</div><div><h1>Title</h1><section><p>{P1}</p><p>{P2}</p><p>Short.</p></section><section><p>{P3}</p></section></div>",
    "body only": f"<h1>Title</h1>{STORY}",
    "notices": f'<div class="cookie-notice"><p>{P1} {P2} {P3}</p></div><div role="dialog">{P2}</div><article><h1>Title</h1>{STORY}</article>',
    "inside": f'<article><h1>Title</h1><p>{P1}</p><div class="ad">{P2}</div><p>{P2}</p><form><label>Name</label><input></form>'
              f'<p>Short.</p><aside>{P1}</aside><p>{P3}</p><ul><li><a>Next</a></li><li><a>Last</a></li><li><a>Top</a></li></ul></article>',
    "comments": f'<article><h1>Title</h1>{STORY}<section id="comments"><h2>Replies</h2><article class="comment"><p>{P1}</p><p>{P2}</p>'
                f'<p>{P3} {P3} {P3}</p></article></section></article><ol class="commentList"><li>{P1}</li><li>{P2}</li></ol>',
    "wrapping form": f'<form id="aspnet"><nav>{MENU}</nav><div><h1>Title</h1>{STORY}</div></form>',
    "noisy wrapper": f'<div class="page has-sidebar"><div class="sidebar">{P1}</div><article><h1>Title</h1>{STORY}</article></div>',
    "hidden": f'<article><h1>Title</h1><p style="display: none">{P1}</p><p hidden>{P2}</p><div aria-hidden="true">x</div>{STORY}</article>',
    "unclosed": f"<nav>{MENU}</nav><article><h1>Title</h1><p><b>{P1}<br><p>{P2}<p>Short.<p><i>{P3}</article><footer>end",
    "scripts": f"<script>var t='</p><article>no</article>';</script><style>p{{}}</style><!-- <p>no</p> --><article><h1>Title</h1>"
               f"<noscript>{P1}</noscript>{STORY}<textarea><p>no</textarea></article><script>never closed <p>{P1}</p>",
    "attributes": f'<nav title="a > b">{MENU}</nav><article data-x=\'</article>\' data-y=it\'s><h1>Title</h1>{STORY}</article>',
    "white space": "<article><h1>\n Title\t</h1>" + STORY.replace(" ", " \n&nbsp; ", 40) + "</article>",
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts(name):
    for page in (LAYOUTS[name], f"<!DOCTYPE html><html><head><title>T</title></head><body>{LAYOUTS[name]}</body></html>"):
        assert main_text(page) == WANT


def test_text_rules():
    page = ("<article><h1>A &amp; B &amp</h1><p>1 &lt; 2, &#233;&eacute;&#x1F600; a<b>b</b>c &am 5 < 6</p><div>loose text<p>in p</p>after</div>"
            "<ul><li>one<li>two</ul><table><tr><td>x</td><td> y</td></tr><tr><td>z</table><pre>a\n  b</pre><p> &nbsp; </p><p>line<br>break</article>")
    assert main_text(page).split("\n\n") == [
        "A & B &", "1 < 2, éé😀 abc &am 5 < 6", "loose text", "in p", "after", "one", "two", "x y", "z", "a b", "line break"]


def test_awkward_pages():
    for page in (None, "", "  ", "<", "<<<", "<p", "</", "<!--", "<!-->", "<a href='", "<nav>only a menu</nav>", "<script>x", "<br><br>", "&"):
        assert main_text(page) in ("", "<", "<<<", "</", "&")
    assert main_text("just text, no tags") == "just text, no tags"
    deep = "<div>" * 20000 + "<p>" + P1 + "</p>"
    assert main_text(deep) == P1
    for bad in ("<a \"", "<a b='", "<!--", "<p class=", "</a", "&", "< "):
        assert isinstance(main_text("<article><p>x</p>" + bad * 20000), str)


def recursive(page):
    """Density and sum of every node, from the definition."""
    kids = {n: [c for c, p in enumerate(page.parent) if p == n and page.kept[c]] for n in range(len(page.name))}

    def size(text):
        return len(text.replace(" ", ""))

    def below(n):
        return [n] + [x for c in kids[n] for x in below(c)]

    def text(n):
        return sum(size(t) for t, m in page.runs if t and m in set(below(n)))

    def linked(n):
        return [x for x in below(n) if page.name[x] == "a" and not any(page.name[y] == "a" and x in below(y)[1:] for y in below(n))]

    all_links = sum(size(t) for t, m in page.runs if t and _in_link(page, m))
    whole = sum(size(t) for t, m in page.runs if t)
    r = all_links / whole if whole else 0

    def ctd(c, t, lc, lt):
        if not c:
            return 0.0
        if not r:
            return c / max(t, 1)
        base = math.log(math.log(c * lc / max(c - lc, 1) + r * c + math.e))
        return c / max(t, 1) * max(0.0, math.log(max(1.0, c / max(lc, 1) * max(t, 1) / max(lt, 1)))) / max(base, 1e-3)

    value = {}
    for n in range(len(page.name)):
        inner = [x for a in linked(n) for x in below(a)]
        value[n] = ctd(text(n), len(below(n)) - 1, sum(text(a) for a in linked(n)), len(inner) if page.name[n] != "a" else len(inner))
    total = {}
    for n in range(len(page.name)):
        if page.name[n] in BLOCKS and page.kept[n]:
            near, own, todo = [], 0, [n]
            while todo:
                at = todo.pop()
                own += sum(size(t) for t, m in page.runs if t and m == at)
                for c in kids[at]:
                    if page.name[c] in BLOCKS:
                        near.append(value[c])
                    else:
                        near.append(0.0)
                        todo.append(c)
            total[n] = sum(near) + (ctd(own, 1, 0, 0) if own else 0.0)
    return value, total


def _in_link(page, n):
    while n > 0:
        if page.name[n] == "a":
            return True
        n = page.parent[n]
    return False


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_densities_equal_the_definition(name):
    page = Page(LAYOUTS[name])
    value, total, *_ = densities(page)
    want_value, want_total = recursive(page)
    for n in range(len(page.name)):
        if page.kept[n] and page.name[n] in BLOCKS:
            assert value[n] == pytest.approx(want_value[n])
            assert total[n] == pytest.approx(want_total[n])


def wanted(page):
    body = re.sub("</?b>|<br>", " ", re.search("<article>(.*?)</article>", page, re.S)[1])
    parts = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


def test_pages_table(spark):
    from bazaar.llm.queries import queries
    sf = "/root/testdata/sf0.01"
    rows = duckdb.connect().execute(f"select page_id, url, html from '{sf}/pages.parquet'").fetchall()
    got = queries()["op11_html_text"](spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(i, u, wanted(h), len(wanted(h))) for i, u, h in rows]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_awkward_rows(spark):
    from bazaar.llm.html_text import extract
    cols = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (None, "u", "", "x", "y"), (2, "v", LAYOUTS["article"], "x", "y"), (2, "v", LAYOUTS["article"], "x", "y"),
            (3, "w", "<article><p>😀é</p></article>", None, None)]
    got = sorted((tuple(r) for r in extract(spark.createDataFrame(rows, cols)).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (None, "u", "", 0), (2, "v", WANT, len(WANT)), (2, "v", WANT, len(WANT)), (3, "w", "😀é", 2)], key=str)
    assert extract(spark.createDataFrame([], cols)).collect() == []
