"""Main-text extraction by composite text density.

Pages are parsed into a DOM, elements that are never article text (menus, forms, adverts,
comments and so on, by element name, role, class or id) are cut out, and every remaining node
gets its link-adjusted characters per tag. The node with the largest sum of child densities is
the core; the smallest density on its path to the body is the threshold that other parts
must reach to belong to the article with it. The article's blocks are then joined whole.

Parsing one page is a small helper of a few passes over arrays; Spark deals the pages.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import with_defaults

# --- fixed values: element names and words of class and id attributes ---------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())     # text without markup, never article text
CUT = frozenset("script style title textarea xmp iframe noembed noframes noscript template head svg math object canvas "
                "audio video map nav aside footer form button select datalist dialog menu menuitem".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
BLOCKS = frozenset("address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p "
                   "plaintext pre search section summary table tbody tfoot thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of class and id attributes whose elements are cut; a word is a run of letters, camelCase split.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead topbar toolbar pagination pager "
    "discussion "
    "cookie cookies consent gdpr notice notices banner popup modal overlay alert newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget widgets copyright legal disclaimer skip".split())
#: Words of class and id attributes of what readers wrote.
REPLIES = frozenset("comment comments commentlist commentary disqus respond replies reply".split())
#: Elements that open a new paragraph context: an open p ends before them.
_ENDS_P = BLOCKS - {"caption", "tbody", "thead", "tfoot", "tr", "body", "html"}
#: Opening the key ends an open element of the value, up to the nearest holder.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
         "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
         "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"                                          # comment
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"                                # doctype, bogus comment
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?|[^>=]++)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s/>"'=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


def _noise_of(name: str, attrs: str) -> int:
    """0: may be article text; 1: never; 2: not, unless it turns out to wrap the article."""
    if name in CUT:
        return 2 if name == "form" else 1
    if "=" not in attrs and "hidden" not in attrs.lower():
        return 0
    out = 0
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
            return 1
        words = {w.lower() for w in _WORD.findall(value)} if key in ("class", "id") else ()
        if words and not REPLIES.isdisjoint(words):
            return 1
        if (key == "role" and value.lower() in ROLES) or (words and not NOISE.isdisjoint(words)):
            out = 2
    return out


class Page:
    """The DOM of a page as parallel lists, parents before children; node 0 is the body.

    ``runs`` are (text, node) in page order, None for a block boundary. ``kept`` tells which
    nodes are outside everything that is cut.
    """

    def __init__(self, source: str) -> None:
        self.name, self.parent, self.noise = ["body"], [-1], [0]
        self.runs: list[tuple[str | None, int]] = []
        self._parse(source)
        self.chars = self.text_sizes(self.runs)
        self.kept = self._kept()

    def _parse(self, source: str) -> None:
        open_ = [0]
        at, end = 0, len(source)
        while at < end:
            tag, token = source.find("<", at), None
            while tag >= 0 and not (token := _TOKEN.match(source, tag)):
                tag = source.find("<", tag + 1)
            text = source[at:tag if tag >= 0 else end]
            if text:
                self.runs.append((html.unescape(text), open_[-1]))
            if tag < 0:
                break
            at = token.end()
            name = (token["name"] or "").lower()
            if name in ("", "html", "head", "body"):
                continue
            if token["end"]:
                self._close(open_, name)
                continue
            if name in RAW:
                at = self._after_raw(source, at, name)
                if name in ("script", "style", "title"):
                    continue
            if name in BLOCKS:
                self.runs.append((None, 0))
                self._imply_ends(open_, name)
            self.name.append(name)
            self.parent.append(open_[-1])
            self.noise.append(_noise_of(name, token["attrs"]))
            if name == "br":
                self.runs.append((" ", open_[-1]))
            if name not in VOID and name not in RAW:
                open_.append(len(self.name) - 1)

    def _close(self, open_: list[int], name: str) -> None:
        for depth in range(len(open_) - 1, 0, -1):
            there = self.name[open_[depth]]
            if there == name:
                del open_[depth:]
                break
            if name not in BLOCKS and there in BLOCKS:      # an inline end tag does not reach over a block
                return
        if name in BLOCKS:
            self.runs.append((None, 0))

    def _imply_ends(self, open_: list[int], name: str) -> None:
        """Ends an open p before a block, and an open list item, row or cell before the next one."""
        same, holders = _ENDS.get(name, (frozenset(), frozenset()))
        for depth in range(len(open_) - 1, 0, -1):
            there = self.name[open_[depth]]
            if there in same or (there == "p" and name in _ENDS_P):
                del open_[depth:]
            elif there in holders or (there in BLOCKS and not same):
                break

    @staticmethod
    def _after_raw(source: str, at: int, name: str) -> int:
        found = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
        return found.end() if found else len(source)

    def text_sizes(self, runs: list) -> list[int]:
        """Characters other than blanks below every node."""
        out = [0] * len(self.name)
        for text, node in runs:
            if text:
                out[node] += len(text) - text.count(" ")
        for n in range(len(out) - 1, 0, -1):
            out[self.parent[n]] += out[n]
        return out

    def _kept(self) -> list[bool]:
        size = len(self.name)
        holds = [False] * size          # an article or main element that is not cut itself
        for n in range(size - 1, 0, -1):
            holds[n] |= self.name[n] in ("article", "main") and self.noise[n] != 1
            holds[self.parent[n]] |= holds[n]
        kept, inside = [True] * size, [False] * size
        for n in range(1, size):
            up = self.parent[n]
            inside[n] = inside[up] or self.name[n] in ("article", "main")
            noise = self.noise[n] or (1 if self.name[n] == "header" and not inside[up] else 0)
            if noise == 2 and (holds[n] or 2 * self.chars[n] > self.chars[0]):
                noise = 0
            kept[n] = kept[up] and noise != 1 and noise != 2
        return kept


def densities(page: Page) -> tuple[list[float], list[float], list[int], list[int]]:
    """(composite density, sum of child densities, characters, link characters) of every node.

    Of a node with C characters and T tags, of them LC and LT in links, in a body with the link
    share r: C / T * log(C / LC * T / LT) to the base ln(C * LC / (C - LC) + r * C + e), where a
    divisor of 0 counts as 1. Without a link in the body it is C / T. Text directly in a block is a
    child of its own, so a paragraph's sum is that of its text.
    """
    size = len(page.name)
    tags, link_chars, link_tags, own = ([0] * size for _ in range(4))
    runs = [(text, n) for text, n in page.runs if text and page.kept[n]]
    chars = page.text_sizes(runs)
    for text, node in runs:
        while node and page.name[node] not in BLOCKS:
            node = page.parent[node]
        own[node] += len(text) - text.count(" ")
    for n in range(size - 1, 0, -1):
        if page.kept[n]:
            if page.name[n] == "a":
                link_chars[n], link_tags[n] = chars[n], tags[n] + 1
            up = page.parent[n]
            tags[up] += tags[n] + 1
            link_chars[up] += link_chars[n]
            link_tags[up] += link_tags[n]
    linked = sum(c for n, c in enumerate(page.chars) if page.name[n] == "a")
    share = linked / page.chars[0] if page.chars[0] else 0.0

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        plain = c / max(t, 1)
        if not share:
            return plain
        base = math.log(math.log(c / max(c - lc, 1) * lc + share * c + math.e))
        inside = c / max(lc, 1) * max(t, 1) / max(lt, 1)
        return plain * max(0.0, math.log(max(inside, 1.0))) / max(base, 1e-3)

    value = [density(*x) for x in zip(chars, tags, link_chars, link_tags)]
    total = [0.0] * size
    for n in range(size - 1, -1, -1):
        if page.name[n] in BLOCKS:
            if own[n]:
                total[n] += density(own[n], 1, 0, 0)
            if n:
                up = page.parent[n]
                while up and page.name[up] not in BLOCKS:
                    up = page.parent[up]
                total[up] += value[n]
    return value, total, chars, link_chars


def main_node(page: Page) -> int:
    """The node whose text is the article: the nearest article or else main element around the core;
    without one, the core, and its parents as long as what they add belongs to it."""
    value, total, chars, _ = densities(page)
    blocks = [n for n, name in enumerate(page.name) if name in BLOCKS and chars[n]]
    if not blocks:
        return 0
    core = max(blocks, key=lambda n: (total[n], -n))
    path = [core]
    while path[-1]:
        path.append(page.parent[path[-1]])
    for kind in ("article", "main"):
        for n in path:
            if page.name[n] == kind:
                return n
    threshold = min(value[n] for n in path)
    children: dict[int, list[int]] = {}
    for n in blocks:
        children.setdefault(page.parent[n], []).append(n)
    node = core
    for up in path[1:]:
        others = [n for n in children.get(up, []) if n != node]
        heads = [n for n in others if page.name[n] in HEADINGS]
        parts = [n for n in others if page.name[n] not in HEADINGS and value[n] >= threshold]
        stray = sum(chars[n] for n in others) - sum(chars[n] for n in heads) - sum(chars[n] for n in parts)
        weight = sum(chars[n] for n in parts)
        if (parts and weight >= 0.2 * chars[node] and weight > stray) or (heads and not parts and not stray):
            node = up
        elif others:
            break
    return node


def blocks_of(page: Page, root: int) -> list[str]:
    """The blocks of a node's text in page order: white space is one space, link lists are left out."""
    size = len(page.name)
    links, items = [0] * size, [0] * size
    for n in range(size - 1, 0, -1):
        links[n] = page.chars[n] if page.name[n] == "a" else links[n]
        links[page.parent[n]] += links[n]
        items[page.parent[n]] += page.name[n] == "li"
    inside = [False] * size
    inside[root] = page.kept[root]
    for n in range(root + 1, size):
        link_list = page.name[n] in ("ul", "ol") and items[n] >= 3 and links[n] >= page.chars[n] > 0
        inside[n] = inside[page.parent[n]] and page.kept[n] and not link_list
    out, held = [], []
    for text, n in [*page.runs, (None, 0)]:
        if text is None:
            if block := " ".join("".join(held).split()):
                out.append(block)
            held = []
        elif inside[n]:
            held.append(text)
    return out


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    return "\n\n".join(blocks_of(page, main_node(page)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page row.

    NULL or empty html, and pages without text, give an empty text; NULL ids and urls stay,
    repeated rows stay, extra columns are ignored, an empty table gives no rows. A page is
    handled whole, in time linear in its length, by one task.
    """
    pages = with_defaults(pages, "page_id", "url", "html")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return pages.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
