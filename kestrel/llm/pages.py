"""Main text of web pages by tag-path ratios.

Every text node of a page has a root-to-leaf tag path. Text length, punctuation and link text are
summed per path; a path's ratios are its length and its punctuation per node. Each node takes the
ratios of its path, both series are smoothed along the page with a Gaussian, fused, and cut at a
threshold that follows their spread: the nodes above it are content. What mark-up calls a part of the page
is evidence only: names like "comments" or "sidebar" lower the scores of what they hold, unless they hold the
headline or nearly all of the page's weight.

The chosen nodes tell where the article is: an <article> that holds nearly all of their text, else the
smallest structural element that holds all of them and the headings. In it, text beside chosen nodes that
nothing speaks against goes with them, and a list of links does where content goes on after it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, rows_of

# fixed values: HTML's own element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table "
                   "tbody td tfoot th thead tr ul").split())
#: An opening tag ends an open element of these, up to the nearest element that may hold it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"}}
HOLDS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"},
         "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "body": set()}
ENDS_P = BLOCK - {"html", "body", "tbody", "td", "tr", "th", "option", "legend", "summary"}
#: Elements that are never part of an article, and words of class, id or role that speak against it, or for it.
ASIDE = frozenset(("head script style noscript template nav aside footer form button select textarea input iframe svg canvas "
                   "object menu dialog audio video noembed noframes title").split())
ASIDE_WORDS = frozenset(("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies "
                         "consent notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs "
                         "sidebar aside widget footer masthead topbar toolbar comment comments disqus replies respond share sharing social related "
                         "recommended newsletter subscribe subscription signup login search pagination pager toc complementary "
                         "contentinfo").split())
CONTENT_WORDS = frozenset("article body content entry main page post story text wrapper container layout".split())
#: A name that holds one of these tells what a wrapper has beside its content.
JOINING = frozenset("with has have no without and plus hide show".split())
#: Nodes that names speak against are content only where this share of their score is above the others' mean.
DOUBT = 0.02
HEADER_WORDS = frozenset(("header", "banner"))
STRUCTURE = frozenset("html body main article section div table tbody tr td center".split())
HEADINGS = "h1", "h2", "h3", "h4", "h5", "h6"
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡]")
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^"'>]|["'])*?)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)


@dataclass
class Page:
    """Elements by number, parents before children, and the text nodes that may belong to an article."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    path: list[int] = field(default_factory=list)  # equal numbers: equal tags and names from the root on
    node: list[tuple[int, int, str, bool]] = field(default_factory=list)  # element, block, text, in a link
    doubt: list[bool] = field(default_factory=list)  # elements whose names speak against them


def _names(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether an element is never part of an article, whether its names speak against it, and the names."""
    if tag in ASIDE or tag == "header" and not in_article:
        return True, False, ""
    names: list[str] = []
    against = favour = 0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False, ""
        if name in ("class", "id", "role"):
            for each in value.split():
                words = set(re.split(r"[^a-z0-9]+", each))
                names += words
                if words & JOINING:
                    favour += 1
                elif words & ASIDE_WORDS or words & HEADER_WORDS and not in_article:
                    against += 1
                elif words & CONTENT_WORDS:
                    favour += 1
    if tag in ("html", "body", "main", "article"):
        return False, False, ""
    return False, against > favour, ".".join(sorted(set(names) - {""}))


def parse(html: str) -> Page:
    """Elements and text nodes of a page; missing and stray tags are mended as browsers do, roughly."""
    page = Page([-1], [""], [0], doubt=[False])
    paths: dict[tuple[int, str, str], int] = {}
    stack: list[tuple[int, str, bool, bool]] = [(0, "", False, False)]  # element, tag, aside, in a link
    block, at, size = 0, 0, len(html)
    open_tags: Counter[str] = Counter()

    def pop(k: int) -> None:
        for x in stack[k:]:
            open_tags[x[1]] -= 1
        del stack[k:]

    def text(piece: str) -> None:
        number, _, aside, link = stack[-1]
        if piece and not aside:
            page.node.append((number, block, unescape(piece), link))

    while at < size:
        m = TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in BLOCK:
            block += 1
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[k][1] == tag:
                    pop(k)
                    break
                if stack[k][1] in ("table", "article", "main") and tag not in BLOCK:
                    break
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            continue
        if tag in ENDS_P and open_tags["p"]:
            k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][1] in BLOCK)
            if stack[k][1] == "p":
                pop(k)
        if tag in CLOSES and any(open_tags[x] for x in CLOSES[tag]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in CLOSES[tag]:
                    pop(k)
                    break
                if stack[k][1] in HOLDS[tag]:
                    break
        up, _, aside, link = stack[-1]
        own, doubt, label = _names(tag, m[3], open_tags["article"] + open_tags["main"] > 0)
        page.parent.append(up)
        page.tag.append(tag)
        page.doubt.append(doubt)
        page.path.append(paths.setdefault((page.path[up], tag, label), len(paths) + 1))
        open_tags[tag] += 1
        stack.append((len(page.tag) - 1, tag, aside or own, link or tag == "a"))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else size
            if not end:
                break
    return page


def smooth(x: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    reach = int(3 * sigma)
    k = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma * sigma))
    ones = np.convolve(np.ones(len(x)), k)[reach:reach + len(x)]
    return np.convolve(x, k)[reach:reach + len(x)] / ones


def doubted(page: Page, share: float = 0.9) -> np.ndarray:
    """The elements that names speak against, with all that they hold.

    An element that holds the headline, an <article> or <main>, or ``share`` of the text of which nothing but
    its own name speaks against, is a wrapper, whatever it is called.
    """
    n = len(page.tag)
    size, headline = np.zeros(n), np.isin(page.tag, ("h1", "article", "main"))
    for number, _, text, link in page.node:
        size[number] += 0 if link else len(text.strip())
    for number in range(n - 1, 0, -1):
        size[page.parent[number]] += size[number]
        headline[page.parent[number]] |= headline[number]
    out = np.array(page.doubt)
    out &= ~headline & ((size < share * size[0]) | (size == 0))
    for number in range(1, n):
        out[number] |= out[page.parent[number]]
    return out


def content_nodes(page: Page, strictness: float = 0.5) -> tuple[list[int], set[int], np.ndarray]:
    """Numbers of the nodes above the threshold, the paths whose text is mostly links, and the doubted elements."""
    shown = [i for i, n in enumerate(page.node) if n[2].strip()]
    doubt = doubted(page)
    total: dict[int, list[int]] = {}
    for i in shown:
        number, _, text, link = page.node[i]
        t = total.setdefault(page.path[number], [0, 0, 0, 0])
        size = len(text.strip())
        for k, v in enumerate((size, len(PUNCTUATION.findall(text)), size if link else 0, 1)):
            t[k] += v
    links = {p for p, (size, _, linked, _) in total.items() if 2 * linked > size}
    if not shown:
        return [], links, doubt
    ratios = [total[page.path[page.node[i][0]]] for i in shown]
    length = smooth(np.array([(size - linked) / n for size, _, linked, n in ratios]))
    marks = smooth(np.array([(1 + p) / n for _, p, _, n in ratios]))
    fused = length * marks
    against = np.array([doubt[page.node[i][0]] for i in shown])
    clear = fused[~against] if not against.all() else fused
    cut = strictness * min(float(clear.std()), float(clear.mean()))
    if not against.all():  # what names speak against must stand out by far
        fused = np.where(against & (DOUBT * fused < clear.mean()), -np.inf, fused)
    return [i for i, f in zip(shown, fused) if f >= cut and f > -np.inf and page.path[page.node[i][0]] not in links], links, doubt


def container(page: Page, chosen: list[int], doubt: np.ndarray, share: float = 0.9) -> int:
    """The outermost <article> with at least ``share`` of the chosen nodes' text; without one, the smallest
    structural element, <main> at the least, that holds all chosen nodes and the headings that are no links."""
    weight, held = np.zeros(len(page.tag), dtype=np.int64), np.zeros(len(page.tag), dtype=np.int64)
    picked = set(chosen)
    for i, (number, _, text, _) in enumerate(page.node):
        weight[number] += len(text.strip()) if i in picked else 0
        held[number] += i in picked
    heading = np.isin(page.tag, HEADINGS)
    for number in range(1, len(heading)):
        heading[number] |= heading[page.parent[number]]
    for number, _, text, link in page.node:
        held[number] += bool(heading[number] and not link and text.strip() and not doubt[number])
    for number in range(len(weight) - 1, 0, -1):
        weight[page.parent[number]] += weight[number]
        held[page.parent[number]] += held[number]
    best = 0
    for number in range(1, len(weight)):  # parents come before children
        if page.tag[number] == "article" and weight[number] >= share * weight[0]:
            return number
        if held[number] == held[0] and page.tag[number] in STRUCTURE and page.tag[best] != "main":
            best = number
    return best


def _mostly_chosen(page: Page, chosen: set[int]) -> np.ndarray:
    """The elements in whose nearest structural element at least half of the text is chosen."""
    n = len(page.tag)
    home = list(range(n))
    for number in range(1, n):
        home[number] = number if page.tag[number] in STRUCTURE else home[page.parent[number]]
    held, size = np.zeros(n), np.zeros(n)
    for i, (number, _, text, _) in enumerate(page.node):
        size[home[number]] += len(text.strip())
        held[home[number]] += len(text.strip()) if i in chosen else 0
    return (2 * held >= size)[home] & (size > 0)[home]


def main_text(html: str, strictness: float = 0.5) -> str:
    """The article of a page: its blocks in page order, one per line; empty if there is none."""
    page = parse(html)
    chosen, links, doubt = content_nodes(page, strictness)
    if not chosen:
        return ""
    root = container(page, chosen, doubt)
    within, beside = np.zeros(len(page.tag), dtype=bool), np.zeros(len(page.tag), dtype=bool)
    within[root] = True
    up = root
    while up > 0 and page.tag[up] != "main":  # content that stands in <main> beside the article
        up = page.parent[up]
    beside[up] = up > 0
    for number in range(1, len(within)):
        within[number] |= within[page.parent[number]]
        beside[number] |= beside[page.parent[number]]
    paths = {page.path[page.node[i][0]] for i in chosen}
    inside = [i for i, (number, _, text, _) in enumerate(page.node) if within[number] and page.path[number] in paths and text.strip()]
    first, last = (inside[0], inside[-1]) if inside else (0, -1)
    weighty = set(chosen)
    spoken = {page.path[number] for number, _, text, _ in page.node if PUNCTUATION.search(text)}
    mostly = _mostly_chosen(page, weighty)
    trusted = page.tag[root] in ("article", "main")
    blocks: dict[int, list[str]] = {}
    for i, (number, block, text, link) in enumerate(page.node):
        if i in weighty:
            keep = within[number] or beside[number]
        elif not within[number] or doubt[number]:
            keep = False
        elif link and page.path[number] in links:  # a list of links between content belongs to it, as one of sources does
            keep = first < i < last
        else:  # short text goes with the content around it; in an element of its own it must be a sentence or a heading
            keep = trusted or mostly[number] or page.path[number] in spoken or page.tag[number] in HEADINGS
        if keep:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): the main text of every row of ``pages``.

    A null or empty page, or one without text outside menus and the like, has the text "". Bytes that are
    not UTF-8 count as U+FFFD. Null ids and urls and repeated rows come back as they are. An empty table gives
    an empty table.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [main_text(x.decode("utf-8", "replace")) for x in rows_of(batch, "html")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string")
