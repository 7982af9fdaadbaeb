"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags and texts (no tree is kept): each text gets the path of
open tags above it, and paths are numbered, so a deep page costs what its length costs. Per path:

* length and punctuation: characters and sentence marks a node, less what is link text;
* smoothed: the mean of that value over the path's nodes and their neighbours in page order;
* fused: the mean of both. Paths of at least a tenth of the best fused value are content.

The content root is the deepest container that holds four fifths of the content's characters
(its whole ``article`` or ``main`` if it lies in one). All text under it belongs to the result, short
paragraphs and lists too, less elements that are page furniture by tag, role, class or id:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments.

Defined results: a null or empty page, or one without content, gives the empty text. Unclosed and stray
tags are read as browsers do in the common cases; a ``<`` that opens no tag is text. Rows are worked on one
by one: repeated pages give equal rows, null ids and urls are carried. Extra columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、؛؟]")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr".split())
#: An opening tag ends these open ones, as far as the tags that bound the search.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
FURNITURE_TAGS = set("nav footer aside form button select script style noscript svg iframe dialog template menu head object audio "
                     "video canvas textarea title xmp noembed noframes fieldset datalist".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
FURNITURE_NAMES = set("nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar banner footer sidebar aside "
                      "widget widgets related recommended recommendations share sharing social ad ads adv advert adverts "
                      "advertisement advertising sponsor sponsored promo promoted promotion cookie cookies consent notice notices gdpr alert popup "
                      "modal overlay newsletter subscribe subscription signup login search form comment comments respond reply "
                      "replies disqus discussion pagination pager copyright legal disclaimer toolbar skip teaser teasers".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption summary".split())
#: In an article these are its own parts.
OWN_PARTS = {"header", "banner", "notice", "alert"}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def _is_furniture(tag: str, raw: str, inside: bool) -> bool:
    """Whether an element is no main text by itself; ``inside`` an article or main."""
    if tag in FURNITURE_TAGS or (tag == "header" and not inside):
        return True
    if not raw.strip() or tag in ("html", "body", "main"):
        return False
    a = _attributes(raw)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if a.get("role", "").lower() in FURNITURE_ROLES:
        return True
    names = set()
    for name in (a.get("class", "") + " " + a.get("id", "")).lower().split():
        parts = re.split(r"[^a-z]+", name)
        if parts[0] not in ("has", "with", "no", "without"):
            names.update(parts)
    if inside:
        names -= OWN_PARTS
    return bool(names & FURNITURE_NAMES)


class _Page:
    """Texts of a page with their paths."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.parent: list[int] = [-1]
        self.tag: list[str] = [""]
        self.texts: list[tuple[int, int, int, bool, str]] = []  # path, block path, block, in a link, text

    def path(self, above: int, tag: str, raw: str) -> int:
        found = re.search(r"""\b(?:class|id)\s*=\s*["']?([\w-]+)""", raw) if raw else None
        key = (above, f"{tag}.{found[1].lower()}" if found else tag)
        if key not in self.paths:
            self.paths[key] = len(self.parent)
            self.parent.append(above)
            self.tag.append(tag)
        return self.paths[key]

    def read(self, html: str) -> None:
        # an open element: tag, its path, the path of its block, whether it is furniture, in an article, in a link
        stack: list[tuple[str, int, int, bool, bool, bool]] = [("", 0, 0, False, False, False)]
        at, block, n = 0, 0, len(html)

        def text(hi: int) -> None:
            _, path, own, furniture, _, link = stack[-1]
            if hi > at and not furniture:
                self.texts.append((path, own, block, link, unescape(html[at:hi])))

        def pop(to: int) -> None:
            nonlocal block
            if any(e[0] not in INLINE for e in stack[to:]):
                block += 1
            del stack[to:]

        scan = at
        while True:
            lo = html.find("<", scan)
            if lo < 0:
                text(n)
                return
            if html.find(">", lo) < 0:  # no tag can end any more
                text(n)
                return
            m = TOKEN.match(html, lo) or LOOSE.match(html, lo)
            if not m:
                scan = lo + 1
                continue
            text(lo)
            at = scan = m.end()
            if not m[2]:
                continue
            tag, closing, raw = m[2].lower(), bool(m[1]), m[3]
            if closing:
                k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if k:
                    pop(k)
                elif tag in ("p", "br"):
                    block += 1
                continue
            if tag not in INLINE:
                block += 1
                ends, bounds = ENDS.get(tag, ({"p"}, {"button", "table", "td", "th", "object"}))
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in ends:
                        pop(i)
                        if tag not in ("tr", "tbody"):
                            break
                    elif stack[i][0] in bounds or (i < len(stack) - 1 and stack[i][0] not in INLINE):
                        if stack[i][0] in bounds or "p" in ends:
                            break
            if tag in VOID:
                continue
            _, above, own, furniture, inside, link = stack[-1]
            path = self.path(above, tag, raw)
            inside = inside or tag in ("article", "main") or "role=\"main\"" in raw
            furniture = furniture or _is_furniture(tag, raw, stack[-1][4])
            stack.append((tag, path, path if tag not in INLINE else own, furniture, inside, link or tag == "a"))
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])|\Z", re.I).search(html, at)
                at = scan = end.start()


def _content_root(page: _Page) -> int:
    """The path under which the main text lies, by ratios of the blocks' paths; -1 if there is none."""
    nodes: list[list] = []  # block, path, characters, punctuation, link characters
    for _, own, block, link, text in page.texts:
        size = len(text) - text.count(" ") - text.count("\n")
        if not size or text.isspace():
            continue
        if not nodes or nodes[-1][0] != block or nodes[-1][1] != own:
            nodes.append([block, own, 0, 0, 0])
        nodes[-1][2] += size
        nodes[-1][3] += len(PUNCTUATION.findall(text))
        nodes[-1][4] += size if link else 0
    if not nodes:
        return -1
    sums: dict[int, list[float]] = {}
    for _, path, size, marks, linked in nodes:
        s = sums.setdefault(path, [0, 0, 0, 0])
        for i, v in enumerate((1, size, marks, linked)):
            s[i] += v
    ratio = {p: (size / k) * (1 + marks / k) * (1 - linked / size) for p, (k, size, marks, linked) in sums.items()}
    series = [ratio[x[1]] for x in nodes]
    smooth: dict[int, float] = {}
    for i, x in enumerate(nodes):
        around = series[max(0, i - 1):i + 2]
        smooth[x[1]] = smooth.get(x[1], 0) + (sum(around) + series[i]) / (len(around) + 1)
    fused = {p: (ratio[p] + smooth[p] / sums[p][0]) / 2 for p in sums}
    best = max(fused.values())
    content = {p: sums[p][1] for p in sums if fused[p] >= 0.1 * best}
    total, under = sum(content.values()), {}
    for p, size in content.items():
        # a text block's container is what stands above it; text right in a container counts for that one
        while p >= 0:
            under[p] = under.get(p, 0) + size
            p = page.parent[p]
    depth: dict[int, int] = {-1: -1}
    for p in range(len(page.parent)):
        depth[p] = depth[page.parent[p]] + 1
    # a paragraph, heading or cell is no container
    options = [p for p, size in under.items() if size >= 0.8 * total and page.tag[p] not in LEAVES]
    root = max(options, key=lambda p: depth[p], default=0)
    # an article (or main) that the root lies in is wanted whole
    up, whole = root, root
    while up > 0:
        if page.tag[up] in ("article", "main") and page.tag[whole] != "article":
            whole = up
        up = page.parent[up]
    return whole


def main_text(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    page = _Page()
    page.read(html)
    root = _content_root(page)
    if root < 0:
        return ""
    inside: dict[int, bool] = {root: True, -1: False}
    for p in range(len(page.parent)):
        inside.setdefault(p, inside[page.parent[p]])
    blocks: list[str] = []
    last = None
    for path, _, block, _, text in page.texts:
        if inside[path]:
            if block != last:
                blocks.append("")
                last = block
            blocks[-1] += text
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])

    x = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = [x.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return x.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
