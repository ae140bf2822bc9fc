"""Main text of web pages by tag-path ratios.

A page is read into blocks, each with the path of tags from the root. Text length and punctuation
are summed per path and divided by the path's blocks, smoothed along the page, fused, and paths
above a threshold of the page's own spread are content. The article elements that hold content, or
the main elements, are the article if together they hold nearly all of it, else the element around
all content; every block in it that is not marked as something else belongs to the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import map_texts

#: fixed values: tags by their role in a page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
SILENT = frozenset("head script style noscript template title svg math iframe object canvas audio video select textarea".split())
FRAME = frozenset("nav footer aside form button dialog menu".split())
ROOTS = frozenset(("html", "body", "article", "main"))
ITSELF_ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: a paragraph ends where one of these starts
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
#: fixed values: words in class, id and role that mark what is not the article
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "discussion disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notification "
    "pager pagination popup promo promotion related replies reply respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget alert complementary contentinfo search".split()
)
HEADER_MARKS = frozenset(("header", "topbar"))
#: fixed values: words that only say what kind of box a name like "share-buttons" stands for
BOXES = frozenset(
    "area articles badge bar block body bottom box boxes btn button buttons card cards col column container content count field "
    "frame group head heading holder icon icons inner item items js label left link links list listing media module network "
    "networks outer panel posts right row section slot space stories text title tool tools top unit wrap wrapper".split()
)
#: fixed values: of these, the ones that a layout also gives to what surrounds the article
LAYOUT = frozenset("sidebar widget search menu nav navbar navigation toolbar banner alert footer form modal".split())
#: fixed values: what may stand in a head; anything else starts the body
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: fixed values: pieces of running text, never the whole of an article
PIECES = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre figure figcaption address summary table thead tbody tfoot tr".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


@dataclass(frozen=True)
class TagPaths:
    """``kernel`` smooths along the page; ``spread`` scales the threshold; ``covered`` is the share
    of content text that an article or main element must hold."""

    kernel: tuple[float, ...] = (0.25, 0.5, 0.25)
    spread: float = 0.5
    covered: float = 0.75


@dataclass
class Element:
    tag: str
    path: int
    parent: int
    silent: bool = False
    marked: bool = False
    in_article: bool = False
    layout: bool = False  # marked by nothing but words of the page's layout
    own: bool = False  # itself marked, by words of the page's layout alone if ``own_layout``
    own_layout: bool = False
    firm: bool = False  # marked by a tag or hidden, or in such an element: not by words alone
    weak: bool = False  # in an article and named by a mark among other words: marked if it is mostly links

    def inherit(self, above: Element) -> None:
        """Marks from its own and those of the element above."""
        # "has-sidebar" around an article hides nothing
        around = above.marked and not (self.tag in ("article", "main") and above.layout)
        self.marked = around or self.own
        self.layout = (self.own_layout or not self.own) and (above.layout or not around) and self.marked


@dataclass
class Block:
    element: int
    text: str
    linked: int
    marked: bool


NOTHING: frozenset[str] = frozenset()


def marks_of(attrs: list[tuple[str, str | None]]) -> tuple[frozenset[str], bool, bool]:
    """The words of class, id and role, whether one of the names says nothing but a mark ("share",
    "share-buttons", not "social-science"), and whether the element is hidden."""
    named = dict(attrs)
    said = " ".join(str(named.get(k) or "") for k in ("class", "id", "role"))
    names = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", said).lower().split()
    words = [frozenset(re.findall(r"[a-z]+", name)) for name in names]
    plain = any(own & MARKS and own <= MARKS | BOXES for own in words)
    hidden = "hidden" in named or "display:none" in str(named.get("style") or "").replace(" ", "").lower()
    return frozenset().union(*words), plain, hidden


@dataclass
class Page(HTMLParser):
    """Blocks of text in page order and the elements that hold them."""

    elements: list[Element] = field(default_factory=lambda: [Element("", 0, -1)])
    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self) -> None:
        HTMLParser.__init__(self, convert_charrefs=True)
        self.open = [0]
        self.places: dict[str, list[int]] = defaultdict(list)  # of open elements, by tag
        self.paths: dict[tuple[int, str], int] = {}  # numbers of paths, by the path above and a name
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        own = self.elements[self.open[-1]]
        if text and not own.silent:
            self.blocks.append(Block(self.open[-1], text, min(self.linked, len(text)), own.marked))
        self.parts, self.linked = [], 0

    def _pop(self, tags: set[str] | frozenset, fence: frozenset = frozenset()) -> None:
        """Close the innermost open element with one of these tags, unless a fence stands before it."""
        at = max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)
        if not at or at < max((self.places[t][-1] for t in fence if t not in tags and self.places.get(t)), default=0):
            return
        self.flush()
        for element in self.open[at:]:
            self.places[self.elements[element].tag].pop()
        del self.open[at:]

    def _start_body(self) -> None:
        """Close a head that was left open."""
        if self.elements[self.open[-1]].tag == "head":
            self._pop({"head"})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            self._pop({"head"})
        elif tag not in HEAD:
            self._start_body()
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag in ("br", "wbr", "img", "input"):
                self.parts.append(" " if tag != "wbr" else "")
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        marks, plain, hidden = marks_of(attrs) if attrs else (NOTHING, False, False)
        if tag in ENDS_P:
            self._pop({"p"}, frozenset(("td", "th", "li", "button", "table")))
        if tag in ITSELF_ENDS:
            self._pop(ITSELF_ENDS[tag], frozenset(("ul", "ol", "dl", "table", "div", "section", "article")) if tag != "p" else frozenset())
        self.flush()
        if tag in ("article", "main"):  # these do not stand in a menu that was never closed
            self._pop(FRAME | {"header"}, frozenset(("article", "main")))
        above = self.elements[self.open[-1]]
        header = (tag == "header" or bool(marks & HEADER_MARKS)) and not above.in_article
        named = bool(marks & MARKS)
        weak = named and above.in_article and not plain
        marked = tag not in ROOTS and (tag in FRAME or header or named and not weak or hidden)
        layout = marked and tag not in FRAME and not hidden and not header and marks & MARKS <= LAYOUT
        name = ".".join([tag, *sorted(marks)])
        within = above.in_article or tag in ("article", "main")
        firm = above.firm or tag in FRAME or header or hidden
        path = self.paths.setdefault((above.path, name), len(self.paths) + 1)
        own = Element(
            tag, path, self.open[-1], above.silent or tag in SILENT, in_article=within, own=marked, own_layout=layout, firm=firm,
            weak=weak and not marked,
        )
        own.inherit(above)
        self.elements.append(own)
        self.places[tag].append(len(self.open))
        self.open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an HTML element

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
        elif tag not in VOID:
            self._pop({tag})

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._start_body()
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def read_page(html: str) -> Page:
    page = Page()
    page.feed(html)
    page.close()
    page.flush()
    confirm(page)
    release(page)
    return page


def weights(page: Page, own: list[int]) -> np.ndarray:
    """Per element the sum over the blocks in it; ``own`` has a number for each block."""
    total = np.zeros(len(page.elements))
    for b, n in zip(page.blocks, own, strict=True):
        total[b.element] += n
    for i in range(len(total) - 1, 0, -1):  # children come after their parents
        total[page.elements[i].parent] += total[i]
    return total


def _inherit(page: Page) -> None:
    """Bring marks from their elements down to the blocks, after some were changed."""
    for x in page.elements[1:]:
        x.inherit(page.elements[x.parent])
    for b in page.blocks:
        b.marked = page.elements[b.element].marked


def confirm(page: Page) -> None:
    """Mark what an article names by a mark among other words if more than half of its text is links."""
    if not any(e.weak for e in page.elements):
        return
    mass, linked = weights(page, [len(b.text) for b in page.blocks]), weights(page, [b.linked for b in page.blocks])
    for i, e in enumerate(page.elements):
        e.own = e.own or e.weak and 2 * linked[i] > mass[i]
    _inherit(page)


def release(page: Page) -> None:
    """Take back marks by words alone from what holds nearly all of the page's text.

    Such elements hold over half of the text outside firm marks, so they stand in each other. From the
    outside in, one is released as long as it holds nine times what is not marked at all. A page with
    unmarked text in an article or main element keeps all marks.
    """
    every = page.elements
    if not any(e.own and not e.firm for e in every):
        return
    if any(every[b.element].in_article and not b.marked for b in page.blocks):
        return
    mass = weights(page, [0 if every[b.element].firm else len(b.text) for b in page.blocks])
    around = [i for i, e in enumerate(every) if e.own and not e.firm and 2 * mass[i] > mass[0]]
    if not around:
        return
    layouts = [every[i].own_layout for i in around]
    free = sum(len(b.text) for b in page.blocks if not b.marked)
    for i in around:
        every[i].own = every[i].own_layout = False
    _inherit(page)
    depth, inner = np.zeros(len(every), np.int64), set(around)
    for i in range(1, len(every)):
        depth[i] = depth[every[i].parent] + (i in inner)
    freed = np.zeros(len(around) + 1)  # text that is unmarked once so many are released
    for b in page.blocks:
        if not b.marked and depth[b.element]:
            freed[depth[b.element]] += len(b.text)
    done = 0
    while done < len(around) and 9 * free <= mass[around[done]]:
        done += 1
        free += freed[done]
    for i, layout in list(zip(around, layouts, strict=True))[done:]:
        every[i].own, every[i].own_layout = True, layout
    _inherit(page)


def content_blocks(page: Page, p: TagPaths) -> np.ndarray:
    """Which blocks stand on a path above the page's threshold."""
    length, points, number = defaultdict(float), defaultdict(float), defaultdict(int)
    for b in page.blocks:
        path = page.elements[b.element].path
        length[path] += len(b.text) - b.linked
        points[path] += len(PUNCTUATION.findall(b.text)) * (b.linked < len(b.text) / 2)
        number[path] += 1
    paths = [page.elements[b.element].path for b in page.blocks]
    scores = []
    for sums in (length, points):
        ratio = np.array([sums[x] / number[x] for x in paths])
        half = len(p.kernel) // 2
        smooth = np.convolve(np.pad(ratio, half, mode="edge"), p.kernel, "valid")
        scores.append(ratio * smooth)
    fused = np.sqrt(np.sqrt(scores[0]) * np.sqrt(scores[1] + 1e-9))
    own = np.array([not b.marked for b in page.blocks])
    fused = fused * own
    if not own.any():
        return own
    of_path: dict[int, list[float]] = defaultdict(list)
    for path, value in zip(paths, fused, strict=True):
        of_path[path].append(value)
    mean = {path: float(np.mean(values)) for path, values in of_path.items()}
    limit = min(p.spread * float(np.std(list(mean.values()))), max(mean.values()))
    return np.array([mean[path] >= limit and mean[path] > 0 for path in paths]) & own


def _frames(page: Page, mass: np.ndarray, free: np.ndarray, covered: float, tags: tuple[str, ...]) -> list[int]:
    """The outermost elements of these tags with unmarked text, if together they hold the share
    ``covered`` of the content."""
    within, found = [False] * len(page.elements), []
    for i, e in enumerate(page.elements):
        within[i] = i > 0 and within[e.parent]
        if e.tag in tags and not within[i]:
            within[i] = True
            if free[i] > 0:
                found.append(i)
    return found if sum(mass[i] for i in found) >= covered * mass[0] else []


def main_text(html: str | None, p: TagPaths) -> str:
    """The article of one page: blocks in page order, joined by one blank; empty if there is none."""
    page = read_page(html) if html else None
    if not page or not page.blocks:
        return ""
    chosen = content_blocks(page, p)
    if not chosen.any():  # no punctuation or length anywhere: whatever is not marked
        chosen = np.array([not b.marked for b in page.blocks])
    mass = weights(page, [len(b.text) * int(yes) for b, yes in zip(page.blocks, chosen, strict=True)])
    if not mass[0]:
        return ""
    free = weights(page, [len(b.text) * (not b.marked) for b in page.blocks])
    frames = _frames(page, mass, free, p.covered, ("article",)) or _frames(page, mass, free, p.covered, ("article", "main"))
    if not frames:  # the innermost element around all content that is not a mere piece of it
        best = int(np.flatnonzero(mass == mass[0])[-1])
        holds = {e.parent for e in page.elements}
        while best > 0 and (page.elements[best].tag in PIECES or best not in holds):
            best = page.elements[best].parent
        frames = [best]
    inside = set(frames)
    for i in range(min(frames) + 1, len(page.elements)):
        if page.elements[i].parent in inside:
            inside.add(i)
    return " ".join(b.text for b in page.blocks if b.element in inside and not b.marked)


def extracted(pages: DataFrame, p: TagPaths | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    A null or empty page, and one without text, gives an empty text. Repeated rows are read each;
    an empty table gives no rows; further columns are ignored. Markup that is cut off or wrongly
    nested is read as far as it goes.
    """
    p = p or TagPaths()

    def make(texts, kept):
        return kept["page_id"], kept["url"], [main_text(t, p) for t in texts]

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    found = map_texts(rows, "html", ["page_id", "url"], make, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
