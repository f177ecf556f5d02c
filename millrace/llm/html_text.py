"""Main text of web pages, from the events of the standard library's HTML parser.

The parser's events are cut into blocks of text. Each block remembers how much text and how many
tags it has, the content element (article or main) it stands in, and whether an element around it
is furniture: menus, headers, footers, sidebars, notices, adverts, forms, comments. Furniture and
markup are left out. Names (class, id, role) make no furniture of an element that holds an article or
main; only with a whole name such as ``comments`` it goes with its articles, if the page has others. A
form, noscript or template that holds an article or main is no furniture either, nor is a form around
most of the page's text.

The text-to-tag ratio of the blocks, smoothed by a Gaussian, is split in two clusters. What stands outside
of content elements is the main text if its upper cluster has more text than four times these elements.
A content element stays whole, but for those of links only. Outside, all is content from the first to
the last block of the upper cluster whose own ratio is high, and so are the other blocks of the innermost
container around these, however short, and the headings right before it. Only lists and parts of the
container that are links for the most part stay out. A list under a heading that counts comments goes.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.frames import map_batches, pick

#: Elements that end a block of text where they begin and where they end.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody tfoot thead title tr ul""".split()
)
#: Elements whose text is never content.
FURNITURE = frozenset(
    """aside button datalist dialog footer head iframe input label menu nav object option script
    select style svg textarea title canvas audio video""".split()
)
#: Elements that are furniture unless they hold content.
WRAPPERS = frozenset(("form", "noscript", "template"))
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role that name furniture.
NAMES = frozenset(
    """ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav
    navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo
    cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup
    login search comment comments commentlist disqus reply replies respond share sharing social related recommended
    widget toolbar pagination pager skip""".split()
)
#: Names of which one alone makes furniture of an element that holds content by its tag.
CONTENT_NAMES = frozenset("comment comments reply ad ads advert advertisement sponsored promo related".split())
#: Names that make no furniture of headings and within content.
HEAD_NAMES = frozenset(("header", "masthead"))
#: A name that begins so says what the element has or is, not what it is for.
STATES = frozenset("has is no not with without".split())
#: Elements that are text of their container, and those that only group such.
LINES = HEADINGS | frozenset("p pre address summary legend caption figcaption dt dd li".split())
GROUPS = frozenset("ul ol dl table thead tbody tfoot tr blockquote figure hgroup".split())
_PLACES = BLOCKS | frozenset(("body", "td", "th"))
_WORD = re.compile(r"[a-z]+")
_WIDTH = 2  # of the Gaussian, in blocks
#: A character in a content element counts as so many outside.
CONTENT_WEIGHT = 4
#: Headings and paragraphs that a form around the page has at least.
PAGE_LINES = 3
LISTS = frozenset(("ul", "ol", "dl"))
#: Headings of reader comments, if a list follows.
_COMMENTS = re.compile(
    r"""\(?(\d[\d.,]*|no)\)?\s+(comments?|responses?|replies|reactions?)(\s+(to|on)\s+["'“‘«„].*)?:?|(reader\s+)?comments?(\s*\(\d+\))?:?""",
    re.IGNORECASE,
)


class _Named:
    """An element that its names or its tag make furniture of, unless it turns out to hold content."""

    __slots__ = ("around", "strong", "article", "main", "form", "lines")

    def __init__(self, around: _Named | None, strong: bool, form: bool = False):
        self.around, self.strong, self.form = around, strong, form
        self.article = self.main = False
        self.lines = 0  # headings and paragraphs in a form


class _Blocks(HTMLParser):
    """Collects (pieces, tags, region, place) of the blocks outside furniture; region 0 is none.

    A piece is (text, innermost named element around it, whether it is a link); whether a named
    element is furniture is known at the end of the page. Places are the elements that hold blocks,
    numbered as they begin; 0 is the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[list, int, int, int]] = []
        self.open: list[tuple[str, bool, int, _Named | None, int, bool]] = []  # tag, furniture, region, named, place, link
        self.text: list[tuple[str, _Named | None, bool]] = []
        self.places: list[tuple[str, int]] = [("body", 0)]  # tag, place around
        self.tags = self.regions = 0
        self.skip, self.region, self.named, self.place, self.link = False, 0, None, 0, False
        self.counts: Counter[str] = Counter()  # of open elements
        self.forms: list[_Named] = []

    def parse_html_declaration(self, i):
        # All of these end with the next ">" in HTML; the parser's own rules raise on most marked sections.
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def _end_block(self) -> None:
        if self.text:
            self.blocks.append((self.text, self.tags, self.region, self.place))
            self.text = []
        self.tags = 0

    def _is_furniture(self, tag: str, attrs) -> bool:
        if tag in FURNITURE or tag == "header" and not self.region:
            return True
        if not attrs or tag in ("html", "body"):
            return False
        for name, value in attrs:
            if name in ("class", "id", "role"):
                if tag in CONTENT and not CONTENT_NAMES.isdisjoint((value or "").lower().split()):
                    return True
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            elif name == "style" and value and re.search(r"display\s*:\s*none", value):
                return True
        return False

    def _names(self, tag: str, attrs) -> _Named | None:
        """The innermost named element within an element that begins."""
        if not attrs or tag in ("html", "body") or tag in CONTENT:
            return self.named
        # A title block within content is content, as the header element is there.
        fine = HEAD_NAMES if self.region or tag in HEADINGS else frozenset()
        met = strong = False
        for name, value in attrs:
            # The id of a heading or paragraph is made from its text.
            if name in ("class", "role") or name == "id" and tag != "p" and tag not in HEADINGS:
                for one in (value or "").lower().split():
                    words = _WORD.findall(one)
                    if words and words[0] not in STATES and not (NAMES - fine).isdisjoint(words):
                        met, strong = True, strong or one in CONTENT_NAMES
        return _Named(self.named, strong) if met else self.named

    def texts(self) -> list[tuple[str, int, int, int, bool]]:
        """(text, tags, region, place, whether it is links for the most part) of the blocks, without furniture."""
        wrapper = self._page_form()
        found = self._alive(False, wrapper)
        return found if any(b[2] for b in found) else self._alive(True, wrapper)

    def _page_form(self) -> _Named | None:
        """The form around more than half of the page's text that is not in other furniture or links."""
        for form in self.forms:
            if form.lines >= PAGE_LINES:
                rest = sum(len(b[0]) for b in self._alive(False, None) if not b[4])
                every = sum(len(b[0]) for b in self._alive(False, form) if not b[4])
                if every > 2 * rest:
                    return form
        return None

    def _alive(self, strong: bool, wrapper: _Named | None) -> list[tuple[str, int, int, int, bool]]:
        furniture: dict[_Named | None, bool] = {None: False}

        def goes(named: _Named | None) -> bool:
            way = []
            while named not in furniture:
                way.append(named)
                named = named.around
            out = furniture[named]
            for one in reversed(way):
                out = out or one is not wrapper and not (one.main or one.article and (strong or not one.strong))
                furniture[one] = out
            return out

        out = []
        for pieces, tags, region, place in self.blocks:
            stays = [(t, link) for t, named, link in pieces if not goes(named)]
            text = " ".join("".join(t for t, _ in stays).split())
            if text:
                links = sum(len(t.strip()) for t, link in stays if link)
                out.append((text, tags, region, place, 2 * links >= len(text)))
        return out

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self._end_block()
            # A paragraph ends where another block begins, items and cells where the next one does.
            if self.open and self.open[-1][0] == "p" or tag in ("li", "dt", "dd", "tr") and self._last(tag):
                self._close("p" if self.open[-1][0] == "p" else tag)
        elif tag in ("br", "td", "th"):
            self.text.append((" ", self.named, False))
        if tag in VOID:
            return
        skip = self.skip or self._is_furniture(tag, attrs)
        if not skip:
            self.named = self._names(tag, attrs)
            if tag in WRAPPERS:
                self.named = _Named(self.named, False, tag == "form")
                if tag == "form":
                    self.forms.append(self.named)
            elif self.forms and self.counts["form"] and (tag == "p" or tag in HEADINGS):
                self.forms[-1].lines += 1
        if tag in CONTENT and not skip:
            self._hold(tag)
            if not self.region:
                self.regions += 1
                self.region = self.regions
        if tag in _PLACES:
            self.places.append((tag, self.place))
            self.place = len(self.places) - 1
        self.link = self.link or tag == "a"
        self.open.append((tag, skip, self.region, self.named, self.place, self.link))
        self.counts[tag] += 1
        self.skip = skip

    def _hold(self, tag: str) -> None:
        """Notes in the named elements around that they hold content."""
        named = self.named
        while named is not None and not getattr(named, tag):
            setattr(named, tag, True)
            named = named.around

    def _back(self) -> None:
        state = self.open[-1][1:] if self.open else (False, 0, None, 0, False)
        self.skip, self.region, self.named, self.place, self.link = state

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _last(self, tag: str) -> bool:
        return self.open[-1][0] == tag if self.open else False

    def _close(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        while True:
            last = self.open.pop()[0]
            self.counts[last] -= 1
            if last == tag:
                break
        self._back()

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block()
        self._close(tag)

    def handle_data(self, data):
        if not self.skip:
            self.text.append((data, self.named, self.link))


def _upper_cluster(ratios: np.ndarray) -> np.ndarray:
    """Which ratios are in the higher of two clusters, smoothed and by themselves; all if they do not differ."""
    reach = np.arange(-3 * _WIDTH, 3 * _WIDTH + 1)
    kernel = np.exp(-(reach**2) / (2 * _WIDTH**2))
    smooth = np.convolve(ratios, kernel, "full")[3 * _WIDTH : 3 * _WIDTH + len(ratios)]
    smooth /= np.convolve(np.ones(len(ratios)), kernel, "full")[3 * _WIDTH : 3 * _WIDTH + len(ratios)]
    low, high = smooth.min(), smooth.max()
    if high - low < 1e-9:
        return np.ones(len(ratios), bool)
    for _ in range(50):
        upper = smooth >= (low + high) / 2
        means = smooth[~upper].mean(), smooth[upper].mean()
        if means == (low, high):
            break
        low, high = means
    both = upper & (ratios >= (low + high) / 2)
    return both if both.any() else upper


def _last_within(places: list[tuple[str, int]]) -> list[int]:
    """The last place within each."""
    ends = list(range(len(places)))
    for k in range(len(places) - 1, 0, -1):
        around = places[k][1]
        ends[around] = max(ends[around], ends[k])
    return ends


def _region(blocks: list, high: np.ndarray, places: list[tuple[str, int]], ends: list[int]) -> list:
    """The blocks of the main text outside of content elements; ``high`` are those of high ratio."""
    upper = np.flatnonzero(high)
    first, last = int(upper[0]), int(upper[-1])
    held = [blocks[k][3] for k in upper]
    inner = held[0]
    while inner and (places[inner][0] in LINES | GROUPS or not inner <= min(held) <= max(held) <= ends[inner]):
        inner = places[inner][1]
    within = [inner <= b[3] <= ends[inner] for b in blocks]
    start = within.index(True)
    while start and places[blocks[start - 1][3]][0] in HEADINGS:
        start -= 1
        within[start] = True
    out = []
    for k, (block, inside) in enumerate(zip(blocks, within, strict=True)):
        tag, around = places[block[3]]
        own = block[3] == inner or around == inner and tag in LINES
        if first <= k <= last or inside and (own or tag in HEADINGS or not block[4]):
            out.append(block)
    return out


def _without_comments(blocks: list, places: list[tuple[str, int]], ends: list[int]) -> list:
    """Leaves out headings that count comments, with the lists right behind them."""
    out, k = [], 0
    while k < len(blocks):
        tag, around = places[blocks[k][3]]
        upto = k + 1
        if tag in HEADINGS and _COMMENTS.fullmatch(blocks[k][0]):
            while upto < len(blocks):
                # The list that is a child of the heading's container.
                place = blocks[upto][3]
                while place and places[place][1] != around:
                    place = places[place][1]
                if not place or places[place][0] not in LISTS or blocks[upto][3] > ends[around]:
                    break
                upto += 1
        if upto == k + 1:
            out.append(blocks[k])
        k = upto
    return out


def main_text(html: str | None) -> str:
    """The blocks of the page's main text, in order, one a line; empty if there is none."""
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser._end_block()
    ends = _last_within(parser.places)
    blocks = _without_comments(parser.texts(), parser.places, ends)
    if not blocks:
        return ""
    high = _upper_cluster(np.array([len(b[0]) / max(1, b[1]) for b in blocks]))
    inside = sum(len(b[0]) for b in blocks if b[2] and not b[4])
    outside = sum(len(b[0]) for b, h in zip(blocks, high, strict=True) if h and not b[2] and not b[4])
    if any(b[2] for b in blocks) and CONTENT_WEIGHT * inside >= outside:
        read = {b[2] for b in blocks if b[2] and not b[4]}
        chosen = [b for b in blocks if b[2] and (b[2] in read or not read)]
    else:
        out = [k for k, b in enumerate(blocks) if not b[2]]
        blocks, high = [blocks[k] for k in out], high[out]
        chosen = _region(blocks, high if high.any() else np.ones(len(blocks), bool), parser.places, ends)
    return "\n".join(b[0] for b in chosen)


def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(h) for h in batch.column(2).to_pylist()]
    sizes = pa.array([len(t) for t in texts], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    ``pages`` has page_id, url and html; other columns are left out. Null, empty and text-free
    pages have the empty text. White space in a block becomes one space. Nothing of the content is
    cut, however long or short. Repeated rows stay; an empty table gives an empty result.
    """
    rows = pick(pages, page_id="long", url="string", html="string")
    return map_batches(rows, _batch, "page_id long, url string, text string, n_chars long")
