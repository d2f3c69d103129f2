"""Main text of web pages by text-to-tag ratio.

Parser events of the standard library are streamed into lines, one per block, with
the number of tags that fell into each. Their ratios of text outside links to tags are
smoothed with a Gaussian over neighbouring lines; a threshold (the deviation of all
smoothed ratios, at most their mean) splits the lines into a rich and a poor
cluster. The rich lines choose the region: the outermost article or main element
that holds at least ``_COVER`` of their text, all of which is returned; else the lowest
element that holds all of them and all headings, from its first rich line or heading
to its last rich line, lines of links only not counted. Short lines between rich ones are included. Left out is what
lies in menus, headers, footers, asides, forms, scripts and
elements whose class, id or role names adverts, notices, comments and the like.

A class or id is taken apart at hyphens, underscores and changes of case; the last part
that is not a mere container names the thing (``user-comments`` and ``comments-section``
are comments, ``share-price`` is a price, ``no-sidebar`` is none). Names do not count on
headings, nor on an element that holds an article,
main or h1 element, or most of the rich text unless that is outside the page's
article. The same goes for an element to be left
out that is never closed: it does not hide what follows. A head ends at
the first tag or text that cannot be in one.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by an empty line. A null or empty page, and one without text,
has an empty text. Broken markup is read as far as it can be; pages of any length
are read whole, in time proportional to their length: open elements are found by their
tag, never searched for. Repeated rows stay repeated; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.common import Batches, in_arrow

# HTML's elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form head iframe input label "
    "map menu nav noscript object option script search select style svg template textarea title video".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body html head caption legend option optgroup tbody td tfoot th thead tr".split())
LISTS = frozenset("menu ol ul".split())
REGIONS = frozenset("article blockquote body center div html main section table td th tr tbody ul ol dl".split())
NAMES_LEFT_OUT = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay popup promo promoted promotion related replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget".split()
)
ROLES_LEFT_OUT = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())

# What a name may end in, or begin with, without being about that.
CONTAINERS = frozenset("area block body box col column container content group inner item items list outer panel region root section widget wrap wrapper".split())
DENIALS = frozenset("above after before below has hide is no non not show with without".split())
PAGE_PARTS = frozenset("global main masthead page site top website".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())

_SIGMA = 1.5
_COVER = 0.9
_MOST = 0.5  # of the rich text


def hidden(tag: str, attributes: list, inside_article: bool) -> bool:
    """Whether an element's content is not main text, by its tag, role or the like."""
    if tag in LEFT_OUT:
        return True
    if tag == "header":
        return not inside_article
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if value and name == "role" and value.lower() in ROLES_LEFT_OUT:
            return True
    return False


def about(token: str) -> str:
    """What a token of a class or id names, if it is something to be left out; else nothing."""
    if token.lower() in NAMES_LEFT_OUT:
        return token.lower()
    parts = [part.lower() for part in _PARTS.findall(token)]
    if len(parts) < 2 or DENIALS & set(parts):
        return ""
    while len(parts) > 1 and parts[-1] in CONTAINERS:
        parts.pop()
    thing = parts[-1]
    # Articles and sections have headers too.
    if thing == "header" and not PAGE_PARTS & set(parts):
        return ""
    return thing if thing in NAMES_LEFT_OUT else ""


def named(tag: str, attributes: list) -> bool:
    """Whether an element's class or id says that its content is not main text."""
    if tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return False
    return any(about(token) for name, value in attributes if value and name in ("class", "id") for token in value.split())


class Element:
    """An open or closed element; ``parent`` is -1 for the page itself."""

    __slots__ = ("tag", "parent", "hidden", "named", "closed", "holds", "out", "linked")

    def __init__(self, tag: str, parent: int, hidden: bool, named: bool) -> None:
        self.tag, self.parent, self.hidden, self.named = tag, parent, hidden, named
        self.closed = False  # by its own end tag
        self.holds = tag in ("article", "main", "h1")  # or has one inside, see Lines.finish
        self.out = False
        self.linked = tag == "a"  # or lies in a link


class Lines(HTMLParser):
    """Streams parser events into lines: pieces of text with their elements, number of tags, element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1, False, False)]
        self.lines: list[tuple[list[tuple[int, str]], int, int]] = []
        self.open = [0]
        # Where in ``open`` the elements of a tag are, and those of a group of tags.
        self.places: dict[object, list[int]] = {}
        self.pending: list[tuple[int, str]] = []
        self.count = 0

    def flush(self) -> None:
        if any(text and not text.isspace() for _, text in self.pending):
            self.lines.append((self.pending, self.count, self.open[-1]))
            self.count = 0
        self.pending = []

    def finish(self) -> None:
        """What elements know of those inside them; children have larger numbers than parents."""
        self.flush()
        for element in reversed(self.elements[1:]):
            self.elements[element.parent].holds |= element.holds
        for element in self.elements[1:]:
            element.linked = element.linked or self.elements[element.parent].linked

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag not in IN_HEAD and tag != "head":
            self._leave_head(whole=tag == "body")
        if tag == "br":
            self.pending.append((self.open[-1], " "))
            self.count += 1
            return
        if tag in ENDS_PARAGRAPH:
            self._close("p", until=REGIONS)
        if tag in BLOCKS:
            self.flush()
        if tag == "li":
            self._close("li", until=LISTS)
        self.count += 1
        if tag in VOID:
            return
        inside = bool(self.places.get("article") or self.places.get("main"))
        self.elements.append(Element(tag, self.open[-1], hidden(tag, attributes, inside), named(tag, attributes)))
        for key in self._keys(tag):
            self.places.setdefault(key, []).append(len(self.open))
        self.open.append(len(self.elements) - 1)

    @staticmethod
    def _keys(tag: str) -> list:
        return [tag, *(group for group in (REGIONS, LISTS) if tag in group)]

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.count += 1
        self._close(tag, ended=True)

    def _last(self, key: object) -> int:
        return (self.places.get(key) or (0,))[-1]

    def _close(self, tag: str, until: frozenset = frozenset(), ended: bool = False) -> None:
        """Close the innermost open ``tag`` with all inside it; not across one of ``until``."""
        at = self._last(tag)
        if not at or at < self._last(until):
            return
        if tag in BLOCKS:
            self.flush()
        self.elements[self.open[at]].closed = ended or tag == "head"
        for number in self.open[at:]:
            for key in self._keys(self.elements[number].tag):
                self.places[key].pop()
        del self.open[at:]

    def _leave_head(self, whole: bool) -> None:
        """A head that is still open ends here, unless its content may hold any tag; before a body always."""
        if self._last("head") and (whole or self.elements[self.open[-1]].tag in ("head", "noscript")):
            self._close("head")

    def handle_data(self, data: str) -> None:
        if self.elements[self.open[-1]].tag == "head" and not data.isspace():
            self._leave_head(whole=True)
        self.pending.append((self.open[-1], data))

    def kept(self) -> tuple[list[str], np.ndarray, list[int]]:
        """Text, ratio and element of the lines that are in no element left out."""
        for element in self.elements[1:]:
            element.out = element.out or self.elements[element.parent].out
        texts, ratios, places, count = [], [], [], 0
        for pieces, own, place in self.lines:
            count += own
            left = [(at, piece) for at, piece in pieces if not self.elements[at].out]
            text = " ".join("".join(piece for _, piece in left).split())
            if text:
                linked = sum(len(piece) for at, piece in left if self.elements[at].linked)
                texts.append(text)
                ratios.append(max(0, len(text) - linked) / max(count, 1))
                places.append(place)
                count = 0
        return texts, np.array(ratios), places

    def held(self, places: list[int], sizes: list[int]) -> list[int]:
        """What the lines at ``places`` weigh in each element, all inside it counted."""
        weight = [0] * len(self.elements)
        for place, size in zip(places, sizes):
            weight[place] += size
        for at in range(len(weight) - 1, 0, -1):  # children have larger numbers than parents
            weight[self.elements[at].parent] += weight[at]
        return weight


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over neighbours, weights normalised at the ends."""
    reach = int(3 * _SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / _SIGMA) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def rich_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines are of the rich cluster."""
    smooth = smoothed(ratios)
    return smooth >= min(smooth.std(), smooth.mean())


def leave_out(page: Lines) -> None:
    """Mark what is not main text: surely what is hidden and closed, the rest unless it holds the main text."""
    doubtful = [e.named or e.hidden and not e.closed and e.tag not in ("script", "style") for e in page.elements]
    for element, doubt in zip(page.elements, doubtful):
        element.out = element.hidden and not doubt or element.hidden and element.closed
    if not any(doubtful):
        return
    texts, ratios, places = page.kept()
    if not texts:
        return
    rich = rich_lines(ratios)
    held = page.held(places, [len(t) if r else 0 for t, r in zip(texts, rich)])
    # Beside an article or main element, size alone does not make main text.
    within = [not any(e.tag in ("article", "main") and not e.out for e in page.elements)] * len(page.elements)
    for at, element in enumerate(page.elements):
        within[at] = within[at] or element.tag in ("article", "main") or at > 0 and within[element.parent]
        if doubtful[at] and not element.holds and not (within[at] and held[at] > _MOST * held[0]):
            element.out = True


def main_text(html: str | None) -> str:
    """The main text of one page, its blocks joined by an empty line."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.finish()
    leave_out(page)
    texts, ratios, places = page.kept()
    if not texts:
        return ""
    rich = rich_lines(ratios)
    held = page.held(places, [len(t) if r else 0 for t, r in zip(texts, rich)])
    elements = page.elements
    headed = [False] * len(elements)
    for at, element in enumerate(elements):
        headed[at] = element.tag in HEADINGS or at > 0 and headed[element.parent]
    wanted = page.held(places, [int(r or headed[place]) for place, r in zip(places, rich)])
    enough = _COVER * held[0]
    articles = [at for at, e in enumerate(elements) if e.tag in ("article", "main") and not e.out and held[at] >= enough]
    if articles:
        chosen = articles[0]
    else:
        regions = (at for at, e in enumerate(elements) if not at or e.tag in REGIONS and not e.out and wanted[at] == wanted[0])
        chosen = max(regions)
    inside = [False] * len(elements)
    for at, element in enumerate(elements):
        inside[at] = at == chosen or at > 0 and inside[element.parent]
    lines = [i for i, place in enumerate(places) if inside[place]]
    if not articles:
        # Nothing says where the text begins and ends but the clusters. Smoothing spreads
        # them to neighbours; a neighbour that is all links is no end of it.
        dense = [i for i in lines if rich[i] and ratios[i] > 0]
        first = next((i for i in lines if rich[i] and ratios[i] > 0 or headed[places[i]]), 0)
        lines = [i for i in lines if first <= i <= dense[-1]] if dense else lines
    return "\n\n".join(texts[i] for i in lines)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kept = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return in_arrow(kept, run, "page_id long, url string, text string, n_chars long")
