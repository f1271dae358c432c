"""Main text of web pages by scores on the element tree.

Every paragraph earns points for its commas and its length.  It passes them to
its ancestors, all to the nearest and less to each further one.  A container's
points are discounted by the share of its text inside links.  The best container
is taken, and beside it those siblings that score a fifth as much or read like
paragraphs.  If the best container is inside an article, the whole article is
taken, and beside it those articles whose text earns a fifth as much: an article
says itself what belongs to it, so plain elements beside it do not.  Scripts,
forms, menus, headers, footers, asides and elements whose role names such a thing
never take part; of a header inside an article its headings do.  Points are
carried upward once, so the time is linear in the page however deep it nests.

A class or id that names such a thing is only a doubt, as layout wrappers have
such names too.  A page with doubtful elements is read twice.  The first time all
of them take part, at a fifth of their points, and none passes points to what is
around it.  Excused are those around the best container, around ``main``, and, if
no article is outside doubtful elements, those around an article or around more
than half of the text.  The second time the others are left out.

Pages are read one by one, whole, inside the tasks that scan them; there is no
shuffle.  A null or empty page gives an empty text, as does a page without
text.  Broken markup (missing end tags, a cut-off end) is read as far as it goes.
Equal scores go to the container that starts first.  Repeated rows give repeated
results; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold main text.
_NEVER = frozenset(
    "head nav footer header aside form button select option textarea input label noscript template svg math canvas audio video object "
    "dialog menu script style iframe noembed noframes xmp title search".split()
)
_NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NEVER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banners?|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|"
    r"comments?|commentlist|disqus|replies|respond|sidebars?|side|menus?|navbar|nav|navigation|breadcrumbs?|footer|masthead|header|topbar|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|toolbar|tags|pagination|pager|skip|widgets?|hidden)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Parts of names that say nothing against an element: what it is without or beside, and the head of an article.
_HARMLESS_NAME = re.compile(r"(?:^|(?<=[\s_-]))(?:(?:no|has|with|without)[_-]+[^\s_-]+|(?:entry|post|article)[_-]+header)(?=$|[\s_-])", re.IGNORECASE)
#: Much text does not excuse these.
_ANSWERS_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?=$|[\s_-])", re.IGNORECASE)
_LIKELY_NAME = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|post|story|text|blog|page)(?=$|[\s_-])", re.IGNORECASE)
_CLOSES_P = _BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
#: A start tag ends the last open element of the first list, unless one of the second list was opened since.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "body": (("head",), ()),
}
_CONTAINERS = frozenset("article main section div body td blockquote html".split())
_FIRST_SCORE = {"article": 10.0, "main": 10.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0}
#: By level above the paragraph: what its points are divided by.
_DIVIDED = (1, 2, 6, 9, 12)
#: By what the points of a doubtful element are divided.
_DOUBT = 5
#: A sibling has to have this part of the best one's points.
_SIBLING = 5
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Page:
    """The kept blocks of a page, and for each element the block around it, its tag, names and whether it is left out.

    Of the elements with a doubtful name those in ``left_out`` are left out; elements have the same numbers in every reading.
    """

    def __init__(self, source: str, left_out: frozenset[int] = frozenset()):
        self.parents, self.tags, self.names = [-1], ["#page"], [""]
        self.above, self.shown, self.own_size = [-1], [True], [0]
        self.left_out, self.doubtful = left_out, set()
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self.open: list[int] = [0]
        self.out: list[bool | None] = [False]  # whether it is left out; None: all but headings
        self.homes = [0]  # of each open element, the block it is in
        self.opened: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = 0
        self.read(source)

    def read(self, source: str) -> None:
        at = 0
        while token := _TOKEN.search(source, at):
            if token.start() > at:
                self.text(source[at : token.start()])
            at = token.end()
            if not token[2]:
                continue
            tag = token[2].lower()
            if token[1]:
                self.end(tag)
            else:
                self.start(tag, token[3])
                if tag in _RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
                    at = close.start() if close else len(source)
        self.text(source[at:])
        self.flush()

    def text(self, piece: str) -> None:
        if piece and self.out[-1] is False:
            piece = html.unescape(piece) if "&" in piece else piece
            self.parts.append(piece)
            self.own_size[self.open[-1]] += len(piece.strip())
            if self.opened["a"]:
                self.linked += len(piece.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.homes[-1], text, min(self.linked, len(text))))
            self.parts = []
        self.linked = 0

    def close(self, place: int) -> None:
        for e in self.open[place:]:
            self.opened[self.tags[e]] -= 1
        del self.open[place:], self.out[place:], self.homes[place:]

    def close_implied(self, which: tuple[str, ...], barrier: tuple[str, ...]) -> None:
        if not any(self.opened[tag] for tag in which):
            return
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[place]]
            if tag in which:
                self.flush()
                self.close(place)
                return
            if tag in barrier:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in _BLOCK:
            self.flush()
            if tag in _CLOSES_P:
                self.close_implied(("p",), ("td", "th", "button", "table", "caption", "object"))
        if tag in _ENDS:
            self.close_implied(*_ENDS[tag])
        if tag in _VOID:
            return
        element = len(self.tags)
        names = ""
        out = self.out[-1]
        if out is None and tag in _HEADINGS:
            out = False
        elif tag in _NEVER:
            out = None if out is not True and tag == "header" and (self.opened["article"] or self.opened["main"]) else True
        if attributes and out is not True:
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            names = f"{given.get('class', '')} {given.get('id', '')}"
            if (
                given.get("role", "").lower() in _NEVER_ROLE
                or "hidden" in given
                or given.get("aria-hidden", "").lower() == "true"
                or "display:none" in given.get("style", "").replace(" ", "").lower()
            ):
                out = True
            if out is not True and tag not in ("html", "body", "article", "main") and _NEVER_NAME.search(_HARMLESS_NAME.sub("", names)):
                self.doubtful.add(element)
                out = True if element in self.left_out else out
        self.above.append(self.open[-1])
        self.shown.append(out is False)
        self.own_size.append(0)
        self.parents.append(self.homes[-1])
        self.tags.append(tag)
        self.names.append(names)
        if out is not False and tag not in _BLOCK:
            self.parts.append(" ")  # words on either side of something left out stay apart
        self.open.append(element)
        self.out.append(out)
        self.homes.append(element if tag in _BLOCK else self.homes[-1])
        self.opened[tag] += 1

    def end(self, tag: str) -> None:
        if tag in ("body", "html") or not self.opened[tag]:
            return  # what follows </body> still belongs to the page
        for place in range(len(self.open) - 1, 0, -1):
            here = self.tags[self.open[place]]
            if here == tag:
                if self.homes[-1] != self.homes[place - 1]:
                    self.flush()
                self.close(place)
                return
            if here in ("table", "article", "main") and tag not in _BLOCK:
                return  # the end of something outside


def doubts(page: Page) -> frozenset[int]:
    """The elements with a doubtful name that nothing excuses."""
    count = len(page.tags)
    size, mains, articles = page.own_size[:], [0] * count, [0] * count
    for e in range(count - 1, 0, -1):  # children come after their parents
        mains[e] += page.shown[e] and page.tags[e] == "main"
        articles[e] += page.shown[e] and page.tags[e] == "article"
        for sums in (size, mains, articles):
            sums[page.above[e]] += sums[e]
    doubted, in_article, clean = [False] * count, [False] * count, False
    for e in range(1, count):
        doubted[e] = doubted[page.above[e]] or e in page.doubtful
        in_article[e] = in_article[page.above[e]] or page.tags[e] == "article"
        clean |= page.tags[e] in ("article", "main") and page.shown[e] and not doubted[e]
    left = set()
    for e in page.doubtful:
        most = 2 * size[e] > size[0] and not _ANSWERS_NAME.search(page.names[e])
        if not (mains[e] or (not clean and (most or (articles[e] and not in_article[e])))):
            left.add(e)
    if left:
        final = scored(page, left)[0]
        e = max(final, key=lambda e: (final[e], -e)) if final else 0
        while e > 0:
            left.discard(e)
            e = page.above[e]
    return frozenset(left)


def scored(page: Page, doubtful: set[int] | frozenset[int] = frozenset()) -> tuple[dict[int, float], list[int], list[int], dict[int, float]]:
    """Points of containers, of all elements the characters and those inside links, and the points that text alone gave.

    Children have greater numbers than their parents, so one pass from the last element to the first carries everything upward.
    """
    count = len(page.tags)
    lowered = [False] * count
    for e in range(1, count if doubtful else 0):
        lowered[e] = e in doubtful or lowered[page.above[e]]
    sizes, links = [0] * count, [0] * count
    carried: dict[int, list[float]] = {}  # by element, the points that arrive there by how many containers they have passed
    for element, text, linked in page.blocks:
        sizes[element] += len(text)
        links[element] += linked
        carried.setdefault(element, [0.0] * len(_DIVIDED))[0] += 1 + sum(map(text.count, ",،、，")) + min(len(text) / 100, 3.0)
    final, earned = {}, {}
    for e in range(count - 1, 0, -1):
        levels = carried.pop(e, None)
        if levels is None:
            continue
        if page.tags[e] in _CONTAINERS:
            part = (1 - links[e] / sizes[e]) / (_DOUBT if lowered[e] else 1)
            first = _FIRST_SCORE.get(page.tags[e], 0.0) + (25.0 if _LIKELY_NAME.search(page.names[e]) else 0.0)
            points = sum(x / d for x, d in zip(levels, _DIVIDED, strict=True))
            final[e], earned[e] = (first + points) * part, points * part
            levels = [0.0, *levels[:-2], levels[-2] + levels[-1]]
        parent = page.parents[e]
        if lowered[e] and not lowered[parent]:
            continue  # what is doubtful passes nothing on
        sizes[parent] += sizes[e]
        links[parent] += links[e]
        there = carried.get(parent)
        carried[parent] = levels if there is None else [x + y for x, y in zip(there, levels, strict=True)]
    return final, sizes, links, earned


def chosen(page: Page) -> set[int]:
    """The elements whose text is the main text; the page itself if there is no container."""
    final, sizes, links, earned = scored(page)
    if not final:
        return {0}
    best = top = max(final, key=lambda e: (final[e], -e))
    e, marked = best, False
    while e > 0:
        if page.tags[e] in ("article", "main"):
            top, marked = e, True
        e = page.parents[e]
    keep = {top}
    points = earned if marked else final
    enough = points.get(top, 0.0) / _SIBLING
    for e in range(1, len(page.tags)):
        if page.parents[e] == page.parents[top] and e != top and sizes[e]:
            density = links[e] / sizes[e]
            reads = not marked and page.tags[e] == "p" and (density == 0 or (sizes[e] > 80 and density < 0.25))
            if reads or (points.get(e, 0.0) >= enough and (not marked or page.tags[e] in ("article", "main"))):
                keep.add(e)
    return keep


def main_text(source: str | None) -> str:
    """The main text: blocks in page order, one per line."""
    page = Page(source or "")
    if page.doubtful and (left := doubts(page)):
        page = Page(source or "", left)
    if not page.blocks:
        return ""
    keep = chosen(page)
    inside = [0 in keep]  # parents come before their children
    for e in range(1, len(page.tags)):
        inside.append(inside[page.parents[e]] or e in keep)
    return "\n".join(text for element, text, _ in page.blocks if inside[element])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, its code points, of every page."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column(2)]
            lengths = pa.array(map(len, found), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")
