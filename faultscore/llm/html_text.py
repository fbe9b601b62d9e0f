"""Operator 9: main text of web pages.

The standard library's parser streams events; they are gathered into lines
(one per block element).  Every line has a text-to-tag ratio (characters
outside links for each tag).  The ratios are smoothed with a Gaussian over
the neighbouring lines and split by two-means clustering; the regions
(nearest article, main, section or division) with a line in the upper cluster
are content.  Every article of a page is, but for those that are mostly links.
Without an article, headings before the content, and blocks of prose without
links behind its beginning that stand beside it, belong to it.  A form drops
its text, but no article or main element inside; where forms hold more text in
paragraphs than the rest of the page, as on sites that wrap pages in one form,
only their fields go.  Elements that are boilerplate by their tag, role, class or id
never are.  A class or id of several parts names boilerplate only if all its
parts are words of boilerplate or of layout, and never an article or main
element inside.  In an article only whole classes do, and ids nowhere in it; on
a heading an id never does.  Where classes and ids leave nothing of a page,
they are not looked at.  A region is taken whole, so its short lines stay.

Defined results: a null or empty page gives an empty text and 0 characters;
broken markup is read as far as the parser gets, without an error; very
long pages are read whole, in time by their length; repeated rows give a row
each; ties of ratios all count as content; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text, pick

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
REGIONS = frozenset("article main section div body td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside script style noscript template head title svg iframe object canvas button select textarea menu dialog audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words of class and id that name boilerplate; the second set only outside an article and main.
DROPPED_NAMES = re.compile(
    r"^(ads?|advert\w*|adsense|adslot|banner\w*|sponsor\w*|promo\w*|cookies?|cookiebar|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|subscription|social|share|sharing|related|recommend\w*|sidebar\d?|rail|menus?|nav|navbar|navigation|breadcrumbs?|footer|comments?|commentlist|disqus|respond|repl(?:y|ies)|widgets?|login|signup|search|searchbox|pagination|pager|copyright|disclaimer|toolbar|outbrain|taboola)$"
)
HEADER_NAMES = re.compile(r"^(header|masthead|topbar|site-?title|tagline)$")
#: Words beside them in a name of several parts.
LAYOUT_WORDS = re.compile(r"^(site|page|global|main|primary|secondary|top|bottom|left|right|upper|lower|sticky|fixed|inner|outer|container|wrapper|wrap|box|bar|area|block|panel|section|slot|unit|list|items?|links?|posts?|articles?|stories|buttons?|icons?|media|form|inline|\d+)$")
#: What else goes where the text of forms stays.
FIELDS = frozenset("label legend".split())
#: Words in the heading of a list of links that is no part of the article.
LINK_LISTS = frozenset("more read also popular latest next previous tags topics stories links trending".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | {"p", "blockquote", "pre"}
#: Share of link characters over which text is a list of links.
LINKED = 0.5
SIGMA, REACH = 1.0, 3
MAIN = -1
#: How an element is dropped: by parts of a name (articles and main elements in it are not), or for good.
BY_PARTS, WHOLLY = 1, 2


def _in_parts(name: str, words) -> bool:
    parts = [x for x in re.split(r"[-_]+", name) if x]
    named = [any(w.match(x) for w in words) for x in parts]
    return any(named) and all(n or LAYOUT_WORDS.match(x) for n, x in zip(named, parts))


class PageLines(HTMLParser):
    """Lines of a page: [text, link characters, tags, region, place, block],
    where place is the number of the outermost article, MAIN, or 0, and block
    the tag of the block element."""

    def __init__(self, names: bool = True, forms: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.names = names  # classes and ids count
        self.forms = forms  # forms drop their text
        self.lines: list[list] = []
        self.open: list[tuple[str, int, int, int, str]] = []  # tag, dropped, region, place, block
        self.regions = self.articles = 1
        self.outer = {0: -1}  # region around a region
        self.text: list[str] = []
        self.links = self.tags = self.anchors = self.in_forms = self.form_text = 0

    def _top(self) -> tuple[str, int, int, int, str]:
        return self.open[-1] if self.open else ("", 0, 0, 0, "")

    def _flush(self) -> None:
        _, dropped, region, place, block = self._top()
        text = " ".join("".join(self.text).split())
        if text and not dropped:
            self.lines.append([text, self.links, self.tags, region, place, block])
        self.text.clear()
        self.links = self.tags = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            if tag != "p" or self.text:
                self._flush()
            if self.open and self.open[-1][0] == "p":
                self.open.pop()
            elif any(x[0] == "p" for x in self.open[-6:]):
                self._close("p")
        elif tag in ("br", "td", "th", "option"):
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        self.anchors += tag == "a"
        self.in_forms += tag == "form"
        _, dropped, region, place, block = self._top()
        if tag in REGIONS:
            self.outer[self.regions] = region
            region, self.regions = self.regions, self.regions + 1
        if tag == "article" and place <= 0:
            place, self.articles = self.articles, self.articles + 1
        elif tag == "main" and not place:
            place = MAIN
        if tag in ("article", "main") and dropped == BY_PARTS:
            dropped = 0
        self.open.append((tag, max(dropped, self._boilerplate(tag, dict(attrs), place)), region, place, tag if tag in BLOCKS else block))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in self.CDATA_CONTENT_ELEMENTS:
            self.handle_endtag(tag)

    def _boilerplate(self, tag: str, attrs: dict, place: int) -> int:
        if tag in DROPPED or (tag == "header" and not place):
            return WHOLLY
        if tag == "form":
            return BY_PARTS if self.forms else 0
        if tag in FIELDS and not self.forms:
            return WHOLLY
        if tag in ("html", "body", "main"):
            return 0
        if (attrs.get("role") or "").lower() in DROPPED_ROLES or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
            return WHOLLY
        if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return WHOLLY
        if not self.names:
            return 0
        names = (attrs.get("class") or "").lower().split()
        if place <= 0 and tag not in HEADINGS:
            names += (attrs.get("id") or "").lower().split()
        words = (DROPPED_NAMES,) if place else (DROPPED_NAMES, HEADER_NAMES)
        if any(w.match(x) for x in names for w in words):
            return WHOLLY
        return BY_PARTS if place <= 0 and any(_in_parts(x, words) for x in names) else 0

    def _close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                for x in self.open[i:]:
                    self.anchors -= x[0] == "a"
                    self.in_forms -= x[0] == "form"
                del self.open[i:]
                return
            if tag not in BLOCKS and self.open[i][0] in BLOCKS:
                return  # an inline end tag never closes a block

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
        self.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        _, dropped, _, _, block = self._top()
        if not dropped:
            self.text.append(data)
            if self.anchors:
                self.links += len(data)
        elif dropped == BY_PARTS and self.in_forms and block == "p":
            self.form_text += len(data.strip())


def _parsed(html: str, names: bool, forms: bool) -> PageLines:
    parser = PageLines(names, forms)
    try:
        parser.feed(html)
        parser.close()
    except (AssertionError, ValueError, IndexError):  # marked sections the parser does not know
        parser = PageLines(names, forms)
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    parser._flush()
    return parser


def page_lines(html: str, names: bool = True) -> tuple[list[list], dict[int, int]]:
    """(lines, region around each region) of a page."""
    parser = _parsed(html, names, True)
    if parser.form_text > sum(len(x[0]) for x in parser.lines):
        parser = _parsed(html, names, False)
    if names and not parser.lines:
        return page_lines(html, False)
    return parser.lines, parser.outer


def smoothed_ratios(lines: list[list]) -> list[float]:
    """Text-to-tag ratios on a log scale, Gaussian-smoothed over lines."""
    raw = [math.log1p(max(0, len(x[0]) - x[1]) / max(1, x[2])) for x in lines]
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(REACH + 1)]
    out = []
    for i in range(len(raw)):
        lo, hi = max(0, i - REACH), min(len(raw), i + REACH + 1)
        out.append(sum(raw[j] * kernel[abs(i - j)] for j in range(lo, hi)) / sum(kernel[abs(i - j)] for j in range(lo, hi)))
    return out


def threshold(values: list[float]) -> float:
    """Half-way between two clusters' means (two-means); the least value if all are one cluster."""
    lo, hi = min(values), max(values)
    if hi - lo < 0.5:
        return lo
    for _ in range(32):
        cut = (lo + hi) / 2
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        new = (sum(low) / len(low) if low else lo, sum(high) / len(high) if high else hi)
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2


def _link_lists(lines: list[list], pool: list[int], of: int) -> set[int]:
    """The values of column ``of`` whose lines are mostly links, added up once."""
    sums: dict[int, list[int]] = {}
    for i in pool:
        total = sums.setdefault(lines[i][of], [0, 0])
        total[0] += lines[i][1]
        total[1] += len(lines[i][0])
    return {k for k, (links, size) in sums.items() if links > size * LINKED}


def _names_links(heading: str) -> bool:
    words = re.findall(r"\w+", heading.lower())
    return any(w in LINK_LISTS or DROPPED_NAMES.match(w) for w in words)


def _of_articles(lines: list[list], pool: list[int], upper: list[int]) -> list[int]:
    """Articles whole, but for those that are lists of links, and for lists of
    links in them unless a heading of their own makes them a part (sources)."""
    places, regions = {lines[i][4] for i in upper}, {lines[i][3] for i in upper}
    places |= {lines[i][4] for i in pool} - _link_lists(lines, pool, 4)
    linked = _link_lists(lines, pool, 3) - regions
    seen: set[int] = set()
    for i in pool:
        text, links, _, region, _, block = lines[i]
        if region in linked and region not in seen and block in HEADINGS and not links and not _names_links(text):
            linked.discard(region)
        seen.add(region)
    return [i for i in pool if lines[i][4] in places and lines[i][3] not in linked]


def _of_regions(lines: list[list], upper: list[int], outer: dict[int, int]) -> list[int]:
    """The regions of the upper lines, with the prose that stands beside them."""
    regions = {lines[i][3] for i in upper}
    beside = {outer[r] for r in regions}
    first = next(i for i, x in enumerate(lines) if x[3] in regions)
    other: set[int] = set()  # regions with a line that is no prose
    for i, (_, links, _, region, _, block) in enumerate(lines):
        if links or block not in (HEADINGS if i < first else PROSE):
            other.add(region)
    return [i for i, x in enumerate(lines) if x[3] in regions or (x[3] not in other and outer[x[3]] in beside)]


def main_text(html: str | None) -> str:
    """Blocks of the content regions in page order, joined by a line break."""
    lines, outer = page_lines(html) if html else ([], {})
    if not lines:
        return ""
    ratios = smoothed_ratios(lines)
    cut = threshold(ratios)
    # Lines of articles, else of the main element, else of the whole page.
    pool = [i for i, x in enumerate(lines) if x[4] > 0] or [i for i, x in enumerate(lines) if x[4] == MAIN] or list(range(len(lines)))
    upper = [i for i in pool if ratios[i] >= cut] or [max(pool, key=lambda i: ratios[i])]
    keep = _of_articles(lines, pool, upper) if lines[pool[0]][4] else _of_regions(lines, upper, outer)
    return "\n".join(lines[i][0] for i in keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    rows = pick(pages, page_id="page_id", url="url", html="html")

    def texts(pages: list) -> tuple[list, list]:
        found = [main_text(h) for h in pages]
        return found, [len(t) for t in found]

    return map_text(rows, "html", [("text", "string", pa.string()), ("n_chars", "long", pa.int64())], lambda: texts, ["page_id", "url"])


def q_extract(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
