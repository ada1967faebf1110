"""Operator 3, HTML extraction by text-to-tag ratio.

A page's parser events stream through ``_Events`` (the standard library's
parser), which cuts the text into lines at block elements and counts each
line's tags.  A line's text-to-tag ratio is its characters a tag; the page's
ratios are smoothed by a Gaussian and split in two clusters at the threshold
that two-means finds, so that the high cluster is content.  The content region
is the ``article`` or ``main`` element, or else the smallest other element,
that has most of the clustered content; its lines are the main text, short
ones and headings too (outside ``article`` and ``main``, lines before or after
the content cluster go from the first one on that is mostly links).  Menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out by element, role and
class name, also inside the region.  A class name marks an element only if it
isn't the wrapper of the article: ``_marked`` decides that when the whole page
has been read.

Defined results: null, empty or text-free html gives an empty text; broken
markup is read as browsers do (unclosed elements end with their parent, stray
end tags are ignored); repeated rows have one result each; empty input gives
an empty result.  Only the named columns are read, so others may have any
name."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul").split())
SKIP = frozenset((
    "script style noscript template head title nav footer aside form iframe object svg math canvas button select "
    "textarea input dialog menu").split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id names, split at anything but letters, that mark what isn't the article.
SKIP_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer masthead topbar "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended comment comments commentlist disqus replies reply respond "
    "pagination pager skip").split())
CONTAINERS = frozenset("article main section div td body".split())
#: Elements that an open paragraph or list item doesn't reach beyond.
WITHIN = {"p": frozenset("div article section main td body".split()), "li": frozenset("ul ol menu".split())}
#: A paragraph that is still open ends where one of these begins.
ENDS_P = BLOCK - {"br", "body", "html", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
LINKED = 0.5  # share of a line in links from which it is a link line


class _Events(HTMLParser):
    """Collects lines: [texts, tags, container, left out, characters in links,
    innermost element with a marking name]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # element, begins a part to leave out, container and named element before it
        self.places: dict[str, list[int]] = {"p": [], "li": []}  # where they stand in the stack
        self.within: dict[str, list[int]] = {"p": [], "li": []}  # where elements stand that they don't reach beyond
        self.open: Counter = Counter()
        self.named = 0
        self.names = [-1]  # parents of the elements with a marking name
        self.heads: list[tuple[str, int]] = []  # main, article, h1 and the named element around each
        self.noise = 0
        self.main = 0
        self.links = 0
        self.box = 0
        self.boxes: list[tuple[str, int]] = [("", -1)]  # element, parent
        self.lines: list[list] = []
        self.break_line()

    def updatepos(self, i: int, j: int) -> int:
        return j  # no line numbers are needed

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def break_line(self) -> None:
        if self.lines and not self.lines[-1][0]:
            self.lines[-1][2:4] = [self.box, self.noise > 0]
            self.lines[-1][5] = self.named
        else:
            self.lines.append([[], 0, self.box, self.noise > 0, 0, self.named])

    def skipped(self, tag: str, attrs) -> bool:
        if tag in SKIP or (tag == "header" and not self.main):
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        for k, v in attrs:
            if (k == "role" and v and v.lower() in SKIP_ROLES) or k == "hidden" or (k == "aria-hidden" and v == "true"):
                return True
        return False

    def has_name(self, tag: str, attrs) -> bool:
        return tag not in ("html", "body", "article", "main") and any(
            k in ("class", "id") and v and not SKIP_WORDS.isdisjoint(re.split(r"[^a-z]+", v.lower())) for k, v in attrs)

    def handle_starttag(self, tag, attrs) -> None:
        if tag in ENDS_P and self.has_open("p"):
            self.close_to("p")
        if tag == "li" and self.has_open("li"):
            self.close_to("li")
        if tag in BLOCK and tag != "br":
            self.break_line()
        self.lines[-1][1] += 1
        if tag == "br":
            self.lines[-1][0].append(" ")
        if tag in VOID:
            return
        skip = self.skipped(tag, attrs)
        named = not skip and self.has_name(tag, attrs)
        for kind in WITHIN:
            if tag == kind:
                self.places[kind].append(len(self.stack))
            elif tag in WITHIN[kind]:
                self.within[kind].append(len(self.stack))
        self.open[tag] += 1
        self.stack.append((tag, skip, self.box, self.named))
        self.noise += skip
        if named:
            self.names.append(self.named)
            self.named = len(self.names) - 1
        if tag in ("main", "article", "h1") and not self.noise:
            self.heads.append((tag, self.named))
        self.main += tag in ("article", "main")
        self.links += tag == "a"
        if tag in CONTAINERS:
            self.boxes.append((tag, self.box))
            self.box = len(self.boxes) - 1
        if skip or named or tag in CONTAINERS:
            self.break_line()

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in CONTAINERS and tag not in SKIP:
            self.handle_endtag(tag)

    def has_open(self, tag: str) -> bool:
        """Whether ``tag`` is open above the nearest element of ``WITHIN``."""
        own, around = self.places[tag], self.within[tag]
        return bool(own) and (not around or own[-1] > around[-1])

    def close_to(self, tag: str) -> None:
        while self.stack:
            name, skip, box, named = self.stack.pop()
            self.open[name] -= 1
            for kind in WITHIN:
                for at in (self.places[kind], self.within[kind]):
                    if at and at[-1] == len(self.stack):
                        at.pop()
            self.noise -= skip
            self.main -= name in ("article", "main")
            self.links -= name == "a"
            self.box = box
            left, self.named = self.named != named, named
            if skip or left or name in CONTAINERS or name in BLOCK:
                self.break_line()
            if name == tag:
                return

    def handle_endtag(self, tag) -> None:
        self.lines[-1][1] += 1
        if self.open[tag]:
            self.close_to(tag)

    def read(self, html: str) -> None:
        """The whole page.  Behind the last ``>`` no tag can end, so that rest
        is text at once; the parser would look for an end at each ``<``."""
        end = html.rfind(">") + 1
        self.feed(html[:end])
        self.close()
        if end < len(html):
            self.handle_data(unescape(html[end:]))

    def handle_data(self, data) -> None:
        self.lines[-1][0].append(data)
        if self.links:
            self.lines[-1][4] += len(data.strip())


def _smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = min(int(3 * sigma + 0.5), (len(ratio) - 1) // 2)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "same")
    return np.convolve(ratio, kernel, "same") / weight


def _threshold(x: np.ndarray) -> float:
    """The midpoint of the two means that split ``x`` (0 if all are equal)."""
    cut = (x.min() + x.max()) / 2
    for _ in range(50):
        low, high = x[x <= cut], x[x > cut]
        if not len(low) or not len(high):
            return 0.0
        new = (low.mean() + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return float(cut)


def _clustered(ratio: np.ndarray, noise: np.ndarray, sigma: float) -> np.ndarray:
    smooth = _smooth(np.where(noise, 0.0, ratio), sigma)
    content = (smooth > _threshold(smooth)) & ~noise
    return content if content.any() else ~noise


def _marked(page: _Events, named: list[int], mass: np.ndarray, most: float) -> set[int]:
    """The named elements that are left out.  One is kept as a wrapper if it
    holds the page's main element or first article or headline, and no unmarked
    text of half its mass is outside; where these are outside all named ones,
    it must have ``most`` of the text that isn't links, no ``main`` or ``article`` must be outside,
    and not more than a tenth of the text."""
    parent, n = page.names, len(page.names)
    inside = np.bincount(named, weights=mass, minlength=n)  # an element's number is above its parent's
    own = inside.copy()
    for e in range(n - 1, 0, -1):
        inside[parent[e]] += inside[e]
    head = min(page.heads, key=lambda h: h[0] != "main", default=("", 0))
    around = set()
    at = head[1]
    while at > 0:
        around.add(at)
        at = parent[at]
    marked = np.r_[False, np.ones(n - 1, bool)]
    free = ~marked  # neither an element nor one around it is marked
    outside = own[0]  # text without a mark; an element that is still marked has none of it
    for e in sorted(range(1, n), key=lambda e: (-inside[e], e)):  # parents come before their children
        if e in around:
            wrapper = 2 * outside <= inside[e]
        else:
            wrapper = (not head[1] and head[0] in ("", "h1") and inside[e] >= most * mass.sum() > 0
                       and outside <= 0.1 * mass.sum())
        if wrapper:
            marked[e] = False
            if free[parent[e]]:
                free[e] = True
                outside += own[e]
    for e in range(1, n):
        marked[e] |= marked[parent[e]]
    return set(np.flatnonzero(marked).tolist())


def extract(html: str | None, sigma: float = 1.0, most: float = 0.5) -> str:
    """The main text of one page; ``most``: the share of the clustered content
    that the chosen container must have."""
    if not html:
        return ""
    page = _Events()
    page.read(html)
    lines = []
    named = []
    for texts, tags, box, noise, linked, name in page.lines:
        text = " ".join("".join(texts).split())
        if text:
            lines.append((text, len(text) / (tags + 1), box, noise, linked > LINKED * len(text)))
            named.append(name)
    if not any(not x[3] for x in lines):
        return ""
    size, ratio = np.array([len(x[0]) for x in lines]), np.array([x[1] for x in lines])
    if any(named):
        plain = np.array([not x[3] and not x[4] for x in lines])  # a long comment would put the article in the low cluster
        gone = _marked(page, named, size * plain, most)
        lines = [(*x[:3], x[3] or n in gone, x[4]) for x, n in zip(lines, named)]
        if all(x[3] for x in lines):
            return ""
    content = _clustered(ratio, np.array([x[3] for x in lines]), sigma)
    mass = size * content
    held = np.zeros(len(page.boxes))  # clustered content in each container, with what is nested in it
    for k, x in enumerate(lines):
        held[x[2]] += mass[k]
    for b in range(len(held) - 1, 0, -1):  # a container's number is above its parent's
        held[page.boxes[b][1]] += held[b]
    names = [b[0] for b in page.boxes]
    enough = [b for b in range(1, len(names)) if held[b] >= most * mass.sum()]
    chosen = max((b for b in enough if names[b] in ("article", "main")), default=None)
    first, last = 0, len(lines)
    if chosen is None:
        whole = [b for b in range(1, len(names)) if held[b] >= 0.9 * mass.sum() and names[b] != "body"]
        chosen = max(whole, default=0)  # the innermost
        at = np.flatnonzero(content)
        first, last = int(at[0]), int(at[-1]) + 1
        while first > 0 and not lines[first - 1][4]:
            first -= 1
        while last < len(lines) and not lines[last][4]:
            last += 1

    article = names[chosen] == "article"
    inside = [chosen == 0]  # in the chosen container, or in a sister article
    for b in range(1, len(names)):
        sister = article and names[b] == "article" and page.boxes[b][1] == page.boxes[chosen][1]
        inside.append(chosen == 0 or b == chosen or sister or inside[page.boxes[b][1]])
    return " ".join(x[0] for k, x in enumerate(lines)
                    if not x[3] and first <= k < last and inside[x[2]])


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return text_batches(rows).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
