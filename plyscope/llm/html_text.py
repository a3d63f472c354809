"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clusters.

The standard library's streaming parser turns a page into lines, one per block, each with its
characters, its tags and the containers it lies in. The text-to-tag ratios are smoothed by a
Gaussian along the page and split by a two-means threshold; articles that hold nearly all text
above the threshold, or else the innermost container that does, with the containers around it
that add headings or more such text, are the content region, and its lines are the text.
What elements say of themselves (navigation, forms, notices, comments) is left out first, by
their tag, role, class or id, unless the element holds most of the page's text: whole pages lie
in forms. Scripts, styles, controls and hidden elements are never text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import table

#: Never text, whatever they hold.
SKIPPED = frozenset(
    "head title script style noscript template nav footer button select option textarea iframe object svg canvas dialog menu "
    "audio video map datalist".split()
)
#: Frames of a page, unless they hold most of its text and no article lies outside them.
FRAMES = frozenset("header aside form label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 "
    "h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body main article section div td table center".split())
#: An open element of the key ends when one of its set begins.
IMPLIED = {
    "p": BLOCKS - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
    "label": BLOCKS - {"br"},
    "head": frozenset({"body", "main", "article", "div", "p", "h1", "nav", "section"}),
}
_WORDS = (
    r"(?:ads?|adverts?|advertisement|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|nav|navbar|"
    r"navigation|menu|breadcrumbs?|toolbar|sidebar|side|widget|footer|foot|header|masthead|cookies?|consent|gdpr|notice|"
    r"alert|popup|modal|overlay|newsletter|subscribe|signup|login|comments?|disqus|replies|reply|respond|"
    r"related|recommend(?:ed|ations)?|share|sharing|social|pagination|pager|copyright|legal|skip-link)"
)
_NEUTRAL = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|mobile|list|links?|area|box|bar|block|items?)"
#: A class or id, whole, that is made of hint words and words that say nothing of their own.
HINTS = re.compile(rf"(?:{_NEUTRAL}[_-])*{_WORDS}(?:[_-](?:{_WORDS}|{_NEUTRAL}))*", re.IGNORECASE)
THREADS = re.compile(r"comments?|disqus|replies|reply|respond", re.IGNORECASE)
UNHINTED = frozenset("html body main article".split())
#: A hint does not hold for an element with more than this share of the page's unlinked text; for a thread of comments, nearly all.
MOST, NEARLY_ALL = 0.5, 0.9
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Roles of what is never text, and of frames.
MENU_ROLES = frozenset("navigation search menu menubar toolbar contentinfo".split())
FRAME_ROLES = frozenset("banner complementary form alert alertdialog dialog note".split())
SPACES = re.compile(r"\s+")
#: Looked for from a comment's own dashes, which may end it as well; what may begin a tag.
COMMENT_END = re.compile(r"--!?>")
TAG_START = re.compile(r"<(?=[a-zA-Z/!?])")


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    inside: int  # the innermost container, 0 for none
    heading: bool = False


@dataclass
class Open:
    """An open element: innermost container, innermost frame, whether it is skipped from here on,
    never text, within an article, within a heading."""

    tag: str
    held: int
    frame: int
    out: bool
    hard: bool
    article: bool
    heading: bool


class PageLines(HTMLParser):
    """Collects the lines of one page; `spared` frames do not count as such."""

    def __init__(self, spared: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.spared = spared
        self.loose = 0
        #: By frame: unlinked characters, whether it is a thread, and the frame around it.
        self.frames: dict[int, list] = {0: [0, False, 0]}
        self.plain: set[int] = set()  # frames by tag or role
        self.told = 0  # unlinked characters of articles outside all frames
        self.kind: dict[int, str] = {0: ""}
        self.around: dict[int, int] = {0: 0}
        self.cut_off = False
        self._started = 0
        self._count: Counter[str] = Counter()
        self._text: list[str] = []
        self._tags = self._linked = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections that HTML does not have are comments up to the next `>`, as in browsers."""
        return self.parse_bogus_comment(i)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment that never ends takes the rest of the page with it, as in browsers."""
        end = COMMENT_END.search(self.rawdata, i + 2)
        self.cut_off = not end
        return end.end() if end else len(self.rawdata)

    def read(self, html: str) -> list[Line]:
        """The lines of a whole page. A tag that is cut off at its end is no text; it is not
        given to the parser, which would look for its end from each of its characters."""
        whole = html.rfind(">") + 1
        self.feed(html[:whole])
        self.close()
        if not (self.cdata_elem or self.cut_off) and (text := TAG_START.split(html[whole:], maxsplit=1)[0]):
            self.handle_data(unescape(text))
        self._end_line()
        return self.lines

    def _top(self) -> Open:
        return self.open[-1] if self.open else Open("", 0, 0, False, False, False, False)

    def _end_line(self) -> None:
        text = SPACES.sub(" ", "".join(self._text)).strip()
        if text:
            self.lines.append(Line(text, self._tags, self._linked, self._top().held, self._top().heading))
            self._tags = 0
        self._text, self._linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.open and tag in IMPLIED.get(self.open[-1].tag, ()):
            self._close(len(self.open) - 1)
        if tag in BLOCKS:
            self._unwind_inline(tag)
            self._end_line()
        self._tags += 1
        if tag in VOID:
            return
        self._started += 1
        a, top = dict(attrs), self._top()
        said = f"{a.get('class') or ''} {a.get('id') or ''}".split()
        names = [] if tag in UNHINTED else [x for x in said if HINTS.fullmatch(x)]
        role = (a.get("role") or "").lower()
        framed = tag in FRAMES and not (top.article and tag == "header") or role in FRAME_ROLES  # an article's header is its own
        frame = top.frame
        if names or framed:
            frame = self._started
            self.frames[frame] = [0, any(THREADS.search(x) for x in names), top.frame]
            if framed:
                self.plain.add(frame)
        hard = (
            top.hard
            or tag in SKIPPED
            or role in MENU_ROLES
            or "hidden" in a
            or (a.get("aria-hidden") or "").lower() == "true"
            or "display:none" in (a.get("style") or "").replace(" ", "").lower()
        )
        out = top.out or hard or (frame != top.frame and frame not in self.spared)
        held = top.held
        if tag in CONTAINERS:
            held = len(self.kind)
            self.kind[held], self.around[held] = tag, top.held
        if out and not top.out and tag in BLOCKS:
            self._end_line()
        self._count[tag] += 1
        self.open.append(Open(tag, held, frame, out, hard, top.article or tag in ("article", "main"), top.heading or tag in HEADINGS))

    def _unwind_inline(self, tag: str) -> None:
        """A block inside an unclosed paragraph ends the paragraph, past any open inline tags."""
        if tag == "br" or not (self._count["p"] or self._count["label"]):
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i].tag
            if name in ("p", "label"):
                self._close(i)
                return
            if name in BLOCKS or name in SKIPPED:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        self._tags += 1
        if not self._count[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return

    def _close(self, i: int) -> None:
        if any(o.tag in BLOCKS for o in self.open[i:]):
            self._end_line()
        self._count.subtract(o.tag for o in self.open[i:])
        del self.open[i:]

    def handle_data(self, data: str) -> None:
        top = self._top()
        if top.hard:
            return
        linked = self._count["a"] > 0
        if not linked:
            n = len(data.strip())
            self.loose += n
            self.frames[top.frame][0] += n
            self.told += n if top.article and not top.frame else 0
        if top.out:
            return
        self._text.append(data)
        if linked:
            self._linked += len(data.strip())

    def overruled(self) -> frozenset[int]:
        """Frames that hold so much of the page's text that they are no mere frames."""
        held = {i: n for i, (n, _, _) in self.frames.items()}
        for i in sorted(self.frames, reverse=True):  # a frame inside another has the larger number
            if i:
                held[self.frames[i][2]] += held[i]
        large = (i for i, (_, thread, _) in self.frames.items() if i and held[i] > (NEARLY_ALL if thread else MOST) * self.loose)
        return frozenset(i for i in large if not (self.told and i in self.plain))

def smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    g = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(x, g)[reach : reach + len(x)]
    return total / np.convolve(np.ones(len(x)), g)[reach : reach + len(x)]


def threshold(x: np.ndarray) -> float:
    """Where two-means splits the values; below all of them if they are one cluster."""
    low, high = float(x.min()), float(x.max())
    for _ in range(50):
        cut = (low + high) / 2
        a, b = x[x <= cut], x[x > cut]
        if not len(a) or not len(b):
            return low - 1
        if (a.mean(), b.mean()) == (low, high):
            break
        low, high = float(a.mean()), float(b.mean())
    return (low + high) / 2


def main_text(html: str | None, sigma: float = 2.0, cover: float = 0.9) -> str:
    """The lines of the content region joined by one space; empty for a null or empty page."""
    parser = PageLines()
    lines = parser.read(html or "")
    if spared := parser.overruled():
        parser = PageLines(spared)
        lines = parser.read(html or "")
    if not lines:
        return ""
    size = np.array([len(l.text) for l in lines], dtype=np.float64)
    loose = size - np.minimum([l.linked for l in lines], size)
    ratio = loose / np.maximum([l.tags for l in lines], 1)
    level = smooth(ratio, sigma)
    core = (level > threshold(level)) | (ratio > threshold(ratio))
    weight = np.where(core, loose, 0)
    if not weight.sum():
        weight = size
    inside = np.array([l.inside for l in lines])
    around = np.array([parser.around[c] for c in range(len(parser.kind))])
    held = totals(weight, inside, around)
    # articles side by side are one region if they cover the core, otherwise a container that does
    marked = within([c for c, tag in parser.kind.items() if tag in ("article", "main") and held[c] > 0], around)
    covered = weight[marked[inside]].sum()
    if marked.any() and covered >= cover * weight.sum():
        kept = marked[inside]
        _title_before(kept, lines)
        return " ".join(l.text for l, k in zip(lines, kept, strict=True) if k)
    whole = np.flatnonzero(held[1:] >= cover * weight.sum()) + 1
    heading = np.array([l.heading for l in lines])
    region = _climbed(int(whole.max()), around, *(totals(x, inside, around) for x in (core | heading, loose, size))) if len(whole) else 0
    kept = within([region], around)[inside]
    # inside a region of its own nothing is left out; of a whole page, what lies outside its flow is
    if parser.kind[region] in ("", "html", "body"):
        kept &= _flow(lines, weight, inside, len(around))
    return " ".join(l.text for l, k in zip(lines, kept, strict=True) if k)


def totals(values: np.ndarray, inside: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Sums of the lines' values by container, those of inner containers included."""
    out = np.bincount(inside, weights=values, minlength=len(around))
    for c in range(len(around) - 1, 0, -1):  # an inner container has the larger number
        out[around[c]] += out[c]
    return out


def within(regions: list[int], around: np.ndarray) -> np.ndarray:
    """For each container whether it is one of `regions` or lies in one."""
    out = np.zeros(len(around), dtype=bool)
    out[regions] = True
    for c in range(1, len(around)):
        out[c] |= out[around[c]]
    return out


def _climbed(region: int, around: np.ndarray, told: np.ndarray, loose: np.ndarray, size: np.ndarray) -> int:
    """The region, or the container around it while that adds headings or core lines and is not
    mostly links."""
    outer = region
    while outer:
        outer = around[outer]
        added = size[outer] - size[region]
        if outer and told[outer] > told[region] and loose[outer] - loose[region] >= 0.5 * added:
            region = outer
    return region


def _title_before(kept: np.ndarray, lines: list[Line]) -> None:
    """Adds the headings that stand right before the first kept line."""
    first = int(kept.argmax())
    while first and lines[first - 1].heading and not lines[first - 1].linked:
        first -= 1
        kept[first] = True


def _flow(lines: list[Line], weight: np.ndarray, inside: np.ndarray, containers: int, run: int = 3) -> np.ndarray:
    """Lines from the first to the last of the core, with headings right before, and those that
    share their innermost container with core lines; outside that stretch, runs of `run` lines
    or more that are nothing but links are menus.

    Where some containers directly hold most of the core, a tenth of it each, a core line in
    another one does not begin or end the stretch.
    """
    own = np.bincount(inside, weights=weight, minlength=containers)
    told = own >= 0.1 * own.sum()
    if own[told].sum() < 0.5 * own.sum():
        told = own > 0
    places = np.flatnonzero((weight > 0) & told[inside])
    if not len(places):
        return np.ones(len(lines), dtype=bool)
    kept = told[inside]
    links = np.array([l.linked > 0 and l.linked >= len(l.text.replace(" ", "")) for l in lines])
    for group in np.split(np.arange(len(lines)), np.flatnonzero(np.diff(links)) + 1):
        if links[group[0]] and len(group) >= run:
            kept[group] = False
    kept[places[0] : places[-1] + 1] = True
    _title_before(kept, lines)
    return kept


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows with `text` and `n_chars` (its code points) added; columns of those names are
    replaced. A null, empty or text-less page has an empty text. Repeated rows are kept."""

    @F.arrow_udf("string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([main_text(h) for h in column.to_pylist()], pa.string())

    return pages.withColumn("text", run(F.col(html).cast("string"))).withColumn("n_chars", F.length("text").cast("long"))


def op7_text_to_tag_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
