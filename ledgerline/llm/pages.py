"""Main text of web pages by the distribution of line blocks.

Markup is stripped first. Block elements make lines; regions that are never main
text (navigation, page headers, footers, sidebars, forms, scripts, styles, and
what is named as an advert, notice or comment list) leave one empty line each.
Then the lengths of text outside links are summed over windows of ``WINDOW`` lines.
A surge point is where the sum rises to ``SURGE``, the dive point after it where it
falls below ``DIVE``; text between them stays, with the headings right before it.
Where a page says which part is the article (``article``, ``main``), that part's
edges are its surge and dive points. Blocks come in page order, each with its white space as single
spaces and its character references decoded.

Of several regions those of at least ``SHARE`` of the largest one's text stay; a page
whose windows never reach ``SURGE`` keeps all its lines. Names in ``class`` or ``id``
drop a region only if no article begins inside and other text is left. Nothing else
is dropped and no text is cut. Pages are apart from each other: nothing is shuffled.

Defined cases: null and empty pages, and pages without text, give an empty text;
text without any markup is one block; unclosed elements end where their container
does, an unclosed script or comment ends with the page; very long pages are one
row of one task; repeated rows, null ids and null urls are passed through; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import query, table

WINDOW = 3
SURGE, DIVE = 120, 30
SHARE = 0.25
BATCH_BYTES = 8 << 20

# Elements of HTML by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = BLOCKS - frozenset("h1 h2 h3 h4 h5 h6 hr p li dt dd".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_TEXT = frozenset(
    "aside button canvas datalist dialog footer head map menu nav noscript object select svg template".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LANDMARKS = frozenset(("article", "main"))
NEVER_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# Words in class and id that name other things than main text.
COMMENTS = frozenset("comment commentlist comments disqus replies respond".split())
NOT_MAIN = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs consent cookie cookies footer gdpr "
    "login menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion "
    "related share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
PAGE_TOP = frozenset("header masthead topbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


@dataclass
class Line:
    text: str = ""
    #: Characters outside links.
    length: int = 0
    heading: bool = False
    #: Number of the innermost article or main element around, None outside.
    landmark: int | None = None


@dataclass
class Element:
    name: str
    #: Nothing inside is main text; with ``weak``, unless an article or main element begins inside.
    dropped: bool = False
    weak: bool = False
    landmark: int | None = None


@dataclass
class Stripper:
    """The lines of a page, in order. Without ``names``, names in class and id count for comments only."""

    names: bool = True
    lines: list[Line] = field(default_factory=list)
    open: list[Element] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False
    heading: bool = False
    dropping: bool = False
    landmark: int | None = None
    landmarks: list[str] = field(default_factory=list)

    def strip(self, page: str) -> list[Line]:
        at = 0
        while found := _TOKEN.search(page, at):
            self.text(page[at : found.start()])
            at = found.end()
            closing, name, attributes = found.groups()
            if name is None:
                continue
            name = name.lower()
            if closing:
                self.end(name)
            elif name in RAW:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
                self.parts.append(" ")
            else:
                self.begin(name, attributes)
        self.text(page[at:])
        self.flush()
        return self.lines

    def text(self, raw: str) -> None:
        if raw and not self.dropping:
            shown = html.unescape(raw) if "&" in raw else raw
            self.parts.append(shown)
            if self.in_link:
                self.linked += sum(map(len, shown.split()))

    def flush(self, boundary: bool = False) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            length = max(len(text) - text.count(" ") - self.linked, 0)
            self.lines.append(Line(text, length, self.heading, self.landmark))
        if boundary and self.lines and self.lines[-1].text:
            self.lines.append(Line())
        self.parts, self.linked = [], 0

    def begin(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            self.heading = name in HEADINGS
            while self.open and self.open[-1].name in ("p", "li", "dt", "dd"):
                self.open.pop()
                self.place()
        elif name == "br":
            self.parts.append(" ")
        if name in VOID:
            return
        if name == "a":
            self.in_link = True
        element = self.element(name, attributes)
        if element.dropped or name in CONTAINERS:
            self.open.append(element)
            self.place()

    def element(self, name: str, attributes: str) -> Element:
        given = {}
        if attributes and attributes.strip(" /"):
            for key, *values in _ATTRIBUTE.findall(attributes):
                given.setdefault(key.lower(), html.unescape("".join(values)).lower())
        named = f"{given.get('class', '')} {given.get('id', '')}"
        words, role = set(_WORDS.findall(named)), given.get("role", "")
        if name in ("html", "body"):
            return Element(name)
        if name in LANDMARKS or role in LANDMARKS:
            if COMMENTS.intersection(named.split()):
                return Element(name, dropped=True)
            self.landmarks.append("main" if "main" in (name, role) else "article")
            return Element(name, landmark=len(self.landmarks) - 1)
        hidden = "hidden" in given or "display:none" in given.get("style", "").replace(" ", "")
        if name in NEVER_TEXT or words & COMMENTS or hidden:
            return Element(name, dropped=True)
        top = self.landmark is None and (name == "header" or (self.names and words & PAGE_TOP))
        if name == "form" or role in NEVER_ROLES or top or (self.names and words & NOT_MAIN):
            return Element(name, dropped=True, weak=True)
        return Element(name)

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
            self.heading = False
        if name == "a":
            self.in_link = False
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].name == name:
                del self.open[depth:]
                self.place()
                break

    def place(self) -> None:
        """Whether text counts here, and in which landmark it is."""
        strong = weak = False
        landmark = None
        for element in self.open:
            if element.landmark is not None:
                landmark, weak = element.landmark, False
            weak |= element.dropped and element.weak
            strong |= element.dropped and not element.weak
        if (strong or weak) != self.dropping or landmark != self.landmark:
            self.flush(boundary=True)
        self.dropping, self.landmark = strong or weak, landmark


def _main_landmarks(lines: list[Line], kinds: list[str]) -> set[int]:
    """The articles (or, without any, the main elements) that hold the page's text."""
    sums = np.zeros(len(kinds), np.int64)
    for line in lines:
        if line.landmark is not None:
            sums[line.landmark] += len(line.text)
    for kind in ("article", "main"):
        held = [i for i, k in enumerate(kinds) if k == kind and sums[i]]
        if held:
            most = max(sums[i] for i in held)
            return {i for i in held if sums[i] >= SHARE * most}
    return set()


def between_surge_and_dive(lengths: np.ndarray, window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> list[tuple[int, int]]:
    """First and last line of every region from a surge point to its dive point."""
    if not len(lengths):
        return []
    sums = np.convolve(lengths, np.ones(window, np.int64))[window - 1 :]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (sums >= dive).astype(np.int8), [0]))))
    out: list[tuple[int, int]] = []
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        risen = np.flatnonzero(sums[begin:end] >= surge)
        if not len(risen):
            continue
        begin += int(risen[0])
        # Windows reach over the region's ends: take the lines with text that they hold.
        held = np.flatnonzero(lengths[begin : end - 1 + window]) + begin
        first, last = int(held[0]), int(held[-1])
        if out and first <= out[-1][1]:
            first = out.pop()[0]
        out.append((first, last))
    return out


def main_lines(lines: list[Line], kinds: list[str]) -> list[Line]:
    marked = _main_landmarks(lines, kinds)
    if marked:
        return [line for line in lines if line.text and line.landmark in marked]
    lengths = np.array([line.length for line in lines], np.int64)
    regions = between_surge_and_dive(lengths)
    if not regions:
        return [line for line in lines if line.text]
    sums = [int(lengths[first : last + 1].sum()) for first, last in regions]
    kept: list[Line] = []
    for (first, last), size in zip(regions, sums):
        if size < SHARE * max(sums):
            continue
        while first > 0 and lines[first - 1].heading:
            first -= 1
        kept += [line for line in lines[first : last + 1] if line.text]
    return kept


def main_text(page: str) -> str:
    for names in (True, False):
        stripper = Stripper(names)
        lines = stripper.strip(page)
        kept = main_lines(lines, stripper.landmarks)
        if kept:
            break
    return "\n".join(line.text for line in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages = (batch.column(name) for name in ("page_id", "url", "html"))
        texts, begin, size = [], 0, 0
        for n, page in enumerate(pages, 1):
            texts.append(main_text(page.as_py()))
            size += len(texts[-1])
            if size > BATCH_BYTES or n == batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, n - begin), urls.slice(begin, n - begin), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )
                texts, begin, size = [], n, 0


def extract_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (the main text), n_chars (its code points)."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html")
    )
    found = rows.mapInArrow(_extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op13_main_text")
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
