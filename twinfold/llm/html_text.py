"""Main text of web pages by block rules in two passes.

A page is cut into blocks (paragraphs, headings, list items, cells ...). What a block stands in is evidence,
not a switch: an article or main element counts for it, menus, headers, footers, asides, forms and class names
such as "comments" or "ad" count against it, a name that only mentions such a word ("notice-period") less than
one that is made of them, and one that states a layout ("has-sidebar") not at all. The first pass adds to that
what the text says of itself: many words with enough stop words among them count for a block, links that make
up most of it against it. Blocks at or above CONTENT, or at or below BOILERPLATE, are decided. The second pass
lets the short or unclear blocks that are left inherit the label of the nearest decided neighbours on both
sides: one that leans to content needs one such neighbour of content, any other needs two, or, for a heading,
the one that follows. Blocks that only their surroundings condemned (an advert inside an article) are no
neighbours. Where the first pass finds no content at all (short paragraphs, or a language without stop words
here), nothing tells unclear blocks from it: those that lean to content are kept, or all if none does.

Pages are taken one by one, in time and room linear in the page; nothing is shuffled.

Cases: null or empty html gives an empty text; markup that is never closed ends where an enclosing element
does; a "<" without any ">" after it is text; repeated rows are extracted each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - frozenset(["option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "head", "body", "html"])
SILENT = frozenset("button select option textarea input iframe noscript script style template svg math canvas audio video object embed head title label".split())
AGAINST = frozenset("nav footer aside form dialog menu fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts of class, id and role names that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner sidebar rail menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr privacy notice notices notification alert popup modal overlay subscribe subscription newsletter signup login paywall "
    "comment comments commentlist disqus replies reply respond discussion share sharing social follow related recommended recommendations recommendation more trending popular widget footer copyright disclaimer toolbar pagination pager complementary contentinfo search hidden".split()
)
TOP_MARKS = frozenset("header masthead topbar banner".split())
#: Stop words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with his they at be this from or by not but an which you were we their one all there her had has have would will if can more when who so no its "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er hat aus bei sie nach wird einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch "
    "le la les de des du un une et à il elle en que qui dans pour pas sur ce se plus par je avec tout faire son mais au aux ou nous comme cette ses leur si été sont "
    "el los las y del que una por con no su para es al lo como más o pero sus este sí porque esta entre cuando muy sin sobre también me hasta hay donde".split()
)

GENERIC = frozenset("area bar block body box button btn col column container content count div field footer form group header head heading icon inner item items label left link links list main message meta middle module outer panel pane right row section slot text title top unit wrap wrapper zone".split())
STATES = frozenset("has no with without is".split())

#: Evidence: for the elements and marks that a block stands in, and for its text.
BODY, ELEMENT, MARK, MENTION, HEADER = 0.75, -3.0, -2.0, -0.75, -2.0
PROSE, LINKED = 1.0, -1.5
CONTENT, BOILERPLATE = 1.0, -1.0

OPEN = re.compile(r"<(?:(/)?([A-Za-z][A-Za-z0-9:-]*)|!--|!\[CDATA\[|[!?])")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
STOP = re.compile(r"[>\"']")


#: Numeric references with more digits than any character needs.
_LONG_NUMBER = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{8,}));?")


def characters(raw: str) -> str:
    """raw with its character references decoded. Numbers of any length: padding counts for nothing, and what is beyond the last character is U+FFFD."""

    def shortened(m: re.Match[str]) -> str:
        digits = (m[1] or m[2]).lstrip("0") or "0"
        return "\ufffd" if len(digits) > 7 else f"&#{'x' if m[2] else ''}{digits};"

    return html_lib.unescape(_LONG_NUMBER.sub(shortened, raw) if "&#" in raw else raw)


@dataclass
class Block:
    """text, its linked characters, the evidence of its surroundings, and whether it is a heading."""

    text: str
    linked: int
    around: float
    heading: bool


def name_weight(token: str, marks: frozenset[str]) -> float:
    """What one class, id or role name says: MARK if it is made of marks, MENTION if it only mentions one."""
    pieces = [x.lower() for x in PIECES.findall(token)]
    if not any(x in marks for x in pieces) or pieces[0] in STATES:
        return 0.0
    return MARK if all(x in marks or x in GENERIC or x.isdigit() for x in pieces) else MENTION


def marks_weight(attrs: str, marks: frozenset[str] = MARKS) -> float:
    tokens = [t for m in NAMES.finditer(attrs) for t in (m[1] or m[2] or m[3] or "").split()]
    return min((name_weight(t, marks) for t in tokens), default=0.0)


class TagEnds:
    """Where tags of one page end: at the first ">" outside quotes.

    Once a tag runs to the end of the page that way, quotes count for nothing in the rest of it, and a sign
    that isn't found once is not looked for again, so the time for all tags is linear.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.last = page, True, page.rfind(">")

    def after(self, at: int) -> int:
        """The place of the tag's ">" at or after at, or -1 where there is none."""
        if self.last < at:
            return -1
        where = at
        while self.quotes:
            m = STOP.search(self.page, where)
            if m and m[0] == ">":
                return m.start()
            close = self.page.find(m[0], m.end()) if m else -1
            if close < 0:
                self.quotes = False
            where = close + 1
        return self.page.find(">", at)


class OpenElements:
    """The stack of open elements: name, evidence, whether inside article or main, inside a link, silent."""

    #: A paragraph or list item is closed from inside these no further.
    BOUNDS = (BLOCK - frozenset(["p", "li", "dt", "dd", "td", "th", "tr"])) | frozenset(["ul", "ol", "menu", "dl", "table"])

    def __init__(self):
        self.stack: list[tuple[str, float, bool, bool, bool]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.bounds: list[int] = []
        self.blocks: list[int] = []

    def top(self) -> tuple[float, bool, bool, bool]:
        return self.stack[-1][1:] if self.stack else (0.0, False, False, False)

    def push(self, name: str, around: float, body: bool, link: bool, silent: bool) -> None:
        at = len(self.stack)
        self.stack.append((name, around, body, link, silent))
        self.places[name].append(at)
        if name in self.BOUNDS:
            self.bounds.append(at)
        if name in BLOCK:
            self.blocks.append(at)

    def cut(self, at: int) -> bool:
        """Close the elements from a place on; whether a block was among them."""
        for name, *_ in self.stack[at:]:
            self.places[name].pop()
        del self.stack[at:]
        while self.bounds and self.bounds[-1] >= at:
            self.bounds.pop()
        had = bool(self.blocks and self.blocks[-1] >= at)
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        return had

    def last(self, *names: str) -> int:
        """The place of the innermost of the elements, if no bound stands inside it, else -1."""
        at = max((self.places[n][-1] for n in names if self.places[n]), default=-1)
        return at if at > (self.bounds[-1] if self.bounds else -1) else -1


SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def page_blocks(page: str) -> Iterator[Block]:
    """The blocks of a page that have text, in order."""
    tree, ends = OpenElements(), TagEnds(page)
    parts: list[str] = []
    linked = 0
    heading = False
    at, size, lower = 0, len(page), None

    def flush() -> Block | None:
        nonlocal heading, linked
        text = " ".join("".join(parts).split())
        block = Block(text, linked, tree.top()[0], heading) if text else None
        parts.clear()
        linked, heading = 0, False
        return block

    def add(raw: str) -> None:
        nonlocal linked
        _, _, link, silent = tree.top()
        if not silent:
            text = characters(raw)
            parts.append(text)
            if link:
                linked += len("".join(text.split()))

    while at < size:
        m = OPEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        start = m.start()
        if start > at:
            add(page[at:start])
        if m[2] is None:
            if m[0] == "<!--":
                end = page.find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif m[0] == "<![CDATA[":
                end = page.find("]]>", start + 9)
                add(page[start + 9 : size if end < 0 else end])
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", start)
                at = size if end < 0 else end + 1
            continue
        end = ends.after(m.end())
        if end < 0:
            add(page[start:])
            break
        at, name, attrs = end + 1, m[2].lower(), page[m.end() : end]
        if name == "br":
            parts.append(" ")
        elif (name in BLOCK or name == "button") and (block := flush()):
            yield block
        if m[1]:
            if tree.places[name]:
                if tree.blocks and tree.blocks[-1] >= tree.places[name][-1] and (block := flush()):
                    yield block
                tree.cut(tree.places[name][-1])
            continue
        if name in CLOSES_P and (k := tree.last("p")) >= 0:
            tree.cut(k)
        elif name in SAME and (k := tree.last(*SAME[name])) >= 0:
            tree.cut(k)
        around, body, link, silent = tree.top()
        if not silent:
            if name in ("article", "main") and not body:
                body, around = True, around + BODY if around <= MARK else BODY  # a mere mention further out counts no more
            said = 0.0
            if name in AGAINST:
                said = ELEMENT
            elif name not in ("body", "html", "article", "main"):
                said = marks_weight(attrs) if "=" in attrs else 0.0
                if not body:
                    said = min(said, HEADER if name == "header" else 0.0, marks_weight(attrs, TOP_MARKS) if "=" in attrs else 0.0)
            around = min(around, (BODY if body else 0.0) + said) if said else around
            silent = name in SILENT or bool(attrs and HIDDEN.search(attrs))
        heading = name in HEADINGS or heading
        if name in RAW:
            if lower is None:
                lower = page.lower()
            close = lower.find(f"</{name}", at) if len(lower) == size else page.find(f"</{name}", at)
            close = page.find(">", close) if close >= 0 else -1
            at = size if close < 0 else close + 1
            continue
        if name not in VOID and not attrs.endswith("/"):
            tree.push(name, around, body, link or name == "a", silent)
    if block := flush():
        yield block


def evidence(block: Block, long: int, words: int, link_share: float, stop_share: float) -> float:
    """What speaks for a block: its surroundings, and the density of its stop words and links."""
    total = block.around
    if block.linked > link_share * max(1, len(block.text.replace(" ", ""))):
        return total + LINKED
    if len(block.text) >= long:
        found = [w.strip(".,;:!?\"'()").lower() for w in block.text.split()]
        if len(found) >= words and sum(w in STOP_WORDS for w in found) >= stop_share * len(found):
            total += PROSE
    return total


def decide(blocks: list[Block], long: int = 70, words: int = 8, link_share: float = 0.5, stop_share: float = 0.2) -> list[bool]:
    """Which blocks are content."""
    totals = [evidence(b, long, words, link_share, stop_share) for b in blocks]
    labels = [True if t >= CONTENT else False if t <= BOILERPLATE else None for t in totals]
    if True not in labels:
        leaning = [x is None and t > 0 for x, t in zip(labels, totals)]
        return leaning if any(leaning) else [x is None for x in labels]
    # What its surroundings alone condemn is no neighbour.
    seen = [None if x is False and b.around <= BOILERPLATE else x for x, b in zip(labels, blocks)]
    before: list[bool | None] = []
    last: bool | None = None
    for x in seen:
        before.append(last)
        last = last if x is None else x
    out, following = [], None
    for k in range(len(blocks) - 1, -1, -1):
        x = labels[k]
        if x is None:
            sides = [y for y in (before[k], following) if y is not None]
            if totals[k] > 0:
                x = True in sides
            else:
                x = following is True if blocks[k].heading else sides == [True, True]
        following = following if seen[k] is None else seen[k]
        out.append(x)
    return out[::-1]


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by line breaks."""
    blocks = list(page_blocks(page or ""))
    return "\n".join(b.text for b, keep in zip(blocks, decide(blocks)) if keep)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: id, url, text, n_chars."""
    schema = f"id {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, schema)
