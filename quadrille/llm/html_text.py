"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. A block that stands in a menu, header, footer, form or the like, by the element's name or
class, is not text, but where that element wraps the article or most of the page's text.

The first pass decides on every other block from its length, link density and stop-word density:

1. more links than ``MAX_LINKS`` of its text (in the page's own article ``MAX_LINKS_INSIDE``): not text, but a heading there is open;
2. shorter than ``SHORT``: open;
3. stop words at ``HIGH_STOPS`` or above, or longer than ``LONG`` and at ``LOW_STOPS`` or above: text;
4. up to ``LONG``, or in the page's own article: open;
5. longer, with few stop words: open if rule 3 decided on a block of the same parent element; else not text if it decided on any (the page's language is known), else text.

Where elements ``article`` or ``main`` hold at least as much text as the rest has by these rules, a block of the rest has to be long and at ``HIGH_STOPS`` to be text, and else isn't.
That, the higher ``MAX_LINKS_INSIDE`` and rule 4 are all that those elements mean.

The second pass gives open blocks the label of their nearest neighbours that these rules decided: among blocks of the same parent
element if there are any, else among all on their side of the article's border. Of two at different distance the nearer one counts, of two at the same
"not text" does; a heading takes what follows it, if anything does. Without any neighbour an open block is text, unless the page has an article that it
isn't in.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quadrille.llm import bpe, common

# Element names of HTML by what they mean here.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math canvas object".split())
#: Of these, the ones that a page without their end tag doesn't end in: a browser goes on with what follows.
OPEN = frozenset("noscript template svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul caption".split()
)
NOT_TEXT = frozenset("nav footer aside form menu button select dialog head search label fieldset".split())
#: Of these, the ones that pages use as a wrapper of everything, too.
WRAPPERS = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Closed without an end tag when the element named here begins.
IMPLIED = {"p": BLOCK - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: Words in class, id or role that mark what is not the article. Fixed values.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promotion related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe tagcloud toolbar widget widgets".split()
)
#: Of these, the ones whose text is prose of others, however long it is.
OTHERS = frozenset("comment comments disqus related replies reply respond".split())
#: Common words of English, German, French and Spanish. Fixed values.
STOP_WORDS = frozenset(
    """a an and are as at be by for from has he in is it of on or that the this to was were will with not his her they we you
    der die das und ist in zu den von mit sich des auf für nicht ein eine als auch es an dem im wird sie
    le la les de des et en un une du que qui dans pour par sur pas plus est au avec ce il elle
    el los las y que del se por con para una su al lo como es no más""".split()
)

MAX_LINKS, MAX_LINKS_INSIDE, SHORT, LONG, LOW_STOPS, HIGH_STOPS = 0.2, 0.5, 70, 200, 0.15, 0.3
#: Elements that are one block of their parent rather than a container. Fixed values.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption td th tr address".split())
#: Words before a mark in a class that say it is not there; words after it that say where it is. Fixed values.
WITHOUT, WHERE = frozenset("no has with without not non hide show".split()), frozenset("left right top bottom main primary secondary first second wrapper container content area box block inner outer list section bar link links".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_MARKED = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MAIN = re.compile(r"""(?<![^\s"'/])role\s*=\s*["']?main\b""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?(?:false|until-found))|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)""", re.I)
_SPLIT, _WORDS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])"), re.compile(r"[^\W\d_]+")


@dataclass(eq=False)
class Mark:
    """An element that by its name or class is not the article. A loose one can also be a wrapper of the page."""

    up: Mark | None  # the next one around it
    loose: bool
    chars: int = 0  # characters outside links
    article: int = 0  # those of its largest unmarked article or main element
    prose: bool = False  # it has a long block with stop words
    others: bool = False  # it, or one around it, isn't loose and has no article
    outside: bool = False  # it, or one around it, counts


@dataclass(eq=False)
class Area:
    """An article or main element."""

    up: Area | None
    mark: Mark | None
    plain: bool  # unmarked
    chars: int = 0


@dataclass
class Block:
    text: str
    links: int = 0  # characters inside links
    area: Area | None = None  # an element that marks the article
    mark: Mark | None = None  # an element that marks something else
    heading: bool = False
    parent: int = 0  # the element that it shares with its siblings
    label: str = ""

    @property
    def inside(self) -> bool:
        return self.area is not None

    @property
    def outside(self) -> bool:
        return self.mark is not None and self.mark.outside

    @property
    def plain(self) -> int:
        return max(0, len(self.text) - self.links)

    @cached_property
    def stops(self) -> float:
        """The share of stop words."""
        words = _WORDS.findall(self.text.lower())
        return sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))

    @property
    def prose(self) -> bool:
        return len(self.text) > LONG and self.stops >= HIGH_STOPS


def marks_of(value: str) -> set[str]:
    """The marks of a class, id or role: whole tokens, or the last part of a token such as 'site-footer' unless the first part denies it ('no-sidebar', 'has-sidebar'),
    or the first part where the others only say where it is ('sidebar-left')."""
    found = set()
    for token in value.split():
        parts = [x.lower() for x in _SPLIT.split(token) if x]
        if token.lower() in MARKS:
            found.add(token.lower())
        elif len(parts) > 1 and parts[0] not in WITHOUT:
            found |= MARKS.intersection(parts[-1:]) or (MARKS.intersection(parts[:1]) if WHERE.issuperset(parts[1:]) else set())
    return found


def weigh(found: list[Block], areas: list[Area], marks: list[Mark]) -> None:
    """Says which marks count: not those that wrap the article or, if loose, most of the page's text. Outer elements come first in the lists.

    Text is counted without links, and without that of marks that aren't loose and have no article in them. The article is an
    unmarked article or main element with at least a quarter of the text, or half of it for marks that aren't loose. Where a larger
    one stands elsewhere, most of the text is not enough without a long block with stop words.
    """
    for b in found:
        if b.area:
            b.area.chars += b.plain
    for a in reversed(areas):
        if a.up:
            a.up.chars += a.chars
        if a.mark and a.plain:
            a.mark.article = max(a.mark.article, a.chars)
    for m in reversed(marks):
        if m.up:
            m.up.article = max(m.up.article, m.article)
    for m in marks:
        m.others = bool(m.up and m.up.others) or not m.loose and not m.article
    best = max((a.chars for a in areas if a.plain), default=0)
    total = 0
    for b in found:
        if not (b.mark and b.mark.others):
            total += b.plain
            if b.mark:
                b.mark.chars += b.plain
                b.mark.prose = b.mark.prose or b.mark.article < best and b.prose
    for m in reversed(marks):
        if m.up:
            m.up.chars += m.chars
            m.up.prose = m.up.prose or m.prose
    for m in marks:
        wrapper = m.article * (4 if m.loose else 2) >= total > 0 or m.loose and m.chars * 2 > total and (m.article >= best or m.prose)
        m.outside = bool(m.up and m.up.outside) or not wrapper


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with what their containers say. Empty ones are left out; raw elements, comments and tags have no text."""
    found: list[Block] = []
    stack: list[tuple[str, Area | None, Mark | None, bool, int]] = []  # name, and up to here: article, not text, link; the element's number
    areas: list[Area] = []
    marks: list[Mark] = []
    parts: list[tuple[str, bool]] = []
    unclosed: set[str] = set()  # raw elements without an end tag in the rest of the page
    elements = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(x for x, _ in parts).split())
            if text:
                _, inside, outside, _, _ = stack[-1] if stack else ("", None, None, False, 0)
                around = [x for x in stack if x[0] in BLOCK]
                name = around[-1][0] if around else ""
                around = around[:-1] if name in LEAVES else around
                found.append(Block(text, sum(len(x.strip()) for x, link in parts if link), inside, outside, name in HEADINGS, around[-1][4] if around else 0))
            parts.clear()

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            parts.append((html.unescape(text), bool(stack and stack[-1][3])))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if name in BLOCK:
                flush()
            if depth is not None and (name in BLOCK or all(x[0] not in BLOCK for x in stack[depth + 1 :])):
                del stack[depth:]
            continue
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if name in RAW:
            if name in unclosed or name in ("svg", "math") and m[3].endswith("/"):
                continue
            close = re.compile(rf"</{re.escape(name)}\s*[>/]?", re.I).search(page, at)
            if close is None and name in OPEN:
                unclosed.add(name)
                continue
            gap = page.find(">", close.end() - 1) if close else -1
            at = end if close is None else (close.end() if page[close.end() - 1] == ">" else (gap + 1 or end))
            continue
        while True:  # elements that end where this one begins; links that are open in them go on
            top = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK), -1)
            if top < 0 or name not in IMPLIED.get(stack[top][0], ()):
                break
            links = [x for x in stack[top + 1 :] if x[0] == "a"]
            del stack[top:]
            stack += links
        _, inside, outside, link, _ = stack[-1] if stack else ("", None, None, False, 0)
        values = ["".join(x) for x in _MARKED.findall(m[3])] if m[3] else []
        words = set().union(*map(marks_of, values))
        marked, hidden = bool(words), bool(m[3] and _HIDDEN.search(m[3]))
        area = name in ("article", "main") or "main" in values and bool(_MAIN.search(m[3]))
        firm = name in NOT_TEXT - WRAPPERS or name == "header" and not inside and not area or hidden or not OTHERS.isdisjoint(words)
        if (firm or name in WRAPPERS or marked) and name not in ("html", "body", "main", "article"):
            outside = Mark(outside, not firm)
            marks.append(outside)
        if area:
            inside = Area(inside, outside, name == "main" or not marked and not hidden)
            areas.append(inside)
        elements += 1
        stack.append((name, inside, outside, link or name == "a", elements))
    flush()
    weigh(found, areas, marks)
    return found


def decide(found: list[Block]) -> None:
    """The first pass: labels "text", "not" and, where a block is open, "". Blocks that an element says are not text are "not"."""
    for b in found:
        b.label = ""
        if b.outside:
            b.label = "not"
        elif b.links > (MAX_LINKS_INSIDE if b.inside else MAX_LINKS) * len(b.text):
            b.label = "" if b.inside and b.heading else "not"
        elif len(b.text) >= SHORT and (b.stops >= HIGH_STOPS or len(b.text) > LONG and b.stops >= LOW_STOPS):
            b.label = "text"
    prose = {(b.parent, b.inside) for b in found if b.label == "text"}
    for b in found:
        if not b.label and not b.inside and len(b.text) > LONG and (b.parent, b.inside) not in prose:
            b.label = "not" if prose else "text"
    inside = sum(b.plain for b in found if b.inside and b.label != "not")
    if inside and inside >= sum(b.plain for b in found if not b.inside and b.label == "text"):
        for b in found:
            if not b.inside and not b.prose:
                b.label = "not"


def nearest(found: list[Block], among: list[int], k: int) -> str:
    """What the nearest of the blocks ``among`` (their places, in order) say on block ``k``."""
    at = bisect_left(among, k)
    before, after = (k - among[at - 1], found[among[at - 1]].label) if at else None, (among[at] - k, found[among[at]].label) if at < len(among) else None
    if after is None or before is None:
        return (before or after)[1]
    if found[k].heading or before[1] == after[1]:
        return after[1]
    return "not" if before[0] == after[0] else min(before, after)[1]


def label(found: list[Block]) -> None:
    """Both passes; every block gets the label "text" or "not"."""
    decide(found)
    siblings: dict[tuple[int, bool], list[int]] = {}
    sides: dict[bool, list[int]] = {}
    for k, b in enumerate(found):
        if b.label and not b.outside:  # what an element says ends with it
            sides.setdefault(b.inside, []).append(k)
            siblings.setdefault((b.parent, b.inside), []).append(k)
    an_article = any(b.inside for b in found)
    given = {}
    for k, b in enumerate(found):
        if not b.label:
            among = siblings.get((b.parent, b.inside)) or sides.get(b.inside)
            given[k] = nearest(found, among, k) if among else "text" if b.inside or not an_article else "not"
    for k, x in given.items():
        found[k].label = x


def extract(page: str | None) -> str:
    """The main text: its blocks in page order, each with white space turned into one space, joined by one space."""
    found = blocks(page or "")
    label(found)
    return " ".join(b.text for b in found if b.label == "text")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without main text, give an empty text. The whole page is read; nothing is shuffled. Other
    columns are not read.
    """
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, htmls in bpe.slices(batch, "html"):
                texts = [extract(x) for x in htmls]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(common.table(spark, sf_dir, "pages"))
