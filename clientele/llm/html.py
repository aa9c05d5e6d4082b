"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import fresh, whole_text

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
BLOCK = frozenset("""
    address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td tfoot th thead tr ul video
""".split())
#: An opening tag ends open ones of these names, as far as the nearest element of the second set.
ENDS = {
    **dict.fromkeys("""address article aside blockquote center details dialog div dl fieldset figure footer form
                    h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split(),
                    (frozenset(["p"]), frozenset(["td", "th", "caption", "button"]))),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
#: Elements that never hold an article's text, whatever their ratio.
APART = frozenset("""
    aside audio button canvas datalist dialog fieldset footer form head header iframe input label legend map
    menu meter nav noframes noscript object option progress script search select style svg template textarea
    title video
""".split())
#: Parts of class, id and role names that mark what surrounds an article, as whole words.
MARKS = frozenset("""
    ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments
    complementary consent contentinfo cookie cookies copyright dialog discussion disqus disclaimer footer form
    header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification
    pagination paywall popup popups promo promoted promotion related reply replies respond search share sharing
    sidebar sidebars signup skyscraper social sponsor sponsored sponsors subscribe subscription tags toolbar
    widget widgets
""".split())

#: Factor of a path's ratios within an article or main element.
FRAME_PRIOR = 2.0
#: Deviations of the fused ratio under which a path is no content.
CUT = 0.1

#: Words of a class name after which it tells a state of an element, not what the element is.
STATES = frozenset("enable enabled has hide is no non not show with without".split())

# Each alternative stops at the next "<", or consumes what it has read: time is in proportion to the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|"
    r"<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)>", re.S)
_NAMED = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
                    re.I | re.S)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text between two block borders."""
    path: int  # number of the path of tags from the root, and whether it leads through an article or main element
    framed: bool
    apart: bool
    level: int  # of a heading, else 0
    above: int  # path of the heading's parent
    mark: int  # innermost block element with a mark word, or -1
    parents: list[int] = field(repr=False)  # of each path, by its number; shared by a page's blocks
    parts: list[str] = field(default_factory=list)

    def inside(self, path: int) -> bool:
        """Whether the block's path leads through this one."""
        own = self.path
        while own > path:  # a path's number is larger than its parent's
            own = self.parents[own]
        return own == path


@dataclass
class _Open:
    """An open element and what holds for the text in it."""
    name: str
    path: int
    block: int  # path of the nearest block element
    framed: bool
    apart: bool
    mute: bool  # in an inline element that is no text of its block
    level: int
    above: int
    mark: int


def _attributes(text: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether its class, id or role has a mark word."""
    hidden = marked = False
    for key, value in _NAMED.findall(text) if text else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key != "aria-hidden":
            for one in value.split():
                for word in _SPLIT.split(_CAMEL.sub("-", one).lower()):
                    if word in STATES:
                        break
                    marked |= word in MARKS
    return hidden, marked


def blocks_of(page: str) -> list[Block]:
    """Non-empty text blocks in page order.

    Unclosed elements end where HTML ends them; stray end tags are left out.  Text in a marked or hidden inline
    element is left out of its block.  Blocks in marked block elements are apart, but not for an element that holds a
    main element or first heading and over half of the text.
    """
    out: list[Block] = []
    stack = [_Open("", 0, 0, False, False, False, 0, 0, -1)]
    depths: dict[str, list[int]] = {}  # where elements of a name are open
    numbers: dict[tuple[int, str], int] = {}  # of paths, by parent and name
    parents = [0]
    marks: list[tuple[int, list[bool]]] = []  # of marked elements: parent, whether it holds the heart of the page
    current: Block | None = None
    place, limit = 0, len(page)

    def add(text: str) -> None:
        nonlocal current
        top = stack[-1]
        if top.mute:
            return
        if current is None:
            if not text.strip():
                return
            current = Block(top.block, top.framed, top.apart, top.level, top.above, top.mark, parents)
            out.append(current)
        current.parts.append(text)

    def close(to: int) -> None:
        nonlocal current
        while len(stack) > to:
            name = stack.pop().name
            depths[name].pop()
            if name in BLOCK:
                current = None

    def deepest(names: frozenset[str]) -> int:
        return max((depths[n][-1] for n in names if depths.get(n)), default=0)

    while place < limit:
        found = _TOKEN.search(page, place)
        text = page[place:found.start()] if found else page[place:]
        if text:
            add(text)
        if not found:
            break
        place = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            if depths.get(name):
                close(depths[name][-1])
            elif name == "p" or name == "br":
                current = None
            continue
        if name in ENDS:
            ended, border = ENDS[name]
            last = deepest(ended)
            if last > deepest(border):
                close(last)
        if name in BLOCK:
            current = None
        attributes = found.group(3)
        if name in VOID or attributes.rstrip().endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            ends = re.compile(rf"</{re.escape(name)}[^<>]*+>", re.I).search(page, place)
            place = ends.end() if ends else limit
            continue
        top = stack[-1]
        hidden, marked = _attributes(attributes)
        hidden |= name in APART and not (name == "header" and top.framed)
        block = name in BLOCK
        mark = top.mark
        if marked and block and name not in ("html", "body", "main"):
            marks.append((mark, [False]))
            mark = len(marks) - 1
        if name in ("main", "h1"):
            above = mark
            while above >= 0 and not marks[above][1][0]:
                marks[above][1][0] = True
                above = marks[above][0]
        path = numbers.setdefault((top.path, name), len(numbers) + 1)
        if path == len(parents):
            parents.append(top.path)
        is_heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
        level, above = (int(name[1]), top.block) if is_heading else (top.level, top.above)
        depths.setdefault(name, []).append(len(stack))
        stack.append(_Open(name, path, path if block else top.block, top.framed or name in ("article", "main"),
                           top.apart or hidden and block, not block and (top.mute or hidden or marked),
                           level, above, mark))
    for block in out:
        block.parts = [_SPACE.sub(" ", html.unescape("".join(block.parts))).strip()]
    out = [b for b in out if b.parts[0]]
    held = [0] * len(marks)
    for block in out:
        if block.mark >= 0 and not block.apart:
            held[block.mark] += len(block.parts[0])
    total = sum(len(b.parts[0]) for b in out if not b.apart)
    for i in range(len(marks) - 1, -1, -1):
        if marks[i][0] >= 0:
            held[marks[i][0]] += held[i]
    counts: list[bool] = []
    for i, (parent, heart) in enumerate(marks):
        counts.append(not (heart[0] and 2 * held[i] > total) or parent >= 0 and counts[parent])
    for block in out:
        block.apart = block.apart or block.mark >= 0 and counts[block.mark]
    return out


def _smoothed(values: np.ndarray, width: float = 1.0) -> np.ndarray:
    reach = np.arange(-2, 3)
    kernel = np.exp(-reach ** 2 / (2 * width ** 2))
    padded = np.convolve(values, kernel, mode="full")[2:-2]
    return padded / np.convolve(np.ones(len(values)), kernel, mode="full")[2:-2]


def content_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks are content.

    A path's text ratio is its text length over its number of blocks, its punctuation ratio its
    punctuation marks over the same.  Each block has the ratios of its path; both rows of numbers are
    smoothed along the page by a Gaussian, divided by their means and fused as a product.  Blocks in
    elements that are never part of an article count as nothing and are not chosen.  Content are the blocks
    of paths whose fused ratio is over the threshold (a fraction of the deviation over all blocks).
    Paths in an article or main element have their ratios raised by a fixed factor.  A heading is content if a block of
    its section is: of what follows in its parent element, up to a heading of its level or a higher one.
    """
    keep = [not b.apart for b in blocks]
    if not any(keep):
        return keep
    length: dict[int, float] = {}
    marks: dict[int, float] = {}
    number: dict[int, int] = {}
    for block, kept in zip(blocks, keep):
        if kept:
            prior = FRAME_PRIOR if block.framed else 1.0
            number[block.path] = number.get(block.path, 0) + 1
            length[block.path] = length.get(block.path, 0) + prior * len(block.parts[0])
            marks[block.path] = marks.get(block.path, 0) + prior * len(_PUNCTUATION.findall(block.parts[0]))
    ratio = lambda total: np.array([total[b.path] / number[b.path] if k else 0.0
                                    for b, k in zip(blocks, keep)])
    texts, points = _smoothed(ratio(length)), _smoothed(ratio(marks))
    fused = (texts / max(texts.mean(), 1e-9)) * (points / max(points.mean(), 1e-9))
    best: dict[int, float] = {}
    for block, kept, value in zip(blocks, keep, fused):
        if kept:
            best[block.path] = max(best.get(block.path, 0.0), value)
    threshold = CUT * float(np.std(fused))
    chosen = [k and best[b.path] >= threshold for b, k in zip(blocks, keep)]
    if all(b.level for b, k in zip(blocks, keep) if k):
        return chosen
    return [c and not b.level or k and b.level > 0 and bool(heads[i])
            for heads in [_headings(blocks, chosen)] for i, (b, k, c) in enumerate(zip(blocks, keep, chosen))]


def _headings(blocks: list[Block], chosen: list[bool]) -> list[bool]:
    """Whether the section of each heading holds a chosen block that is no heading."""
    out = [False] * len(blocks)
    open_: list[int] = []  # headings whose sections go on, levels ascending
    for i, block in enumerate(blocks):
        if block.level:
            while open_ and blocks[open_[-1]].level >= block.level:
                open_.pop()
            open_.append(i)
        elif chosen[i]:
            for h in reversed(open_):
                if out[h]:
                    break
                out[h] = block.inside(blocks[h].above)
    return out


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.parts[0] for b, kept in zip(blocks, content_blocks(blocks)) if kept)


def extract_text(pages: DataFrame, html_col: str = "html", to: str = "text") -> DataFrame:
    """All rows and columns of `pages` but the html, with `to`, the main text of each page.

    Blocks stand in page order, one a line, white space inside them is one space.  NULL and empty pages,
    and pages without text, have the empty text; a page without markup is its own main text.
    Pages of any length are read whole, in time proportional to it.  Repeated pages have the same text; an empty table
    gives no rows.  A column named like `to` is replaced.
    """
    kept = [c for c in pages.columns if c not in (html_col, to)]
    source = pages.select(whole_text(F.col(f"`{html_col}`")).alias(fresh(pages.columns, "page_read")), *[f"`{c}`" for c in kept])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*kept, to])

    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(to, T.StringType())])
    return source.mapInArrow(rows, schema)
