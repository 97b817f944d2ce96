"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block of the page. Scripts, styles,
comments, menus, headers, footers, sidebars, notices, adverts, forms and reader
comments have no text; where such a part stands outside the article, it leaves
empty lines. Text lengths are summed over sliding windows of lines. Text begins
where the sums surge and ends where they dive to nothing; of several such
stretches the one with the most text is kept. Stretches that only removed parts
or link lists separate are one if the text on both sides belongs to the same
container. A form, or a box of a removed kind other than reader comments, that
holds most of the text of a page without a marked article is the page's own
container and stays. Where a page marks its article, lines outside count as empty, and
surge and dive are the article's bounds.

Edge cases: a null or empty page has an empty text; unclosed and unknown
elements, broken tags and comments are read as browsers do; repeated rows give
a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Where no article is marked: least characters in a window at the surge.
SURGE = 80

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg textarea select button audio video canvas title".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
#: Elements for an article, whose class names tell its layout.
OWN = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: First or last part of a class or id that marks what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies dialog disqus footer gdpr header login menu modal nav navbar navigation newsletter notice popup promo promoted related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe widget".split()
)
READERS = frozenset("comment comments disqus replies reply respond".split())
PLAIN = frozenset("with has no without content main page".split())
ARTICLE = frozenset("article main".split())
#: Blocks of running text, and blocks that can stand for parts of one text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption".split())
_CELLS = frozenset("td th tr".split())
_NEVER = frozenset("html body".split())
# an open element of these ends where a block begins in the same block
_AUTO = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*+)>|<!--|<[!?/][^>]*+>?""")
#: Tags that end at the next bracket, whatever their quotes, in groups as above.
_UNQUOTED = re.compile(r"""(?!)()()()|<(/?)([A-Za-z][^\s/>]*)([^>]*+)>|<!--|<[!?/][^>]*+>?""")
#: Behind the last bracket of a page no tag ends.
_TAIL = re.compile(r"(?!)()()()()()()|<!--|<[!?/][^>]*+")
#: Broken quotes may be sought to the end of the page in vain for so many times its length.
PATIENCE = 8
#: Most containers that are found to be the page's own, one in another.
NESTED = 8
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@dataclass(eq=False)
class Block:
    """An open block, for telling which lines have the same container."""

    name: str
    attributes: str
    parent: Block | None
    depth: int


@dataclass
class Line:
    text: str
    inside: bool
    heading: bool = False
    linked: int = 0
    block: Block | None = None


def _unwanted(name: str, attributes: str, in_article: bool) -> str | None:
    """Why an element is not of the article: the tag, role or mark that says so."""
    if name in _NEVER:
        return None
    if name in ASIDE and not (name == "header" and in_article):
        return name
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return None
    for key, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "hidden"
        if key == "role" and value in ROLES:
            return "role"
        if key in ("class", "id") and name not in OWN:
            for token in value.split():
                parts = re.split(r"[-_]+", token)
                if parts[0] in MARKS or parts[-1] in MARKS and parts[0] not in PLAIN:
                    return "reader" if {parts[0], parts[-1]} & READERS else "mark"
    return None


def _is_article(name: str, attributes: str) -> bool:
    return name in ARTICLE or "articlebody" in attributes.lower() or bool(re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I))


def lines_of(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[Line], bool, dict[int, int]]:
    """The page's lines, whether it marks an article, and the characters of text without links in each container that could be
    the page's own, by the place of its tag; containers in ``spared`` stay."""
    out: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, unwanted, article
    block = Block("body", "", None, 0)
    unwanted = articles = links = linked = 0
    heading = marked = False
    opened: dict[str, int] = {}
    unclosed: set[str] = set()
    held: dict[int, int] = {}
    inside = -1  # the outermost removed container, if it may be the page's own
    last, wasted = page.rfind(">") + 1, 0

    def end_line(gap: bool = False) -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts = []
        if text:
            out.append(Line(text, articles > 0, heading, min(linked, len(text)), block))
        if gap and not articles:
            out.extend(Line("", False) for _ in range(WINDOW))
        linked = 0

    def pop(to: int) -> None:
        nonlocal unwanted, articles, links, heading, block
        while len(stack) > to:
            name, bad, art = stack.pop()
            opened[name] -= 1
            if name in BLOCKS:
                end_line(gap=bad)
                if name not in _NEVER:
                    block = block.parent
            if art:
                articles -= 1
                if not articles:
                    out.extend(Line("", False) for _ in range(WINDOW))
            unwanted -= bad
            links -= name == "a"
            if name[0] == "h" and name[1:].isdigit():
                heading = False

    at, n = 0, len(page)
    while at < n:
        m = (_TAG if wasted <= PATIENCE * n else _UNQUOTED).search(page, at, last) or _TAIL.search(page, max(at, last))
        text = page[at : m.start() if m else n]
        if not unwanted:
            if text:
                parts.append(text)
                if links:
                    linked += len(text)
        elif inside >= 0 and not links:
            held[inside] += len(text.strip())
        if not m:
            break
        at = m.end()
        if m[5] and wasted <= PATIENCE * n:
            wasted += n - m.start()
        if m[0] == "<!--":
            close = page.find("-->", at)
            at = n if close < 0 else close + 3
            continue
        name, attributes, closing = (m[2], m[3], m[1]) if m[2] else (m[5], m[6], m[4])
        if not name:
            continue
        name = name.lower()
        if closing:
            if opened.get(name):
                pop(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            elif name in BLOCKS:
                end_line()
            continue
        if name in RAW:
            close = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if not close:
                unclosed.add(name)
            at = close.end() if close else (n if name in ("script", "style", "textarea", "title") else at)
            continue
        if name == "br":
            parts.append(" ")
        if name in VOID:
            if name == "hr":
                end_line()
            continue
        if name in BLOCKS:
            # an open element that this one ends, unless a box stands between
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _AUTO and name in _AUTO[stack[i][0]]:
                    pop(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
            end_line()
            heading = heading or name[0] == "h" and name[1:].isdigit()
        if attributes.rstrip().endswith("/") and name not in BLOCKS:
            continue
        why = None if m.start() in spared else _unwanted(name, attributes, articles > 0)
        bad = why is not None
        if bad and not unwanted:
            inside = m.start() if why in ("form", "mark") and name in BLOCKS else -1
            held.setdefault(inside, 0)
        art = not bad and not unwanted and _is_article(name, attributes)
        if bad and not unwanted and name in BLOCKS:
            end_line(gap=True)
        if art:
            marked = True
            articles += 1
        unwanted += bad
        links += name == "a"
        stack.append((name, bad, art))
        opened[name] = opened.get(name, 0) + 1
        if name in BLOCKS and name not in _NEVER:
            block = Block(name, attributes.strip(), block, block.depth + 1)
    pop(0)
    end_line()
    held.pop(-1, None)
    return out, marked, held


def window_sums(lengths: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Sum of each line and its neighbours, ``k`` lines in all."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    i = np.arange(len(lengths))
    return total[np.minimum(i + (k + 1) // 2, len(lengths))] - total[np.maximum(i - k // 2, 0)]


def _below(a: Block, b: Block) -> tuple[Block, Block | None, Block | None]:
    """The innermost container of both blocks, and its children that hold each (none: the text stands in it directly)."""
    x = y = None
    while a is not b:
        if a.depth >= b.depth:
            x, a = a, a.parent
        else:
            y, b = b, b.parent
    return a, x, y


def _same_text(left: Line, right: Line, strong: bool) -> bool:
    """Whether two lines belong to one text, where only removed parts or links stand between; ``strong`` if both sides have much text."""
    top, x, y = _below(left.block, right.block)
    flat = all(c is None or c.name in PROSE or c is own.block for c, own in ((x, left), (y, right)))
    if flat and (strong or top.depth or all(c is not None and c.name in PROSE for c in (x, y))):
        return True
    if not strong:
        return False
    same = x is not None and y is not None and x.name == y.name and x.name not in _CELLS and (x.name == "section" or x.attributes == y.attributes)
    return same or all(c is None or c.name in PROSE or c.name == "section" or c is own.block for c, own in ((x, left), (y, right)))


def _joined(stretches: list[tuple[int, int]], lines: list[Line], lengths: np.ndarray, sums: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring stretches of one text as one, with what lies between them."""
    out: list[tuple[int, int, int, bool]] = []  # start, end, last line with text, strong
    for a, b in stretches:
        some = np.flatnonzero(lengths[a:b]) + a
        strong = bool((sums[some] >= SURGE).any())
        first, last = int(some[0]), int(some[-1])
        spot = None
        if out and _same_text(lines[out[-1][2]], lines[first], out[-1][3] and strong):
            spot = len(out) - 1
        elif strong:
            # a strong stretch also joins the strong one before weak ones
            before = next((i for i in range(len(out) - 1, -1, -1) if out[i][3]), None)
            if before is not None and _same_text(lines[out[before][2]], lines[first], True):
                spot = before
        if spot is None:
            out.append((a, b, last, strong))
        else:
            start, strong = out[spot][0], strong or out[spot][3]
            del out[spot:]
            out.append((start, b, last, strong))
    return [(a, b) for a, b, *_ in out]


def _lines(page: str) -> tuple[list[Line], bool]:
    """The page's lines, whether it marks an article; containers of most of its text are opened one after the other."""
    spared: frozenset[int] = frozenset()
    for _ in range(NESTED):
        lines, marked, held = lines_of(page, spared)
        if marked or not held:
            break
        most = max(held, key=lambda k: (held[k], -k))
        if 2 * held[most] <= sum(held.values()) + sum(len(x.text) - x.linked for x in lines):
            break
        spared |= {most}
    else:
        lines, marked, _ = lines_of(page, spared)
    return lines, marked


def main_text(page: str | None) -> str:
    """Blocks between surge and dive, joined by newlines."""
    lines, marked = _lines(page or "")
    if not lines:
        return ""
    # without a marked article, what is only links does not raise the sums
    lengths = np.array([len(x.text) * x.inside if marked else len(x.text) - x.linked for x in lines], np.int64)
    sums = window_sums(lengths)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], sums > 0, [0]])))
    if not len(edge):
        return ""
    stretches = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
    if not marked:
        stretches = _joined(stretches, lines, lengths, sums)
    best = max(stretches, key=lambda s: (int(lengths[s[0] : s[1]].sum()), -s[0]))
    own = list(range(*best))
    if not marked:
        strong = [i for i in own if sums[i] >= SURGE and lengths[i]]
        if strong:
            first = at = strong[0]
            # headings and short lines of the same text go before it
            while at > best[0]:
                at -= 1
                x = lines[at]
                if x.text and not (x.heading or lengths[at] and _same_text(x, lines[first], False)):
                    break
                if x.text:
                    first = at
            own = list(range(first, best[1]))  # the dive ends the stretch
    return "\n".join(lines[i].text for i in own if lines[i].text and (lines[i].inside or not marked))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages``."""
    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in src.schema}
    return src.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
