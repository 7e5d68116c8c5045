"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each with the path of block elements from the
root to it (inline elements do not count). For every path of a page the text
length and the number of punctuation marks are summed and divided by its blocks;
both ratios are smoothed along the page, fused by their geometric mean with the
share of text outside links and with what element and class names say, and paths
whose fused value reaches a share of the page's mean, weighted by length, are
content: all blocks of such a path are kept, long or short.

Values are then handed down along paths. All that is shown in a main element
(article, main) is content, lists, tables and linked headings too, unless most of
the element is links. On a page without one, the innermost element that holds most
of the content gives its value to all paths below it, but not to lists and paths
that are mostly links; where it is the body itself, only to lists, tables and
quotations.

Names of class, id and role are of two kinds. Some name a role for certain
(comments, sidebar, advert ...) and rule an element out however much it holds,
unless the name says that something else has or lacks such a part (no-, with-,
has-, -open). Others are ambiguous (legal, search, share ...): they never rule out
an element that holds most of the text. No name rules out html, body, main or an
outermost article.

Character references are decoded, white space inside a block becomes one blank,
``<br>`` is white space. Unclosed elements end where their parent ends or the next
block of their kind begins. A tag's quoted attributes may hold ``>`` within
``LONGEST`` characters. Reading takes time and memory in proportion to the page,
however deep its elements are. A null, empty or markup-only page has an empty text.
Repeated rows are read each; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by their role.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_UNSEEN = frozenset(
    "script style noscript template title textarea select svg math iframe object canvas audio "
    "video head button option datalist".split()
)
_RAW = frozenset("script style textarea title iframe noscript".split())
_AROUND = frozenset("nav footer aside form dialog menu".split())
_MAIN = frozenset("article main".split())
_NEVER_AROUND = _MAIN | {"html", "body"}
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
_HOLDS_P = frozenset("button table caption td th".split())
_ENDS_OWN_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
}
_LISTS = frozenset("ul ol dl table".split())
_LISTED = _LISTS | {"pre", "blockquote", "figure"}
# Text stands in these themselves, so none of them is a container of content.
_TEXT_ONLY = frozenset(
    "p li dt dd h1 h2 h3 h4 h5 h6 pre blockquote tr td th caption figcaption figure ul ol dl table "
    "tbody thead tfoot summary".split()
)
# Words of class, id and role that mark what stands around a text,
# first those that leave no doubt.
_CERTAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored nav navbar navigation breadcrumb "
    "breadcrumbs sidebar aside footer cookie cookies gdpr newsletter comment comments reply replies "
    "respond disqus related recommended recommendations pagination pager contentinfo "
    "complementary".split()
)
_AROUND_WORDS = frozenset(
    "sponsor promo promotion banner menu masthead consent notice notices alert popup modal overlay "
    "subscribe subscription signup login share sharing social discussion widget search form "
    "copyright legal disclaimer dialog skip".split()
)
_HEADER_WORDS = frozenset("header topbar".split())
# Words beside which another one tells of a part of the page, not of the element.
_MODIFIERS = frozenset("no without with has open closed enabled disabled layout".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCT = re.compile(r"[.,;:!?…。，、！？；：¿¡]")

SMOOTH = np.array([0.25, 0.5, 0.25])
SHARE = 0.1
#: Factor of the weight where names speak against an element that holds most text.
NAMED = 0.5
#: Share of the content that the element holds which hands its value down.
CONTAINED = 0.8
#: Characters after which a tag whose quotes do not close ends at its next ``>``.
LONGEST = 1 << 14


class Block(NamedTuple):
    """Text of one block element, up to the next block."""

    path: int
    text: str
    linked: int
    weight: float
    #: Number of the outermost main element around it, 0 for none.
    main: int = 0
    #: Number of the outermost list or table around it, 0 for none.
    list: int = 0


class Path(NamedTuple):
    """A path: the one above it, its element, whether names speak against it."""

    parent: int
    tag: str
    named: bool


class Page:
    """Blocks in page order, and their paths; a path's number is above its parent's."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.paths = [Path(0, "", False)]
        self.elements = [1]
        self._numbers: dict[tuple[int, str], int] = {}

    def path(self, parent: int, step: str, tag: str, named: bool) -> int:
        """The number of a path, one element of which begins."""
        number = self._numbers.setdefault((parent, step), len(self.paths))
        if number == len(self.paths):
            self.paths.append(Path(parent, tag, named))
            self.elements.append(0)
        self.elements[number] += 1
        return number

    def below(self, values: list) -> list:
        """For each path the sum of the values of the blocks on it and below it."""
        sums = [0] * len(self.paths)
        for block, value in zip(self.blocks, values):
            sums[block.path] += value
        for number in range(len(sums) - 1, 0, -1):
            sums[self.paths[number].parent] += sums[number]
        return sums


class _Open(NamedTuple):
    tag: str
    path: int
    weight: float
    main: int
    list: int


def _said(attributes: str) -> tuple[set[str], set[str]]:
    """Words of an element's names, and those of names without a modifier."""
    every, plain = set(), set()
    for _, a, b, c in _NAMED.findall(attributes):
        for name in (a or b or c).split():
            said = {w.lower() for w in _WORD.findall(name)}
            every |= said
            if not said & _MODIFIERS:
                plain |= said
    return every, plain


def _weight(tag: str, attributes: str, parent: _Open) -> tuple[str, float, bool]:
    """The element's step in a path, 0 for what stands around, and whether names
    that are no proof speak against it."""
    every, plain = _said(attributes) if attributes else (set(), set())
    step = tag if not every else f"{tag}.{'.'.join(sorted(every))}"
    weight = parent.weight
    if tag in _AROUND or (attributes and _HIDDEN.search(attributes)):
        weight = 0.0
    elif not parent.main and tag == "header":
        weight = 0.0
    # An article inside another one may be a reader's comment.
    spared = tag in _NEVER_AROUND and not (tag == "article" and parent.main)
    if not spared and plain & _CERTAIN_WORDS:
        weight = 0.0
    words = _AROUND_WORDS if parent.main else _AROUND_WORDS | _HEADER_WORDS
    return step, weight, bool(plain & words) and tag not in _NEVER_AROUND


def read_page(html: str) -> Page:
    """The page's blocks of text in page order."""
    page = Page()
    stack = [_Open("", 0, 1.0, 0, 0)]
    places: dict[str, list[int]] = defaultdict(list)
    parts: list[str] = []
    linked = links = mains = lists = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1]
            weight = top.weight * (4.0 if top.main else 1.0)
            page.blocks.append(Block(top.path, text, min(linked, len(text)), weight, top.main, top.list))
        parts.clear()
        linked = 0

    def nearest(tags) -> int:
        """Place of the innermost open element of these kinds, 0 if there is none."""
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def close(place: int) -> None:
        flush()
        for open_ in stack[place:]:
            places[open_.tag].pop()
        del stack[place:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text)

    at, n = 0, len(html)
    last = html.rfind(">")
    while at < n:
        begin = html.find("<", at)
        if begin < 0:
            begin = n
        add(html[at:begin])
        if begin == n:
            break
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            at = end + 3 if end >= 0 else n
            continue
        name = _NAME.match(html, begin + 1) if begin < last else None
        if name is None:
            if begin < last and html[begin + 1] in "!?/":
                at = html.find(">", begin) + 1
            else:
                add("<")
                at = begin + 1
            continue
        rest = _REST.match(html, name.end(), name.end() + LONGEST)
        at = rest.end() if rest else html.find(">", name.end()) + 1
        if not at:
            add(html[begin:n])
            break
        tag, closing, attributes = name[2].lower(), bool(name[1]), html[name.end() : at - 1]
        if tag in _UNSEEN:
            if not closing and not attributes.endswith("/"):
                if tag in _RAW:
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                    at = end.end() if end else n
                elif tag != "head":
                    at = _past(html, at, tag)
            continue
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = max(0, links - 1) if closing else 1
            continue
        if closing:
            if places[tag]:
                close(places[tag][-1])
                links = 0
            continue
        flush()
        links = 0
        if tag in _ENDS_P:
            place = nearest({"p"})
            if place > nearest(_HOLDS_P):
                close(place)
        if tag in _ENDS_OWN_KIND:
            kinds, until = _ENDS_OWN_KIND[tag]
            place = nearest(kinds)
            if place > nearest(until):
                close(place)
        if tag in _VOID or attributes.endswith("/"):
            continue
        parent = stack[-1]
        step, weight, named = _weight(tag, attributes, parent)
        main = parent.main
        if tag in _MAIN and not main:
            main = mains = mains + 1
        inside = parent.list
        if tag in _LISTS and not inside:
            inside = lists = lists + 1
        places[tag].append(len(stack))
        stack.append(_Open(tag, page.path(parent.path, step, tag, named), weight, main, inside))
    flush()
    return page


def _past(html: str, at: int, tag: str) -> int:
    """The end of an element that is not shown, with those of its kind inside it."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}\b[^>]*>", re.I).finditer(html, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return len(html)


def _weigh_names(page: Page) -> None:
    """Give blocks weight 0 where ambiguous names say that they stand around the text.

    Elements of one path are believed unless they hold most of the page's unlinked
    text and no main element outside them holds a share of it. Then their names only
    lessen the weight.
    """
    paths, found = page.paths, page.blocks
    if not any(p.named for p in paths):
        return
    free = [(len(b.text) - b.linked) * (b.weight > 0) for b in found]
    sums = page.below(free)
    most = [p.named and 2 * n > sums[0] for p, n in zip(paths, sums)]

    def trusted() -> tuple[list[bool], list[bool]]:
        """Paths with a name against them, and those of which none is believed."""
        named, fine = [False], [True]
        for path, holds in list(zip(paths, most))[1:]:
            named.append(named[path.parent] or path.named)
            fine.append(fine[path.parent] and (not path.named or holds))
        return named, fine

    _, fine = trusted()
    inside = page.below([n * (b.main > 0 and fine[b.path]) for b, n in zip(found, free)])
    for number, holds in enumerate(most):
        outside = inside[0] - inside[number]
        if holds and outside and outside >= SHARE * sums[0]:
            most[number] = False
    named, fine = trusted()
    page.blocks = [
        b if not named[b.path] else b._replace(weight=b.weight * NAMED if fine[b.path] else 0.0)
        for b in found
    ]


def content(page: Page) -> list[Block]:
    """The blocks of the paths that hold the page's main text."""
    _weigh_names(page)
    found = page.blocks
    sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for block in found:
        own = sums[block.path]
        own[0] += len(block.text)
        own[1] += len(_PUNCT.findall(block.text))
        own[2] += block.linked
        own[3] += 1
    length = np.array([len(b.text) for b in found], dtype=float)
    weight = np.array([b.weight for b in found])
    if not weight.any():
        return []
    text_ratio = np.array([sums[b.path][0] / sums[b.path][3] for b in found])
    mark_ratio = np.array([sums[b.path][1] / sums[b.path][3] for b in found])
    unlinked = np.array([1 - sums[b.path][2] / sums[b.path][0] for b in found])
    shown = weight > 0

    def smooth(ratio: np.ndarray) -> np.ndarray:
        value = np.convolve(np.pad(ratio[shown], 1, mode="edge"), SMOOTH, mode="valid")
        out = np.zeros(len(found))
        out[shown] = value
        return out

    fused = np.sqrt(smooth(text_ratio) * (1 + smooth(mark_ratio))) * unlinked**2 * weight
    by_path: dict[int, list[float]] = defaultdict(list)
    for block, value in zip(found, fused.tolist()):
        by_path[block.path].append(value)
    mean = {path: sum(values) / len(values) for path, values in by_path.items()}
    score = np.array([mean[b.path] for b in found])
    # What stands in no main element counts as around if most text stands in one.
    bound = SHARE * float((score * length).sum() / max(1.0, length[shown].sum()))
    main = np.array([b.main > 0 for b in found])
    inside = length[main & shown].sum()
    outweighed = inside * 2 >= length[shown].sum()
    if outweighed:
        score[~main] = 0
    held = _held(found)
    kept = [
        bool((b.main in held and b.weight > 0) or (s > 0 and s >= bound))
        for b, s in zip(found, score.tolist())
    ]
    if not outweighed:
        handed = _handed_down(page, kept)
        links = _mostly_links(found)
        kept = [
            k or (b.weight > 0 and handed[b.path] and (b.list or -b.path) not in links)
            for b, k in zip(found, kept)
        ]
    return [b for b, k in zip(found, kept) if k]


def _mostly_links(found: list[Block]) -> set[int]:
    """Lists by their number, and paths outside lists (negative), that are mostly links."""
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for block in found:
        own = sums[block.list or -block.path]
        own[0] += len(block.text)
        own[1] += block.linked
    return {of for of, (length, linked) in sums.items() if linked * 2 > length}


def _handed_down(page: Page, kept: list[bool]) -> list[bool]:
    """Paths that get the value of the innermost element holding most of the content."""
    held = page.below([len(b.text) * k for b, k in zip(page.blocks, kept)])
    top = 0
    for number, path in enumerate(page.paths):
        # The paths that hold so much lie below one another.
        if number and page.elements[number] == 1 and path.tag not in _TEXT_ONLY:
            if held[number] >= CONTAINED * held[0] > 0:
                top = number
    whole = page.paths[top].tag not in ("", "html", "body")
    below = [False] * len(page.paths)
    for number, path in enumerate(page.paths):
        if number == top:
            below[number] = whole
        elif number and path.parent == top and top != number:
            below[number] = whole or path.tag in _LISTED
        elif number:
            below[number] = below[path.parent]
    return below


def _held(found: list[Block]) -> set[int]:
    """Main elements that are texts: at least half of what they show is not linked."""
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for block in found:
        if block.main and block.weight > 0:
            sums[block.main][0] += len(block.text)
            sums[block.main][1] += block.linked
    return {main for main, (length, linked) in sums.items() if linked * 2 <= length}


def main_text(html: str | None) -> str:
    """Blocks of the main text, one to a line."""
    page = read_page(html or "")
    return "\n".join(b.text for b in content(page)) if page.blocks else ""


def extract_text(
    pages: DataFrame,
    *,
    html: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """``keep`` columns, ``text``, ``n_chars`` (code points). Nothing is shuffled."""
    chosen = pages.select(*[f"`{c}`" for c in keep], F.col(html).alias("_html"))
    kinds = ", ".join(f"`{c}` {k}" for c, k in chosen.dtypes if c != "_html")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    return chosen.mapInArrow(read, f"{kinds}, text string, n_chars long")
