"""Pages as trees of blocks, their shapes, and simple tree matching."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable
from functools import lru_cache
from math import isqrt

import numpy as np

# Fixed vocabularies of HTML and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr ul".split()
)
#: Blocks that, without a class, are plain parts of a running text.
FLOW = frozenset("p h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tfoot tr figure figcaption center address".split())
CLOSES_P = BLOCKS - {"caption", "dd", "dt", "html", "body", "legend", "li", "summary", "tbody", "tfoot", "thead", "tr"}
#: An opening tag ends an open element of these, up to the named containers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Elements, roles and class or id words whose content is never the main text.
DROPPED_TAGS = frozenset(
    "head script style noscript template nav header footer aside form button select textarea iframe object svg canvas math "
    "menu dialog title audio video map noembed noframes xmp datalist".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar status".split())
DROPPED_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus respond replies related recommended "
    "recommendations share sharing social pagination pager toolbar widget widgets skip login signup".split()
)
#: Of these, the ones that drop even an article or main element inside them.
HARD_TAGS = DROPPED_TAGS - frozenset("form header nav footer menu".split())
HARD_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus "
    "respond replies related recommended recommendations cookie cookies consent gdpr popup modal overlay newsletter".split()
)
#: A class with one of these words describes a layout and drops nothing.
LAYOUT_WORDS = frozenset("with has no without layout".split())
#: Words of position or make. The last of a class's other words says what it names:
#: article-footer a footer, but share-price a price, ad-hoc and notice-period no advert or notice.
HELPER_WORDS = frozenset(
    "site page main global top bottom left right inner outer box block list item items area section wrapper wrap container content body "
    "text bar panel unit slot zone row col column group link links button buttons btn icon icons title form message msg policy law js "
    "x id primary secondary mobile desktop sticky fixed small large thread reader user post posts articles stories news media "
    "placeholder leaderboard copyright".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("article section div main body html td th table ul ol dl blockquote aside nav header footer form li".split())
DEEPEST = 150

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
WORDS = re.compile(r"[A-Za-z]+")


@lru_cache(maxsize=4096)
def attributes(raw: str) -> tuple[int, bool, str]:
    """(dropped, main, class words) that an element's attributes ask for;
    dropped is 1, or 2 for what takes articles inside it along."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)}
    classes = html.unescape(found.get("class", "")).split()
    named = [[w.lower() for w in WORDS.findall(c)] for c in [*classes, *html.unescape(found.get("id", "")).split()]]
    marks = {next((w for w in words[::-1] if w not in HELPER_WORDS), "") for words in named if not LAYOUT_WORDS.intersection(words)}
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    main = role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower()
    dropped = 2 if hidden or marks & HARD_WORDS else int(bool(marks & DROPPED_WORDS) or role in DROPPED_ROLES)
    return dropped, main, ".".join(sorted({w.lower() for c in classes for w in WORDS.findall(c)}))


class Block:
    __slots__ = ("label", "main", "children")

    def __init__(self, label: str, main: bool):
        self.label, self.main, self.children = label, main, []  # children: Block or (text, characters in links)


def tree(page: str, lists: bool = True) -> Block:
    """Blocks and their texts; dropped elements leave nothing. Without ``lists``
    only tags that never hold running text are dropped (scripts, styles, forms'
    parts), and no menu, footer or advert for its tag or class."""
    root = Block("page", False)
    stack: list[tuple[str, Block, int]] = [("", root, 0)]  # tag, block that takes the text, dropped
    inline: list[str] = []
    links = in_link = at = 0

    def flush() -> None:
        nonlocal links
        if inline:
            text = " ".join("".join(inline).split())
            if text:
                stack[-1][1].children.append((text, links))
            inline.clear()
        links = 0

    def pop_to(depth: int) -> None:
        nonlocal in_link
        while len(stack) > depth:
            if stack[-1][0] in BLOCKS:
                flush()
            if stack[-1][0] == "a":
                in_link -= 1
            stack.pop()

    def end(tags: set[str] | frozenset[str], stops: frozenset[str] | set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                pop_to(depth)
                return
            if stack[depth][0] in stops:
                return

    def text(raw: str) -> None:
        nonlocal links
        if raw and not stack[-1][2]:
            raw = html.unescape(raw) if "&" in raw else raw
            inline.append(raw)
            if in_link:
                links += len(raw.strip())

    while found := TOKEN.search(page, at):
        text(page[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        tag = name.lower()
        if found[4] != ">":
            break  # a tag cut off at the end of the page
        if found[1]:
            if tag == "br":
                inline.append(" ")
            elif tag in BLOCKS or tag in DROPPED_TAGS:
                end({tag}, frozenset() if tag in SCOPES else SCOPES - {tag})
            else:
                end({tag}, SCOPES)
            continue
        if tag in CLOSES_P:
            end({"p"}, SCOPES)
        if tag in ENDS:
            end(*ENDS[tag])
        if tag in ("br", "td", "th"):
            if not stack[-1][2]:
                inline.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        read = attributes if len(found[3]) <= 512 else attributes.__wrapped__
        dropped, main, words = read(found[3]) if found[3].strip(" /\n\t") else (0, False, "")
        if not lists or dropped == 1 and tag in HEADINGS:
            dropped = 0
        if tag in ("html", "body", "article", "main"):
            dropped = dropped if dropped == 2 and tag == "article" else 0
            dropped = max(dropped, stack[-1][2] if stack[-1][2] == 2 or tag in ("html", "body") else 0)
        else:
            dropped = max(dropped, stack[-1][2], 2 if tag in HARD_TAGS else int(lists and tag in DROPPED_TAGS))
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = len(page) if close is None else page.find(">", close.end()) + 1 or len(page)
            continue
        block = stack[-1][1]
        if tag in BLOCKS:
            flush()
            if not dropped and len(stack) < DEEPEST:
                block = Block(f"{tag}.{words}" if words or tag not in FLOW else "flow", main or tag in ("article", "main"))
                stack[-1][1].children.append(block)
        if tag == "a":
            in_link += 1
        stack.append((tag, block, dropped))
    else:
        text(page[at:])
    pop_to(1)
    flush()
    return root


Shape = tuple  # (label, children): text is ("#", ())


def shaped(root: Block) -> tuple[Shape, list[tuple[int, str, bool, int]]]:
    """The page's shape, and (node of the shape, text, in a main element,
    characters in links) of each text block in page order. Neighbouring plain
    parts of a running text are one node; so are equal neighbours."""
    blocks: list[tuple[list[int], str, bool, int]] = []

    def walk(node: Block, main: bool) -> tuple[Shape, list]:
        """(shape, blocks below it with the path of child places that leads to them)"""
        main = main or node.main
        shapes: list[Shape] = []
        below: list[tuple[list[int], tuple]] = []
        for child in node.children:
            if isinstance(child, Block):
                shape, inner = walk(child, main)
                if child.label == "flow":
                    shape = ("flow", ())
                    inner = [([], item) for _, item in inner]
                if not inner:
                    continue
            else:
                shape, inner = ("#", ()), [([], (child[0], main, child[1]))]
            if not shapes or shapes[-1] != shape:
                shapes.append(shape)
            place = len(shapes) - 1
            below.extend(([place, *path], item) for path, item in inner)
        return (node.label, tuple(shapes)), below

    shape, below = walk(root, False)
    numbers: dict[tuple[int, ...], int] = {}

    def number(node: Shape, path: tuple[int, ...]) -> None:
        numbers[path] = len(numbers)
        for i, child in enumerate(node[1]):
            number(child, (*path, i))

    number(shape, ())
    blocks = [(numbers[tuple(path)], *item) for path, item in below]
    return shape, blocks


def size(shape: Shape) -> int:
    return 1 + sum(map(size, shape[1]))


#: Lists with fewer children than this are weighed in plain loops, longer ones in
#: array rows; both fill the same table.
ARRAYS_FROM = 64
#: Weights of pairs held at once; further ones are counted again.
MOST_WEIGHTS = 4_000_000
#: Shapes up to this many characters of text are kept for the next page.
KEPT_CHARS = 8192


@lru_cache(maxsize=1 << 14)
def _likeness(a: Shape, b: Shape) -> int:
    return 1 + sum(likeness(a[1][i], b[1][j]) for i, j in aligned(a[1], b[1]))


def likeness(a: Shape, b: Shape) -> int:
    """Nodes in the largest matching that keeps order and parents."""
    if a[0] != b[0]:
        return 0
    if not a[1] or not b[1]:
        return 1
    if len(a[1]) + len(b[1]) > 64:
        return _likeness.__wrapped__(a, b)
    return _likeness(a, b)


def aligned(a: tuple[Shape, ...], b: tuple[Shape, ...]) -> list[tuple[int, int]]:
    """Places of children matched with each other, in order. Equal ones at both
    ends match first, which no better matching can forbid."""
    first, most = 0, min(len(a), len(b))
    while first < most and a[first] == b[first]:
        first += 1
    last = 0
    while last < most - first and a[-1 - last] == b[-1 - last]:
        last += 1
    inner = _weighed(a[first : len(a) - last], b[first : len(b) - last])
    return (
        [(i, i) for i in range(first)]
        + [(first + i, first + j) for i, j in inner]
        + [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]
    )


def _weighed(a: tuple[Shape, ...], b: tuple[Shape, ...]) -> list[tuple[int, int]]:
    """The heaviest matching in order, whatever the lengths. Of its table every
    n-th row is kept; the rows between are filled again on the way back."""
    if not a or not b:
        return []
    after = _after(b) if len(b) < ARRAYS_FROM else _after_in_arrays(b)
    step = isqrt(len(a)) + 1
    kept, row = [], after(None, None)
    for i, x in enumerate(a):
        if i % step == 0:
            kept.append(row)
        row = after(row, x)
    out, p, q = [], len(a), len(b)
    rows, low = [], p
    while p and q:
        if p <= low:
            low = (p - 1) // step * step
            rows = [kept[low // step]]
            for x in a[low:p]:
                rows.append(after(rows[-1], x))
        here, up = rows[p - low], rows[p - low - 1]
        if here[q] == up[q]:
            p -= 1
        elif here[q] == here[q - 1]:
            q -= 1
        else:
            p, q = p - 1, q - 1
            out.append((p, q))
    return out[::-1]


def _after(b: tuple[Shape, ...]) -> Callable:
    """The row of a table that follows another one for one more child."""

    def after(up: list[int] | None, x: Shape | None) -> list[int]:
        if up is None:
            return [0] * (len(b) + 1)
        row = [0]
        for j, y in enumerate(b):
            row.append(max(up[j + 1], row[j], up[j] + likeness(x, y)))
        return row

    return after


def _after_in_arrays(b: tuple[Shape, ...]) -> Callable:
    """``_after`` over whole rows; equal children are compared once."""
    numbers: dict[Shape, int] = {}
    kinds = np.array([numbers.setdefault(y, len(numbers)) for y in b])
    weights: dict[Shape, np.ndarray] = {}
    by_label: dict[str, list[tuple[int, Shape]]] = {}
    for y, k in numbers.items():
        by_label.setdefault(y[0], []).append((k, y))

    def weighed(x: Shape) -> np.ndarray:
        found = np.zeros(len(numbers), np.int32)
        for k, y in by_label.get(x[0], ()):
            found[k] = likeness(x, y)
        return found

    def after(up: np.ndarray | None, x: Shape | None) -> np.ndarray:
        if up is None:
            return np.zeros(len(b) + 1, np.int32)
        if x not in weights:
            if len(weights) * len(numbers) > MOST_WEIGHTS:
                weights.clear()
            weights[x] = weighed(x)
        row = np.zeros_like(up)
        np.maximum(up[1:], up[:-1] + weights[x][kinds], out=row[1:])
        return np.maximum.accumulate(row, out=row)

    return after


def matched(a: Shape, b: Shape) -> dict[int, int]:
    """Node of ``b`` for each matched node of ``a``, both numbered in page order."""
    out: dict[int, int] = {}

    def walk(x: Shape, y: Shape, i: int, j: int) -> None:
        out[i] = j
        starts_x, starts_y = [i + 1], [j + 1]
        for c in x[1]:
            starts_x.append(starts_x[-1] + size(c))
        for c in y[1]:
            starts_y.append(starts_y[-1] + size(c))
        for p, q in aligned(x[1], y[1]):
            walk(x[1][p], y[1][q], starts_x[p], starts_y[q])

    if a[0] == b[0]:
        walk(a, b, 0, 0)
    return out


@lru_cache(maxsize=512)
def _matched_texts(a: str, b: str) -> dict[int, int]:
    return matched(from_text(a), from_text(b))


def matched_texts(a: str, b: str) -> dict[int, int]:
    """``matched`` of shapes written as text, kept where both are short."""
    return (_matched_texts if len(a) + len(b) <= KEPT_CHARS else _matched_texts.__wrapped__)(a, b)


def to_text(shape: Shape) -> str:
    return json.dumps(shape, separators=(",", ":"))


@lru_cache(maxsize=512)
def _from_text(text: str) -> Shape:
    def made(x: list) -> Shape:
        return (x[0], tuple(made(c) for c in x[1]))

    return made(json.loads(text))


def from_text(text: str) -> Shape:
    return (_from_text if len(text) <= KEPT_CHARS else _from_text.__wrapped__)(text)
