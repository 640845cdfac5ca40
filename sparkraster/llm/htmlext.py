"""Main text of pages by wrapper induction.

Pages of a host share a template. Every page is parsed once, to a tree; runs of equal
neighbours fold into one node, so that a page's *shape* doesn't depend on how many
paragraphs it has. Shapes of a host are aligned by simple tree matching: a node of
the merged tree whose text is the same on all its pages (of several titles, so that
copies of one article prove nothing) is template; a node whose text varies is a
content slot.

Menus, forms, comments and the like vary from page to page as articles do. Some are
told by their tags (nav, footer). Others only look like furniture: a form, a dialog, or a class or id
that names nothing else, *every* word being one of page furniture ("comment-list" is,
"social-history" isn't) or the last one naming comments or adverts ("post-comments"). Such a *box* is left out by what it
holds: not if it has more than half of the page's prose, text outside links (a form around the whole page); what is named
outright, comments or an "alert", goes even then, but not if there is hardly anything else.
Words that furniture shares with prose ("tags", "social") only leave out what is
mostly links. A headline in a page's header, and what follows it there, stays if the host shows that it varies.
Where a page marks an article that has a third of its prose, all outside it is left out.

Pages meet only the template of their own (host, shape). What is aggregated for templates is one row per
(host, shape, slot), merged in map tasks first, then per (host, part of its shapes), the parts becoming fewer in
steps; a host's merged tree goes to each part of its shapes, not to each shape or page.

Cases: null and empty html give an empty text; null urls share one host; broken
markup is closed as it ends; pages of hosts with too few titles have no template;
an article element without text marks nothing; repeated rows and null ids are extracted
each for itself; an empty table gives an empty result. The result has no columns of the
input but key and url, so nothing can clash.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy

#: Titles that must agree on a text before it counts as template.
TITLES = 3
#: Slots of which a task holds the facts before it passes them on; shapes that it remembers to have written.
HELD = 10_000
#: Parts that a host's shapes are merged in, step by step, so that a host of many shapes stays spread.
PARTS = (1024, 32, 1)
#: Tasks that the pages of one shape are dealt to when they meet its template.
SALTS = 32
#: Nesting that shapes follow. What lies deeper is open with its own tags and flags, but its
#: blocks stand one after another in the last node above.
DEPTH = 120
#: Pairs of children up to which their table is made pair by pair, which is faster for few; both ways give the same match.
GRID = 2_000
#: Sizes that are held at once while long lists are aligned.
CELLS = 16_000_000

#: What counts of an element: all; what isn't mostly links; an article inside; a headline that varies; nothing.
ALL, PROSE, ARTICLE, HEADLINE, NOTHING = range(5)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset("nav footer aside script style noscript template button select textarea iframe svg head title menu object canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary menu menubar toolbar".split())
#: What is left out by what it holds.
BOXES, BOX_ROLES = frozenset({"form", "dialog"}), frozenset("search form dialog alert alertdialog".split())
#: Words of class names and ids that say page furniture, those that name a page's layout around its article as well
#: (an article inside counts), those that prose goes by too, and those that go along with any.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist disqus respond reply replies cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup login register breadcrumb breadcrumbs pagination pager paging skip".split()
)
LAYOUT = frozenset("sidebar side aside nav navbar navigation menu header footer masthead topbar search widget widgets hidden banner notice notices".split())
SHARED = frozenset("warning share sharing social related recommended recommendations tags toc".split())
NEUTRAL = frozenset(
    "area bar body bottom box button buttons col column container content count div fixed form global group has head icon icons id inner is item items js left link links list local main message mobile no outer page "
    "panel primary right row secondary section site slot sticky text thread title top ul unit with wrap wrapper".split()
)
#: Last words of names that say comments or adverts whatever stands before them, unless that says a state or what a page is filed under.
HEADS = frozenset("comment comments commentlist ad ads advert adverts advertisement".split())
STATES = frozenset("has no is with without show hide enable allow single category tag topic cat label type format filed".split())
#: Prose of a page from which on comments and the like are left out, however much they have.
ENOUGH = 140
CLOSED_BY = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "option": {"option", "optgroup"}, "head": {"body"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z|</?[a-zA-Z][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


class Node:
    """``own`` says what counts of the element by its tag, ``hard`` what by the elements around it as well; ``level`` is what counts of a
    box that is left out; ``out`` is what counts in the end. ``parent`` is the element around it, ``box`` the nearest box, itself included."""

    __slots__ = ("tag", "name", "own", "hard", "level", "outright", "article", "parts", "parent", "box", "out", "prose")

    def __init__(self, tag: str, name: str, parent: Node | None, own: int = 0, level: int = 0, outright: bool = False, article: bool = False):
        self.tag, self.name, self.own, self.level, self.outright, self.article, self.parent = tag, name, own, level, outright, article, parent
        self.parts, self.out, self.prose = [], own, 0  # parts: texts and nodes
        self.hard = max(own, _inherited(self, parent.hard)) if parent else own
        self.box = self if level else parent.box if parent else None

    def again(self) -> Node:
        """The element once more, empty."""
        return Node(self.tag, self.name, self.parent, self.own, self.level, self.outright, self.article)


def _inherited(node: Node, around: int) -> int:
    """What counts of ``node`` by the element around it: an article counts inside a layout box."""
    return ALL if around in (PROSE, ARTICLE) and node.article and not node.parent.article else around


@cache
def _said(name: str, in_article: bool) -> tuple[int, bool]:
    """What a class name or id says of its element, and whether it says so outright (comments, adverts)."""
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).lower().replace("-", " ").replace("_", " ").split()
    named = [w for w in words if not w.isdigit() and w not in NEUTRAL]
    telling = set(named)
    if in_article:
        telling -= {"header", "banner", "hidden"}  # of the article itself
    if not telling:
        return ALL, False
    if not telling <= FURNITURE | LAYOUT | SHARED:
        return (NOTHING, True) if named[-1] in HEADS and not set(words) & STATES else (ALL, False)
    return (NOTHING if telling & FURNITURE else ARTICLE if telling & LAYOUT else PROSE), bool(telling & FURNITURE)


HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


def _opened(tag: str, attributes: str, parent: Node) -> Node:
    """The new node, with what counts of it."""
    article = parent.article or tag in ("article", "main")
    own = NOTHING if tag in LEFT_OUT else HEADLINE if tag == "header" and not parent.article else ALL
    level, outright, name = NOTHING if tag in BOXES else ALL, False, tag
    if attributes and not attributes.isspace():
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
        role = found.get("role", "").lower()
        article = article or role in ("main", "article")
        classes = found.get("class", "").split()
        if classes:
            name = f"{tag}.{classes[0]}"
        if role in ROLES or found.get("aria-hidden") == "true" or "hidden" in attributes.split() or HIDDEN.search(found.get("style", "")):
            own = NOTHING
        if role in BOX_ROLES:
            level = NOTHING
        if tag not in ("html", "body", "main"):
            said = [_said(x, parent.article or tag == "article") for x in [*classes, *found.get("id", "").split()]]
            level = max([level, *(x for x, _ in said)])
            outright = any(c for _, c in said)
    if level == PROSE:  # what is mostly links goes, wherever it stands
        own, level = max(own, PROSE), ALL
    return Node(tag, name, parent, own, level, outright, article)


def _settle(nodes: list[Node]) -> bool:
    """Decide which boxes count, given the page's nodes, outer ones first; whether the page marks its article."""
    boxes = [x for x in nodes if x.level]
    whole, apart = dict.fromkeys(boxes, 0), dict.fromkeys(boxes, 0)  # prose of a box; without the outright furniture in it
    total = 0
    for x in nodes:
        if x.prose and x.hard <= PROSE:
            if x.box is None:
                total += x.prose
            else:
                whole[x.box] += x.prose
                apart[x.box] += 0 if x.box.outright else x.prose
    for x in reversed(boxes):
        around = x.parent.box
        if around is not None:
            whole[around] += whole[x]
            apart[around] += 0 if x.outright or around.outright else apart[x]
        elif not x.outright:
            total += apart[x]
    gone = {x for x in boxes if not x.outright and 2 * apart[x] <= total}
    left = total
    for x in gone:
        around = x.parent.box
        while around is not None and around not in gone and not around.outright:
            around = around.parent.box
        left -= apart[x] if around is None else 0
    gone |= {x for x in boxes if x.outright and (left >= ENOUGH or 4 * left >= whole[x])}
    prose = article = 0
    for x in nodes:
        x.out = max(x.own, x.level if x in gone else ALL, _inherited(x, x.parent.out) if x.parent else ALL)
        if x.out <= PROSE:
            prose += x.prose
            article += x.prose if x.article else 0
    for x in nodes:  # no more cycles
        x.parent = x.box = None
    return article > 0 and 3 * article >= prose


def parse(page: str) -> tuple[Node, str, bool]:
    """The page's tree, its title, and whether it marks its article."""
    root, title, at = Node("#", "#", None), "", 0
    nodes, links = [root], [0]
    stack, outer, places = [root], [0], {}  # open nodes; places of blocks and of each tag among them
    end = len(page)

    def cut(i: int) -> None:
        while len(stack) > i:
            tag = stack.pop().tag
            places[tag].pop()
            links[0] -= tag == "a"
            if tag in BLOCKS:
                outer.pop()

    def write(text: str) -> None:
        home = None
        if len(stack) <= DEPTH:
            home = stack[-1]
        elif outer[-1] < DEPTH:
            if stack[-1].hard <= PROSE:
                home = stack[DEPTH - 1]
        elif stack[-1].hard <= PROSE:
            # Deep blocks stand side by side: one that goes on after others becomes a further node.
            top, home = stack[DEPTH - 1], stack[outer[-1]]
            if top.parts[-1] is not home:
                home = stack[outer[-1]] = home.again()
                nodes.append(home)
                top.parts.append(home)
        if home is not None:
            home.parts.append(text)
            if not links[0]:
                home.prose += len(text.strip())

    while at < end:
        match = TOKEN.search(page, at)
        if match is None:
            write(page[at:])
            break
        if match.start() > at:
            write(page[at : match.start()])
        at = match.end()
        tag = match.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if match.group(1):
            # A stray inline end doesn't close a block.
            if places.get(tag) and (tag in BLOCKS or places[tag][-1] > outer[-1]):
                cut(places[tag][-1])
            continue
        if tag in BLOCKS:
            for i in range(len(outer) - 1, 0, -1):
                held = stack[outer[i]].tag
                if tag in CLOSED_BY.get(held, ()):
                    cut(outer[i])
                elif held != "p":
                    break
        node = _opened(tag, match.group(3), stack[-1])
        nodes.append(node)
        if len(stack) <= DEPTH:
            stack[-1].parts.append(node)
        elif tag in BLOCKS:
            stack[DEPTH - 1].parts.append(node)
        elif tag == "br":
            write(" ")
        if tag in RAW:
            close = re.compile(f"</{tag}", re.I).search(page, at)
            inside = page[at : close.start()] if close else page[at:]
            if tag == "title" and not title:
                title = inside
            at = page.find(">", close.start()) + 1 if close else end
            if close and not at:
                at = end
        elif tag not in VOID:
            if tag in BLOCKS:
                outer.append(len(stack))
            places.setdefault(tag, []).append(len(stack))
            links[0] += tag == "a"
            stack.append(node)
    return root, title, _settle(nodes)


def blocks(root: Node, marked: bool) -> tuple[list[tuple[str, int, bool]], list]:
    """(text, slot, doubtful) of the page's candidate blocks in order, and its folded shape. ``marked``: only articles count.

    A shape is [name, slot or -1, children]; a slot is the place of text in a folded node.
    The name of a doubtful node ends in "?".
    """
    found: list[tuple[str, int, bool]] = []
    slots, led = [0], [False]  # led: a headline was there

    def fold(node: Node) -> list:
        children: list = []
        doubtful = node.out == HEADLINE and (node.tag == "h1" or (node.tag == "p" and led[0]))
        led[0] |= doubtful
        shape = [node.name + "?" * doubtful, -1, children]
        buffer: list[str] = []
        own, linked = [-1], [0]

        def flush() -> None:
            plain = entities.unescape("".join(buffer))
            text = " ".join(plain.split())
            counts = node.out == ALL or doubtful or (node.out == PROSE and 2 * linked[0] < sum(map(len, buffer)))
            buffer.clear()
            linked[0] = 0
            if text and counts and (node.article or not marked):
                if own[0] < 0:
                    own[0] = shape[1] = slots[0]
                    slots[0] += 1
                found.append((text, own[0], doubtful))

        def inline(part: Node, link: bool = False) -> None:
            for x in part.parts:
                if isinstance(x, str):
                    buffer.append(x)
                    linked[0] += len(x) * link
                elif x.tag in BLOCKS:
                    flush()
                    add(x)
                elif x.tag == "br":
                    buffer.append(" ")
                elif x.out <= max(PROSE, node.out) and x.out != NOTHING:
                    inline(x, link or x.tag == "a")

        def add(part: Node) -> None:
            before = slots[0]
            child = fold(part)
            if children and _same(children[-1], child):
                # The run goes on: its slots are those of the run's first.
                shift = {b: a for a, b in zip(_slots(children[-1]), _slots(child))}
                for i in range(len(found) - 1, -1, -1):
                    if found[i][1] < before:
                        break
                    found[i] = (found[i][0], shift[found[i][1]], found[i][2])
                slots[0] = before
            else:
                children.append(child)

        inline(node)
        flush()
        return shape

    return found, fold(root)


def _slots(shape: list) -> list[int]:
    own = [shape[1]] if shape[1] >= 0 else []
    return own + [s for c in shape[2] for s in _slots(c)]


def _same(a: list, b: list) -> bool:
    return a[0] == b[0] and (a[1] < 0) == (b[1] < 0) and len(a[2]) == len(b[2]) and all(map(_same, a[2], b[2]))


def _kinds(tree: list, known: dict) -> dict[int, tuple[int, int]]:
    """By the identity of every node of ``tree``: a number that equal trees share, and the tree's size."""
    out: dict[int, tuple[int, int]] = {}

    def visit(node: list) -> tuple[int, int]:
        inner = [visit(c) for c in node[2]]
        kind = known.setdefault((node[0], *(k for k, _ in inner)), len(known))
        out[id(node)] = kind, 1 + sum(n for _, n in inner)
        return out[id(node)]

    visit(tree)
    return out


def match(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the size of the best order-keeping match, and its pairs of nodes.

    Equal trees match whole, wherever lists of children begin or end with them; a table is
    made only for the children between. A table of more than ``GRID`` pairs is made row by row in arrays: the same
    numbers, followed back by the same rule, so that the match doesn't depend on how long the lists are.
    """
    known: dict = {}
    kinds = _kinds(a, known) | _kinds(b, known)
    made = list(known)
    sizes: dict[tuple[int, int], int] = {}

    def size(x: list, y: list) -> int:
        if x[0] != y[0]:
            return 0
        (kind, n), (other, _) = kinds[id(x)], kinds[id(y)]
        if kind == other:
            return n
        if (kind, other) not in sizes:
            sizes[kind, other] = 1 + sum(size(*p) for p in aligned(x[2], y[2]))
        return sizes[kind, other]

    def aligned(x: list, y: list) -> list[tuple[list, list]]:
        """Pairs of children of the best match."""
        kx, ky = [kinds[id(c)][0] for c in x], [kinds[id(c)][0] for c in y]
        head, m, n = 0, len(x), len(y)
        while head < min(m, n) and kx[head] == ky[head]:
            head += 1
        while m > head and n > head and kx[m - 1] == ky[n - 1]:
            m, n = m - 1, n - 1
        ends = list(zip(x[:head], y[:head])) + list(zip(x[m:], y[n:]))
        x, y, kx, ky = x[head:m], y[head:n], kx[head:m], ky[head:n]
        if len(x) * len(y) <= GRID:
            return ends + table(x, y)
        return ends + [(x[i], y[j]) for i, j in _table(kx, ky, made)]

    def table(x: list, y: list) -> list[tuple[list, list]]:
        best = [[0] * (len(y) + 1)]
        for i, c in enumerate(x):
            row, above = [0], best[-1]
            for j, d in enumerate(y):
                both = size(c, d)
                row.append(max(above[j + 1], row[j], above[j] + both if both else 0))
            best.append(row)
        out, i, j = [], len(x), len(y)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((x[i], y[j]))
        return out

    pairs, todo = [], [(a, b)] if a[0] == b[0] else []
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        todo += list(zip(x[2], y[2])) if kinds[id(x)][0] == kinds[id(y)][0] else aligned(x[2], y[2])
    return len(pairs), pairs


class _Rows:
    """The table of two lists of kinds, row by row: best matches of the beginnings of ``x`` with those of ``y``.
    ``made`` gives the name and the children's kinds of each kind."""

    def __init__(self, x: list[int], y: list[int], made: list[tuple]):
        self.x, self.made, self.step = x, made, isqrt(len(x)) + 1
        self.columns, self.of_y = _distinct(y)
        self.whole = self.sizes(x) if len(set(x)) * len(y) <= CELLS else None

    def sizes(self, x: list[int]) -> dict[int, np.ndarray]:
        """Of each kind of ``x``, the sizes of its best matches with every element of ``y``."""
        kinds, _ = _distinct(x)
        return dict(zip(kinds, _sizes(kinds, self.columns, self.made)[:, self.of_y]))

    def after(self, row: np.ndarray, start: int) -> Iterator[np.ndarray]:
        """The next ``step`` rows, ``row`` being that before ``start``; as wide as ``row``."""
        x = self.x[start : start + self.step]
        sizes = self.whole or self.sizes(x)
        for k in x:
            both = row[:-1] + sizes[k][: len(row) - 1]
            np.maximum(both, row[1:], out=both)
            row = np.empty_like(row)
            row[0] = 0
            np.maximum.accumulate(both, out=row[1:])
            yield row

    def firsts(self) -> Iterator[tuple[int, np.ndarray]]:
        """Every ``step``-th row, from that before the first, and the last."""
        row = np.zeros(len(self.of_y) + 1, np.int32)
        for start in range(0, len(self.x), self.step):
            yield start, row
            for row in self.after(row, start):
                pass
        yield len(self.x), row


def _table(x: list[int], y: list[int], made: list[tuple]) -> list[tuple[int, int]]:
    """Places of the pairs of the best match of two lists of kinds. Every ``step``-th row is held; those between are made again."""
    named = {made[k][0] for k in x} & {made[k][0] for k in y}
    at_x, at_y = ([i for i, k in enumerate(z) if made[k][0] in named] for z in (x, y))
    rows = _Rows([x[i] for i in at_x], [y[j] for j in at_y], made)
    *held, _ = rows.firsts()
    out, j = [], len(at_y)
    while held and j:
        start, row = held.pop()
        block = [row[: j + 1]]
        block += rows.after(block[0], start)
        for i in range(len(block) - 1, 0, -1):
            here, above = block[i], block[i - 1]
            while j and here[j] != above[j]:
                j -= 1
                if here[j] != here[j + 1]:
                    out.append((at_x[start + i - 1], at_y[j]))
                    break
    return out


def _distinct(kinds: list[int]) -> tuple[list[int], np.ndarray]:
    """The distinct kinds, and the place among them of each."""
    found, places = np.unique(np.array(kinds, np.int64), return_inverse=True)
    return found.tolist(), places


def _sizes(us: list[int], vs: list[int], made: list[tuple]) -> np.ndarray:
    """Sizes of the best matches of trees of kinds ``us`` with trees of kinds ``vs``: 0 where the names differ."""
    out = np.zeros((len(us), len(vs)), np.int32)
    of_u, of_v = defaultdict(list), defaultdict(list)
    for places, kinds in ((of_u, us), (of_v, vs)):
        for i, k in enumerate(kinds):
            places[made[k][0]].append(i)
    for name in of_u.keys() & of_v.keys():
        i, j = of_u[name], of_v[name]
        out[np.ix_(i, j)] = 1 + _sizes_inside([made[us[k]][1:] for k in i], [made[vs[k]][1:] for k in j], made)
    return out


def _sizes_inside(xs: list[tuple], ys: list[tuple], made: list[tuple]) -> np.ndarray:
    """Sizes of the best matches of lists of children ``xs`` with lists ``ys``, many at a time."""
    out = np.zeros((len(xs), len(ys)), np.int32)
    of_x, of_y = sorted({k for x in xs for k in x}), sorted({k for y in ys for k in y})
    if not of_x or not of_y:
        return out
    if len(of_x) * len(of_y) > CELLS:
        if len(xs) == len(ys) == 1:
            *_, (_, last) = _Rows(list(xs[0]), list(ys[0]), made).firsts()
            return out + last[-1]
        parts = (((xs[: len(xs) // 2], ys), (xs[len(xs) // 2 :], ys)), 0) if len(xs) >= len(ys) else (((xs, ys[: len(ys) // 2]), (xs, ys[len(ys) // 2 :])), 1)
        return np.concatenate([_sizes_inside(*p, made) for p in parts[0]], axis=parts[1])
    sizes = np.pad(_sizes(of_x, of_y, made), (0, 1))  # lists of about a length are filled up with what matches nothing
    for i, left in _by_length(xs, of_x):
        for j, right in _by_length(ys, of_y):
            wide = max(1, CELLS // 8 // right.shape[1])
            for q in range(0, len(j), wide):
                some = right[q : q + wide]
                high = max(1, CELLS // 8 // some.size)
                for p in range(0, len(i), high):
                    few = left[p : p + high]
                    rows = np.zeros((len(few), len(some), some.shape[1] + 1), np.int32)
                    for k in few.T:
                        np.maximum.accumulate(np.maximum(rows[..., 1:], rows[..., :-1] + sizes[k[:, None, None], some]), axis=-1, out=rows[..., 1:])
                    out[np.ix_(i[p : p + high], j[q : q + wide])] = rows[..., -1]
    return out


def _by_length(lists: list[tuple], kinds: list[int]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Lists of about a length together: their places, and the place of each child among ``kinds``, the number of kinds where a list has ended."""
    place, by = {k: i for i, k in enumerate(kinds)}, defaultdict(list)
    for i, x in enumerate(lists):
        by[len(x).bit_length()].append(i)
    for bits, found in by.items():
        if bits:
            filled = np.full((len(found), max(len(lists[i]) for i in found)), len(kinds))
            for row, i in zip(filled, found):
                row[: len(lists[i])] = [place[k] for k in lists[i]]
            yield found, filled


def merge(wrapper: list, page: list) -> None:
    """Align ``page`` with ``wrapper`` and add it: nodes are [name, facts, children], facts None or
    [least hash, greatest hash, hashes of titles]; unmatched nodes are added beside their neighbours."""
    _, pairs = match(wrapper, page)
    partner = {id(b): a for a, b in pairs}
    for a, b in pairs:
        if b[1] is not None:
            a[1] = b[1] if a[1] is None else _both(a[1], b[1])
        place = {id(c): i for i, c in enumerate(a[2])}
        children, at = [], 0
        for child in b[2]:
            if id(child) in partner:
                to = place[id(partner[id(child)])] + 1
                children += a[2][at:to]
                at = to
            else:
                children.append(child)
        a[2] = children + a[2][at:]


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task saw of each slot: host, shape, slot, least and greatest hash of its texts, the least hashes of titles."""
    held: dict[tuple[str, str, int], list] = {}

    def rows() -> pa.RecordBatch:
        columns = [*zip(*held), *zip(*held.values())] if held else [()] * 6
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        out = pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, kinds)], ["host", "shape", "slot", "least", "greatest", "titles"])
        held.clear()
        return out

    for batch in batches:
        for host, shape, title, marks in zip(*(batch.column(i).to_pylist() for i in range(4))):
            for slot, mark in enumerate(marks):
                facts, known = [mark, mark, [title]], held.get((host, shape, slot))
                held[host, shape, slot] = facts if known is None else _both(known, facts)
            if len(held) > HELD:
                yield rows()
    yield rows()


def _both(a: list, b: list) -> list:
    """Facts of two sets of pages: [least hash of text, greatest, the least ``TITLES`` hashes of titles], exact up to that number."""
    return [min(a[0], b[0]), max(a[1], b[1]), a[2] if a[2] == b[2] else sorted({*a[2], *b[2]})[:TITLES]]


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _facts(shape: list, facts: dict[int, list]) -> list:
    return [shape[0], facts.get(shape[1]), [_facts(c, facts) for c in shape[2]]]


def _merged(trees: list[str]) -> str:
    first, *rest = [json.loads(t) for t in sorted(trees)]
    for tree in rest:
        merge(first, tree)
    return json.dumps(first, separators=(",", ":"))


def _of_part(frame: pd.DataFrame) -> pd.DataFrame:
    trees = []
    for _, rows in frame.groupby("shape", sort=True):
        facts = {int(r.slot): [int(r.least), int(r.greatest), [int(t) for t in r.titles]] for r in rows.itertuples()}
        trees.append(json.dumps(_facts(json.loads(rows["tree"].iloc[0]), facts), separators=(",", ":")))
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "part": [frame["part"].iloc[0]], "tree": [_merged(trees)]})


def _of_parts(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "part": [frame["part"].iloc[0]], "tree": [_merged(list(frame["tree"]))]})


def _template(shapes: pd.DataFrame, wrappers: pd.DataFrame) -> pd.DataFrame:
    """Slots of each shape that its host's wrapper knows as template, and doubtful ones that it knows to vary."""
    wrapper, rows = json.loads(wrappers["wrapper"].iloc[0]), []
    for shape in shapes.itertuples():
        _, pairs = match(wrapper, json.loads(shape.tree))
        known = [(b, a[1]) for a, b in pairs if b[1] >= 0 and a[1] is not None and len(a[1][2]) >= TITLES]
        fixed = [b[1] for b, (least, greatest, _) in known if least == greatest]
        varied = [b[1] for b, (least, greatest, _) in known if least != greatest and b[0].endswith("?")]
        if fixed or varied:
            rows.append((shape.host, shape.shape, sorted(fixed), sorted(varied)))
    return pd.DataFrame(rows, columns=["host", "shape", "fixed", "varied"])


def templates(parsed: DataFrame) -> DataFrame:
    """Parsed pages to (host, shape, fixed, varied): the template slots of every shape that has some."""
    seen = parsed.select("host", "shape", "title", "marks").mapInArrow(tidy(_seen), "host string, shape string, slot int, least long, greatest long, titles array<long>")
    titles = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_set("titles")))), 1, TITLES)  # a few of each task
    facts = seen.groupBy("host", "shape", "slot").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"), titles.alias("titles"))
    first, *later = PARTS
    # A shape's tree is written once by each task that meets it.
    trees = parsed.where("tree is not null").groupBy("host", "shape").agg(F.first("tree").alias("tree")).withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(first)))
    trees = stored(trees, "shapes")
    kinds = "host string, part long, tree string"
    merged = facts.join(trees, ["host", "shape"]).groupBy("host", "part").applyInPandas(_of_part, kinds)
    for n in later:
        merged = merged.withColumn("part", F.pmod("part", F.lit(n))).groupBy("host", "part").applyInPandas(_of_parts, kinds)
    parts = trees.select(F.col("host").alias("home"), F.col("part").alias("share")).distinct()
    wrappers = merged.select(F.col("host").alias("home"), F.col("tree").alias("wrapper")).join(parts, "home")
    shapes = trees.groupBy("host", "part").cogroup(wrappers.groupBy("home", "share"))
    return stored(shapes.applyInPandas(_template, "host string, shape string, fixed array<int>, varied array<int>"), "templates")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, url, host, html) to a row per page, ``PARSED``."""
    written: set[tuple[str, str]] = set()
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for host, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            root, title, marked = parse(page or "")
            found, tree = blocks(root, marked)
            text = json.dumps(tree, separators=(",", ":"))
            shape = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()
            by: dict[int, list[str]] = {}
            for block, slot, _ in found:
                by.setdefault(slot, []).append(block)
            new = bool(by) and (host, shape) not in written
            if new:
                written.add((host, shape))
                if len(written) > HELD:
                    written.clear()
            row = shape, text if new else None, _hash(title), [_hash("\n".join(by[i])) for i in range(len(by))], [b for b, _, _ in found], [i for _, i, _ in found], [d for _, _, d in found]
            for column, value in zip(columns, row):
                column.append(value)
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
        names = ["key", "url", "host", "shape", "tree", "title", "marks", "texts", "slots", "doubts"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array(v, t) for v, t in zip(columns, kinds))], names)


#: A parsed page: digest of its shape, the shape where the task hadn't written it yet, hashes of the title and of each slot's text, its blocks.
PARSED = "key long, url string, host string, shape string, tree string, title long, marks array<long>, texts array<string>, slots array<int>, doubts array<boolean>"


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars): the main text of every page."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), HOST, 1), F.lit("")))
    pages = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), host.alias("host"), F.col(html).cast("string").alias("html"))
    parsed = stored(pages.mapInArrow(tidy(_parsed), PARSED), "parsed")
    own = parsed.select("key", "url", "host", "shape", "texts", "slots", "doubts").withColumn("salt", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int"))
    known = templates(parsed).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    none = F.array().cast("array<int>")

    def stays(block):
        varied = F.array_contains(F.coalesce("varied", none), block["slots"])
        return ~F.array_contains(F.coalesce("fixed", none), block["slots"]) & (varied | ~block["doubts"])

    kept = F.filter(F.arrays_zip("texts", "slots", "doubts"), stays)
    text = F.array_join(F.transform(kept, lambda b: b["texts"]), "\n")
    out = own.join(known, ["host", "shape", "salt"], "left").select("key", "url", text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")).withColumnRenamed("key", key)
