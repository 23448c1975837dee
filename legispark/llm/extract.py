"""The main text of web pages by a minimum cut over their blocks.

A page's markup is cut into blocks of text. A logistic classifier on a block's place, links and words gives the cost of
either label: the capacities to the two terminals. Its weights are mild, so that a heading, a list item, a linked line
or a table cell alone is in doubt. Edges of smoothness join each block to the one before it, the stronger the nearer the
two stand in the tree of elements, and to the last one of the same kind under the same element. The cheapest labelling
is the minimum cut, from a maximum flow. A block whose own costs outweigh all its edges is labelled at once, which moves
its edges into its neighbours' costs.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from legispark.llm import text as T

# Names in the HTML standard.
RAW = ["script", "style", "textarea", "iframe", "noembed", "noframes", "title"]
FOREIGN = {"svg", "math"}
INTEGRATION = {"foreignobject", "annotation-xml", "mtext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"article", "main"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "button", "center", "dd", "desc", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "metadata", "nav", "ol", "optgroup", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
NEVER = {"head", "button", "option", "optgroup", "select", "label", "desc", "metadata"}
#: Elements that any other block ends, and blocks that they may hold.
LOOSE, HELD = FOREIGN | {"select"}, {"option", "optgroup", "desc", "metadata", "button", "legend", "hr", "br"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote"}

#: Weights of the classifier: elements above a block, and words in their classes, ids and roles.
PLACES = {"article": 1.2, "main": 0.8, "nav": -2.6, "footer": -2.6, "aside": -2.6, "form": -2.6, "menu": -2.6, "header": -0.8, "dialog": -2.4, "p": 0.35, "blockquote": 0.3, "pre": 0.35, "h1": 0.2, "h2": 0.1, "h3": 0.1, "li": -0.3, "td": -0.2, "figcaption": -0.3, "svg": -0.2, "canvas": -0.1, "object": -0.1, "noscript": -0.1, "template": -3.0}
NAMES = {
    0.6: ["article", "content", "post", "story", "entry", "main", "text", "body"],
    -2.6: ["ad", "ads", "advert", "advertisement", "adverts", "banner", "sponsor", "sponsored", "promo", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "aside", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "toolbar", "widget", "pagination", "pager", "copyright", "search", "complementary", "contentinfo", "alert"],
    -1.0: ["header", "masthead", "top", "meta", "byline", "tags", "links", "utility"],
}
#: Words after these in a name say what a layout has or lacks, not what the element is.
MODIFIERS = {"has", "with", "no", "without"}
#: Words that say what a thing is like, not what it is; a compound name counts only if all its other words are known.
PLAIN = {"site", "page", "global", "primary", "secondary", "left", "right", "bottom", "upper", "lower", "inner", "outer", "box", "bar", "block", "area", "wrap", "wrapper", "container", "list", "item", "items", "section", "column", "col", "row", "button", "buttons", "icons", "slot", "unit", "form", "field", "posts", "articles", "stories", "media", "center", "fixed", "sticky", "mobile", "desktop"}
#: Names and elements of lists of short texts, which may be articles themselves.
LISTS = {"comment", "comments", "disqus", "reply", "replies", "related", "recommended", "promo", "sponsor", "sponsored", "ad", "ads", "advert", "adverts", "advertisement", "newsletter", "aside", "nav", "footer", "menu", "dialog"}
#: An element of this weight or less, or hidden, is boilerplate whatever holds it.
BOILERPLATE, HIDDEN, NOTHING = -2.4, -3.0, -20.0
#: What all blocks get on a page without any element for content.
BARE = 0.6
#: Log odds at most, of either sign.
MOST_ODDS = 20.0
NAME_WEIGHT = {name: w for w, names in NAMES.items() for name in names}
BIAS, PER_LINK, PER_WORD, MOST_WORDS, PER_STOP = -0.6, -1.6, 0.03, 40, 0.3
#: Edges: to the block before, for steps between the two in the tree; what entering or leaving boilerplate counts as in steps; to the last of its kind.
ADJACENT, BOUNDARY, KIN = 2.4, 8, 0.4

_OPENING = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*))", re.S)
_MARK = re.compile(r"[>\"']")
_END_OF = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_STOP = re.compile(r"[.!?…:;](?:\s|$)")


class Block:
    __slots__ = ("parent", "node", "parts", "linked", "weight", "tag", "above", "steps", "waste")

    def __init__(self, parent: int, node: int, tag: str):
        self.parent, self.node, self.tag, self.weight = parent, node, tag, 0.0
        self.above = self.waste = 0  # the element above, and the nearest boilerplate one, 0 for none
        self.steps = 1  # elements between it and the block before, along the tree
        self.parts: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()


class Tags:
    """Finds a page's tags, in one pass: a quote opens an attribute's value after a = alone, and if it is closed; a tag that isn't closed ends with the page."""

    def __init__(self, page: str):
        self.page = page
        self.quotes = {'"': True, "'": True}  # whether any may still come

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """From there on: start, end, whether it is an end tag, name (lowered; empty for comments and the like), attributes."""
        m = _OPENING.search(self.page, at)
        if not m or not m[2]:
            return m and (m.start(), m.end(), False, "", "")
        at = m.end()
        while mark := _MARK.search(self.page, at):
            at = mark.end()
            if mark[0] == ">":
                return m.start(), at, bool(m[1]), m[2].lower(), self.page[m.end() : at - 1]
            before = mark.start() - 1
            while before > m.end() and self.page[before].isspace():
                before -= 1
            if self.quotes[mark[0]] and self.page[before] == "=":
                close = self.page.find(mark[0], at)
                self.quotes[mark[0]] = close >= 0
                at = close + 1 if close >= 0 else at
        return m.start(), len(self.page), bool(m[1]), m[2].lower(), self.page[m.end() :]


def _names(tag: str, attributes: str) -> set[str]:
    """Known words of an element's classes, id and roles: whole names, and compounds that are nothing else."""
    names: set[str] = set()
    if "=" in attributes and tag not in ("html", "body"):
        for m in _NAMED.finditer(attributes):
            for word in (m[1] or m[2] or m[3] or "").lower().split():
                parts = _PART.findall(word)
                parts = parts[: next((k for k, part in enumerate(parts) if part in MODIFIERS), len(parts))]
                if all(part in NAME_WEIGHT or part in PLAIN or part.isdigit() for part in parts):
                    names.update(parts)
    return names & NAME_WEIGHT.keys()


def _wrappers(nodes: list[tuple[int, str, str]], names: list[set[str]], sizes: list[int]) -> set[int]:
    """Elements that hold a main, or the longest article that isn't in a list and is half of the main it is in."""
    inside, main = [False] * len(nodes), [0] * len(nodes)
    for k, (up, tag, _) in enumerate(nodes):
        inside[k] = inside[up] or tag in LISTS or not LISTS.isdisjoint(names[k])
        main[k] = k if tag == "main" else main[up]
    held = [k for k, n in enumerate(nodes) if n[1] == "main" and sizes[k]]
    articles = [k for k, n in enumerate(nodes) if n[1] == "article" and sizes[k] and not inside[k]]
    if articles:
        longest = max(articles, key=lambda k: sizes[k])
        if not main[longest] or 2 * sizes[longest] >= sizes[main[longest]]:
            held.append(longest)
    out: set[int] = set()
    for k in held:
        while (k := nodes[k][0]) and k not in out:
            out.add(k)
    return out


def _weigh(nodes: list[tuple[int, str, str]], found: list[Block]) -> None:
    """Sets the blocks' weights. The weights of elements add up, but what boilerplate holds has no more for being content."""
    sizes = [0] * len(nodes)
    for b in found:
        sizes[b.node] += sum(map(len, b.parts))
    for k in range(len(nodes) - 1, 0, -1):
        sizes[nodes[k][0]] += sizes[k]
    names = [_names(tag, attributes) for _, tag, attributes in nodes]
    wrappers = _wrappers(nodes, names, sizes)
    weights, bad = [0.0] * len(nodes), [0] * len(nodes)
    if not any(sizes[k] and (nodes[k][1] in CONTAINERS or any(NAME_WEIGHT[n] > 0 for n in names[k])) for k in range(len(nodes))):
        weights[0] = BARE
    for k, (up, tag, attributes) in enumerate(nodes[1:], 1):
        place = PLACES.get(tag, 0.0)
        known = [NAME_WEIGHT[n] for n in names[k]]
        named = min(known) if known and min(known) < 0 else max(known, default=0.0)
        if k in wrappers or tag == "form" and 2 * sizes[k] > sizes[0]:  # a page within one form
            place, named = 0.0 if tag == "form" else place, max([w for w in known if w > 0], default=0.0)
        hidden = HIDDEN if tag not in ("html", "body") and _HIDDEN.search(attributes) else 0.0
        own = NOTHING if tag in NEVER else min(place, 0.0) + min(named, 0.0) + hidden
        if tag in NEVER or min(place, named, hidden) <= BOILERPLATE:
            weights[k], bad[k] = min(weights[up], 0.0) + own, k
            continue
        content = 0.0 if bad[up] and (named > 0 or tag in CONTAINERS) else max(place, 0.0) + max(named, 0.0)
        weights[k], bad[k] = weights[up] + own + content, bad[up]
    depth = [0] * len(nodes)
    for k, n in enumerate(nodes[1:], 1):
        depth[k] = depth[n[0]] + 1
    before = None
    for b in found:
        b.weight, b.waste, b.above = weights[b.node], bad[b.node], nodes[b.node][0]
        if before:
            x, y, steps = before.node, b.node, 0
            while x != y:  # up from the deeper one; all blocks together climb no element more than twice
                if depth[x] < depth[y]:
                    x, y = y, x
                x, steps = nodes[x][0], steps + 1
            b.steps = max(1, steps) + (BOUNDARY if before.waste != b.waste else 0)
        before = b


def blocks(page: str) -> list[Block]:
    """Runs of text between the tags of block elements, in page order; scripts, styles, comments, titles, frames and typed texts left out.

    Other elements are only weighed. Blocks end an open svg, math or select, so that a missing end tag takes nothing along.
    """
    out: list[Block] = []
    nodes = [(0, "", "")]  # number of the element above, name, attributes
    stack: list[tuple[str, int]] = [("", 0)]  # name, number
    inside = {0}  # numbers of the open elements
    opened: Counter[str] = Counter()
    at, current = 0, None

    def close(k: int) -> None:
        """Ends the k-th open element and all within it."""
        opened.subtract(name for name, _ in stack[k:])
        inside.difference_update(n for _, n in stack[k:])
        del stack[k:]

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            if text.isspace():
                return
            near = next((s for s in reversed(stack) if s[0] in BLOCKS), stack[0])
            current = Block(near[1], stack[-1][1], near[0])
            out.append(current)
        if not text.isspace():
            while current.node not in inside:  # the least element that holds all of the block's text
                current.node = nodes[current.node][0]
        current.parts.append(text)
        if opened["a"]:
            current.linked += len(text)

    found = Tags(page)
    while tag := found.next(at):
        start, end, ends, name, attributes = tag
        add(page[at:start])
        at = end
        if not name:
            continue
        if name in BLOCKS:
            current = None
        if ends:
            if opened[name]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
            continue
        if name in RAW and not (attributes.endswith("/") and any(opened[x] for x in FOREIGN)):
            over = _END_OF[name].search(page, at)
            at = over.end() if over else len(page)
            continue
        if name in VOID:
            continue
        if name in BLOCKS and name not in HELD and any(opened[x] for x in LOOSE):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in INTEGRATION:
                    break
                if stack[k][0] in LOOSE:
                    close(k)
        for k in range(len(stack) - 1, 0, -1) if name in CLOSES else ():
            if stack[k][0] in CLOSES[name]:
                close(k)
            elif stack[k][0] in BLOCKS and stack[k][0] not in TEXT_BLOCKS:
                break
        if attributes.endswith("/"):
            continue
        opened[name] += 1
        nodes.append((stack[-1][1], name, attributes))
        stack.append((name, len(nodes) - 1))
        inside.add(len(nodes) - 1)
    add(page[at:])
    _weigh(nodes, out)
    return out


def chance(block: Block, text: str) -> float:
    """The classifier's log odds that a block is content."""
    raw = sum(map(len, block.parts)) or 1
    words = text.count(" ") + 1
    z = BIAS + block.weight + PER_LINK * block.linked / raw + PER_WORD * min(words, MOST_WORDS)
    return z + (PER_STOP if _STOP.search(text) else 0.0)


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that maximise the gains of those labelled true, less the weights of the edges whose ends differ."""
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in gain]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * len(gain)
    queue = deque(range(len(gain)))
    while queue:
        k = queue.popleft()
        if label[k] is None and abs(gain[k]) >= sum(near[k].values()):
            label[k] = gain[k] > 0
            for j, w in near[k].items():
                gain[j] += w if label[k] else -w
                del near[j][k]
                queue.append(j)
            near[k] = {}
    for part in _parts(near, [k for k in range(len(gain)) if label[k] is None]):
        place = {k: i for i, k in enumerate(part)}
        for k, side in zip(part, _source_side([gain[k] for k in part], [{place[j]: w for j, w in near[k].items()} for k in part]), strict=True):
            label[k] = side
    return [bool(x) for x in label]


def _parts(near: list[dict[int, float]], nodes: list[int]) -> Iterator[list[int]]:
    """The nodes that edges connect, each set on its own."""
    seen: set[int] = set()
    for first in nodes:
        if first not in seen:
            seen.add(first)
            part = [first]
            for k in part:
                fresh = [j for j in near[k] if j not in seen]
                seen.update(fresh)
                part += fresh
            yield part


def _source_side(gain: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Which nodes the source still reaches after a maximum flow: along all shortest paths at once, then along longer ones."""
    s, t = len(gain), len(gain) + 1
    room = [dict(n) for n in near] + [{}, {}]
    for k, g in enumerate(gain):
        a, b = (s, k) if g > 0 else (k, t)
        room[a][b], room[b][a] = abs(g), 0.0
    while True:
        depth = {s: 0}
        queue = deque([s])
        while queue:
            k = queue.popleft()
            for j, w in room[k].items():
                if w > 1e-12 and j not in depth:
                    depth[j] = depth[k] + 1
                    queue.append(j)
        if t not in depth:
            return [k in depth for k in range(len(gain))]
        left = [iter(list(r)) for r in room]  # each edge is given up at most once in a phase
        path = [s]
        while path:
            k = path[-1]
            if k == t:
                flow = min(room[a][b] for a, b in pairwise(path))
                for a, b in pairwise(path):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                cut = next(i for i, (a, b) in enumerate(pairwise(path)) if room[a][b] <= 1e-12)
                del path[cut + 1 :]
                continue
            for j in left[k]:
                if room[k][j] > 1e-12 and depth.get(j) == depth[k] + 1:
                    path.append(j)
                    break
            else:
                path.pop()


def network(found: list[tuple[Block, str]]) -> tuple[list[float], list[tuple[int, int, float]]]:
    """The blocks' log odds and the edges between them."""
    gain = [max(-MOST_ODDS, min(MOST_ODDS, chance(b, t))) for b, t in found]
    last: dict[tuple[int, str], int] = {}
    edges = []
    for k, (b, _) in enumerate(found):
        if k:
            edges.append((k - 1, k, ADJACENT / b.steps))
        kind = (b.parent if b.parent != b.node else b.above, b.tag)
        if kind in last and found[last[kind]][0].waste == b.waste:
            edges.append((last[kind], k, KIN))
        last[kind] = k
    return gain, edges


def main_text(page: str) -> str:
    """The content blocks of a page, joined by spaces; empty if there are none."""
    found = [(b, t) for b in blocks(page) if (t := b.text())]
    return " ".join(t for (_, t), keep in zip(found, minimum_cut(*network(found)), strict=True) if keep)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages' columns but for the markup, and text, n_chars (code points).

    Null, empty and textless markup give an empty text; markup that breaks off ends its open elements. Rows that repeat
    are each extracted; an empty table gives an empty result. Columns named like the new ones are replaced.
    """

    def values(pages: pa.Array) -> list:
        text = [main_text(p) for p in pages.to_pylist()]
        return [pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]

    return T.annotated(pages, html_col, {"text": "string", "n_chars": "bigint"}, values)
