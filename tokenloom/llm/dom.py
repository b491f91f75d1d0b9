"""A small tolerant HTML tree, and simple tree matching, for operator 4."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import xxhash

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends an open element of the value, up to a scope.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}, "body": {"head"},
}
SCOPE = frozenset("table ul ol dl select article section main div body html".split())

#: What may start a tag, a comment or a declaration.
_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|[!?])")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"[0-9]+")


class Node:
    """An element, or a text (tag "#text", `text` set)."""

    __slots__ = ("tag", "attrs", "children", "text", "label", "size", "sum", "kinds")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, text: str = "", label: str = ""):
        self.tag, self.attrs, self.text = tag, attrs or {}, text
        self.children: list[Node] = []
        self.label = label or tag
        self.size = 0


class _TagEnds:
    """Where tags end: at the first ">" outside quotes.  A page whose quotes do
    not close is read without them from there on, so every page takes linear time."""

    def __init__(self, html: str):
        self.html, self.last, self.plain = html, html.rfind(">"), False

    def after(self, at: int) -> int:
        """Place of the ">" that ends the tag read up to `at`; -1 if there is none."""
        if at > self.last:
            return -1
        spot = at
        while not self.plain:
            m = _STOP.search(self.html, spot)
            if m is not None and m[0] == ">":
                return m.start()
            closed = self.html.find(m[0], m.end()) if m is not None else -1
            self.plain = closed < 0
            spot = closed + 1
        return self.html.find(">", at)


def _read_tag(tag: str, given: str) -> tuple[dict[str, str] | None, str]:
    """(attributes, label) of a start tag; attributes are read, never changed."""
    attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTR.findall(given)} if given.strip(" /\n\t\r") else None
    if attrs and ("class" in attrs or "id" in attrs):  # numbers in them name the page, not the layout
        return attrs, _DIGITS.sub("", f"{tag}.{' '.join(attrs.get('class', '').split()[:1])}#{attrs.get('id', '')}")
    return attrs, tag


#: Pages of a host repeat their tags: the last used short ones are read once.
_tag_read = lru_cache(4096)(_read_tag)
LONG_TAG = 256


def _closes_itself(given: str) -> bool:
    """Whether attributes end in a "/" that is not part of an unquoted value."""
    return given.endswith("/") and ("=" not in given.split()[-1] or given[-2] in "\"'")


def parse(html: str) -> Node:
    """The page's tree, of any depth; never fails, whatever the markup."""
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()
    ends_of = _TagEnds(html)
    at, end = 0, len(html)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            stack[-1].children.append(Node("#text", None, unescape(raw)))
        elif raw:
            stack[-1].children.append(Node("#text", None, " "))

    def close(i: int) -> None:
        for n in stack[i:]:
            opened[n.tag] -= 1
        del stack[i:]

    while at < end:
        m = _MARK.search(html, at)
        if m is None:
            text(html[at:])
            break
        mark = m.start()
        if m[2] is None:
            opening, closing = ("<!--", "-->") if html.startswith("<!--", mark) else ("<![CDATA[", "]]>")
            if html.startswith(opening, mark):
                stop = html.find(closing, mark + len(opening))
                stop, after = (end, end) if stop < 0 else (stop, stop + len(closing))
            else:
                stop = html.find(">", mark) if mark < ends_of.last else -1
                if stop < 0:
                    text(html[at:])
                    break
                after = stop + 1
            if mark > at:
                text(html[at:mark])
            at = after
            continue
        named = m.end()
        stop = named if html.startswith(">", named) else ends_of.after(named)
        if stop < 0:  # no later tag ends either
            text(html[at:])
            break
        if mark > at:
            text(html[at:mark])
        at = stop + 1
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if opened["p"] > 0 and tag in BLOCK and tag not in ("td", "th", "tr", "caption"):  # a block ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        ends = CLOSES.get(tag)
        if ends and any(opened[t] > 0 for t in ends):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    if tag not in ("tr", "tbody", "thead"):
                        break
                elif stack[i].tag in SCOPE:
                    break
        given = html[named:stop]
        attrs, label = (_tag_read if len(given) <= LONG_TAG else _read_tag)(tag, given)
        node = Node(tag, attrs, "", label)
        stack[-1].children.append(node)
        if tag in RAW:
            shut = re.compile(rf"</{tag}", re.I).search(html, at)
            stop = html.find(">", shut.end()) if shut else -1
            at = stop + 1 if stop >= 0 else end
        elif tag not in VOID and not _closes_itself(given):
            stack.append(node)
            opened[tag] += 1
    return root


#: Lists whose lengths multiply to at most this are aligned by dynamic programming.
CELLS = 4096


def measured(root: Node) -> Node:
    """The tree with `size` and `sum` (checksum of labels and texts) of every
    subtree set; `kinds` (labels and checksums of the children) is counted when
    a weight asks for it.  A tree already measured, as a reference is by every
    page of its group, stays as it is."""
    if root.size:
        return root
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += n.children
    for n in reversed(order):
        size, sums = 1, [n.label, n.text]
        for c in n.children:
            size += c.size
            sums.append(c.sum)
        n.size, n.sum, n.kinds = size, hash(tuple(sums)), None
    return root


def _kinds(n: Node) -> dict:
    if n.kinds is None:
        n.kinds = kinds = {}
        for c in n.children:
            kinds[c.label] = kinds.get(c.label, 0) + 1
            kinds[c.sum] = kinds.get(c.sum, 0) + 1
    return n.kinds


def _weight(a: Node, b: Node) -> int:
    """How well two subtrees fit, by one rule whatever their sizes: equal ones
    by their size, others by the children that both have, of equal label and of
    equal content."""
    if a.label != b.label:
        return 0
    if a.tag == "#text":
        return 2 if a.text == b.text else 1
    if a.sum == b.sum:
        return a.size + 1
    few, many = _kinds(a), _kinds(b)
    if len(few) > len(many):
        few, many = many, few
    total = 1
    for k, n in few.items():
        other = many.get(k, 0)
        total += n if n < other else other
    return total


def _aligned(x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
    """Pairs of two lists of children, in order, with equal labels and the most weight."""
    if not x or not y:
        return []
    if len(x) == len(y) == 1:
        return [(x[0], y[0])] if x[0].label == y[0].label else []
    if len(x) * len(y) > CELLS:
        # long lists: children that are equal and single in both part them; what
        # is still long is paired from the front, label by label
        one_x, one_y = (Counter(n.sum for n in z) for z in (x, y))
        spots = {n.sum: j for j, n in enumerate(y) if one_y[n.sum] == 1}
        out, i0, j0 = [], 0, 0
        cuts = []
        for i, n in enumerate(x):
            j = spots.get(n.sum) if one_x[n.sum] == 1 else None
            if j is not None and j >= j0:
                cuts.append((i, j))
                j0 = j + 1
        j0 = 0
        for i, j in [*cuts, (len(x), len(y))]:
            px, py = x[i0:i], y[j0:j]
            out += _aligned(px, py) if len(px) * len(py) <= CELLS else _in_order(px, py)
            if i < len(x):
                out.append((x[i], y[j]))
            i0, j0 = i + 1, j + 1
        return out
    w = [[_weight(p, q) if p.label == q.label else 0 for q in y] for p in x]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, given in enumerate(w):
        above, row = best[i], best[i + 1]
        for j, v in enumerate(given):
            row[j + 1] = max(above[j] + v if v else 0, above[j + 1], row[j])
    i, j, out = len(x), len(y), []
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((x[i], y[j]))
    return out[::-1]


def _in_order(x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
    """Each child with the next one of its label not yet passed."""
    later: dict[str, list[int]] = {}
    for j in range(len(y) - 1, -1, -1):
        later.setdefault(y[j].label, []).append(j)
    out, at = [], 0
    for n in x:
        spots = later.get(n.label, [])
        while spots and spots[-1] < at:
            spots.pop()
        if spots:
            at = spots.pop()
            out.append((n, y[at]))
            at += 1
    return out


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of two trees, top down and in order: the size of
    the matching (an equal text counts twice) and the matched text nodes.  Only
    children that are aligned are entered, so the time is near linear in the
    trees' sizes, whatever their depth."""
    if a.label != b.label:
        return 0, []
    measured(a), measured(b)
    size, texts, stack = 0, [], [(a, b)]
    while stack:
        p, q = stack.pop()
        size += 1
        if p.tag == "#text":
            size += p.text == q.text
            texts.append((p, q))
        else:
            stack += reversed(_aligned(p.children, q.children))
    return size, texts


def below(place: int, label: str) -> int:
    """The place of an element with this label inside an element at `place`."""
    return xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), place)


def texts(node: Node, place: int = 0) -> Iterator[tuple[Node, int]]:
    """Text nodes in page order, with the place that they stand in."""
    stack = [(node, place)]
    while stack:
        n, at = stack.pop()
        if n.tag == "#text":
            yield n, at
        elif n.children:
            inside = below(at, n.label)
            stack += [(c, inside) for c in reversed(n.children)]
