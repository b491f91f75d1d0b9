"""Operator 4, HTML extraction by wrapper induction.

Pages are grouped by host and layout (the sectioning elements they use, in
order of first appearance).  Every page of a group is aligned with the group's
reference, the page of smallest hash, by simple tree matching.  An aligned text
is counted as (place, text), its place being the labels it stands in; the
counts cover all pages and are pre-aggregated in the tasks, so a hot host is
spread over its places.  A wrapper has two parts:

- template: the (place, text) that are constant, aligned on at least SHARE of
  the group's pages, and on LEAST pages;
- region: the innermost container with at least REGION of the group's varying
  text, where links and what markup calls no article do not count.

Every page is then read through its wrapper.  Its content is the articles or
<main> that the markup names and that lie in the region or around it, else the
region itself and the <h1> before it.  Inside a named article nothing is taken
for template; elsewhere template texts go, but for headings, and but for pages
that are mostly template (copies of each other say nothing about a template).
Groups of fewer pages have no wrapper; there the markup alone decides.  Inside
the content, elements for menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments go by their tag, role, class or id, as such
slots vary like any other.

Defined results: null html counts as empty; no text gives "" and 0; pages
without a url share one host; one row per input row; other columns are ignored;
lists, depth and length of a page are not limited, and unclosed markup takes
linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import fits, kept, rows_of, slices, written
from tokenloom.llm.dom import BLOCK, Node, below, match, parse, texts
from tokenloom.session import spread

#: A text is template if it is aligned on this share of a group's pages, and on so many.
SHARE, LEAST = 0.5, 3
#: Share of a group's varying text that the region holds.
REGION = 0.6
#: A page whose text is template to a larger share than this is a copy.
COPY = 0.5
#: Containers around a text that can be its region, from the page down.
LEVELS = 16
#: Elements that can be a region.
CONTAINERS = frozenset("html body main article section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Elements, roles, and words of classes and ids that are not article.
SKIP_TAGS = frozenset(
    "head script style noscript template iframe svg canvas object form button select textarea input nav footer aside dialog menu "
    "title audio video map math datalist label".split()
)
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())
SKIP_WORDS = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|topnav|subnav|menu|menus|breadcrumbs?|masthead|banner|footer|foot|sidebar|sidebars|widget|widgets|"
    r"ad|ads|adv|advert|adverts|advertisement|advertising|advertorial|adbox|adsbox|sponsor|sponsored|sponsors|promo|promos|promotion|"
    r"cookie|cookies|consent|gdpr|notice|notices|notification|popup|modal|overlay|newsletter|subscribe|subscription|signup|paywall|"
    r"share|sharing|social|comment|comments|commentlist|disqus|replies|respond|login|search|searchbox|"
    r"pagination|pager|skip|toolbar|copyright|disclaimer)(?:$|[\s_-])",
    re.I,
)
#: Words that name lists of links, but also parts of an article: there, only if most of the text is links.
LINK_WORDS = re.compile(r"(?:^|[\s_-])(?:related|recommended|recommendations|legal)(?:$|[\s_-])", re.I)
MAIN = re.compile(r"(?:^|\s)(?:article|post|entry|story|article-body|articlebody|post-content|entry-content|post-body|story-body|main-content|content|main)(?:$|\s)", re.I)


def skipped(n: Node, in_main: bool) -> bool:
    """Whether the element is, by its markup, not part of an article."""
    if n.tag in SKIP_TAGS or n.tag == "header" and not in_main:
        return True
    a = n.attrs
    if not a or n.tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    if a.get("role", "").lower() in SKIP_ROLES:
        return True
    names = (a.get("class", ""), a.get("id", ""))
    if any(map(SKIP_WORDS.search, names)):
        return True
    return any(map(LINK_WORDS.search, names)) and (not in_main or _mostly_links(n))


def _mostly_links(n: Node) -> bool:
    total = linked = 0
    stack = [(n, False)]
    while stack:
        x, link = stack.pop()
        size = len(x.text.strip())
        total, linked = total + size, linked + size * link
        stack += [(c, link or x.tag == "a") for c in x.children]
    return 2 * linked > total


def main_parts(root: Node) -> list[Node]:
    """The outermost articles; else <main>; else elements named like content; else none."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "named": []}

    def visit(n: Node, inside: frozenset) -> None:
        stack = [(n, inside)]
        while stack:
            n, inside = stack.pop()
            if n.tag == "#text" or skipped(n, bool(inside)):
                continue
            role = n.attrs.get("role", "").lower()
            kind = "article" if n.tag == "article" or role == "article" else "main" if n.tag == "main" or role == "main" else None
            if kind is None and n.attrs and n.tag in ("div", "section", "td"):
                if MAIN.search(n.attrs.get("class", "")) or MAIN.search(n.attrs.get("id", "")):
                    kind = "named"
            if kind and kind not in inside:
                found[kind].append(n)
                inside = inside | {kind}
            stack += [(c, inside) for c in reversed(n.children)]

    visit(root, frozenset())
    for kind in ("article", "main", "named"):
        if any(not t.text.isspace() for n in found[kind] for t, _ in texts(n)):
            return found[kind]
    return []


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _key(place: int, text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(" ".join(text.split()).encode("utf-8", "replace"), place))


def slots(page: Node, reference: Node) -> Iterator[tuple[int, list[int], int]]:
    """(key of place and text, containers from the page down, characters) of
    every text of the page.  Only aligned texts have a key (others 0), and only
    texts that are neither links nor outside articles by markup have characters."""
    aligned = {id(p) for p, _ in match(page, reference)[1]}
    stack: list = [(page, 0, (), True)]
    while stack:
        n, place, around, counts = stack.pop()
        if n.tag == "#text":
            if not n.text.isspace():
                yield (_key(place, n.text) if id(n) in aligned else 0), list(around), len(n.text.strip()) if counts else 0
            continue
        counts = counts and n.tag != "a" and not skipped(n, False)
        place = below(place, n.label)
        if n.tag in CONTAINERS and len(around) < LEVELS:
            around = (*around, _signed(place))
        stack += [(c, place, around, counts) for c in reversed(n.children)]


def induce(pages: list[str]) -> list[int]:
    """The template of one group of pages, in plain Python; `wrappers` does the
    same for all groups."""
    trees = [parse(p) for p in pages]
    found = Counter(k for t in trees for k in {k for k, _, _ in slots(t, trees[0])} if k)
    return sorted(k for k, n in found.items() if n >= max(LEAST, SHARE * len(pages)))


def _content(root: Node, region: int | None) -> tuple[list[Node], bool]:
    """The parts of the page that are its content, and whether markup names them."""
    named = main_parts(root)
    if region is None:
        return (named, True) if named else ([root], False)
    up: dict[int, Node] = {}
    found: list[Node] = []
    first: list[Node] = []
    stack = [(root, 0, False)]
    while stack:
        n, place, inside = stack.pop()
        place = below(place, n.label)
        if not inside and n.tag in CONTAINERS and _signed(place) == region:
            found.append(n)
            inside = True
        elif n.tag == "h1" and not inside and not found:
            first.append(n)
        if not inside and skipped(n, False):
            continue
        for c in reversed(n.children):
            if c.tag != "#text":
                up[id(c)] = n
                stack.append((c, place, inside))

    def within(n: Node | None, others: list[Node]) -> bool:
        ids = {id(o) for o in others}
        while n is not None and id(n) not in ids:
            n = up.get(id(n))
        return n is not None

    if not found:
        return (named, True) if named else ([root], False)
    around = [n for n in named if within(n, found) or any(within(f, [n]) for f in found)]
    if around:
        return around, True
    return first[-1:] + found, False


def extract(html: str, template: frozenset[int] = frozenset(), region: int | None = None) -> str:
    """The blocks of the page's article, white space collapsed, joined by a blank line."""
    root = parse(html)
    parts, named = _content(root, region)
    whole = parts == [root]
    places = dict(_element_places(root, parts)) if template and not named else {}
    if places:
        sizes = [(len(t.text), _key(at, t.text) in template) for p in parts for t, at in texts(p, places[id(p)]) if not t.text.isspace()]
        if sum(n for n, same in sizes if same) > COPY * sum(n for n, _ in sizes):
            places = {}
    blocks: list[str] = []
    run: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(run).split())
        # where nothing names the article or its region, blocks that are mostly links are menus
        if text and not (whole and links > 0.6 * len(text)):
            blocks.append(text)
        run.clear()
        links = 0

    for part in parts:
        # an element's place, or None where nothing is taken for template
        stack: list = [(part, places.get(id(part)), False, False)]
        while stack:
            n, place, linked, leave = stack.pop()
            if leave:
                flush()
            elif n.tag == "#text":
                if place is None or n.text.isspace() or _key(place, n.text) not in template:
                    run.append(n.text)
                    links += len(n.text.strip()) if linked else 0
            elif n.tag == "br":
                run.append(" ")
            elif not skipped(n, not whole):
                block = n.tag in BLOCK
                if block:
                    flush()
                    stack.append((n, place, linked, True))
                inside = None if place is None or n.tag in HEADINGS and n is not part else below(place, n.label)
                stack += [(c, inside, linked or n.tag == "a", False) for c in reversed(n.children)]
            else:
                if n.tag in BLOCK:
                    flush()
        flush()
    return "\n\n".join(blocks)


def _element_places(root: Node, wanted: list[Node]) -> Iterator[tuple[int, int]]:
    """(id, place that it stands in) of the wanted elements."""
    ids = {id(n) for n in wanted}
    stack = [(root, 0)]
    while stack:
        n, place = stack.pop()
        if id(n) in ids:
            yield id(n), place
        inside = below(place, n.label)
        stack += [(c, inside) for c in n.children if c.tag != "#text"]


#: Sectioning elements, whose order of first appearance is a page's layout.
LAYOUT = r"(?i)<(header|nav|main|article|section|aside|footer|form|table|frameset)[\s>]"
#: Largest sum of reference pages that is broadcast; more are joined by a shuffle.
REFERENCE_BYTES = 16 << 20


def _parsed(html: str, trees: dict[str, Node]) -> Node:
    """The reference's tree, from the few last used in this worker."""
    if html not in trees:
        if len(trees) >= 64:
            trees.clear()
        trees[html] = parse(html)
    return trees[html]


def wrappers(rows: DataFrame) -> DataFrame:
    """(of, template, region) of every group of at least LEAST pages; `rows` has grp, html."""
    pages = rows.where("html <> ''")
    refs = pages.groupBy("grp").agg(F.min_by("html", F.struct(F.xxhash64("html"), F.length("html"))).alias("ref"), F.count("*").alias("n"))
    refs = written(refs.where(F.col("n") >= LEAST).select(F.col("grp").alias("of"), "ref", "n"), "references")
    bytes_ = refs.agg(F.sum(F.octet_length("ref"))).first()[0] or 0
    joined = spread(pages).join(F.broadcast(refs) if bytes_ <= REFERENCE_BYTES else refs, F.col("grp") == F.col("of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = kept(("html",), dict)
        for b in slices(batches):
            of, keys, around, chars, first = [], [], [], [], []
            for grp, html, ref in zip(*(c.to_pylist() for c in b.columns)):
                seen = set()
                for k, a, n in slots(parse(html), _parsed(ref, trees)):
                    of.append(grp), keys.append(k), around.append(a), chars.append(n)
                    first.append(int(k not in seen))
                    seen.add(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of, pa.int64()), pa.array(keys, pa.int64()), pa.array(around, pa.list_(pa.int64())), pa.array(chars, pa.int64()), pa.array(first, pa.int64())],
                ["of", "key", "around", "chars", "first"],
            )

    found = joined.select("grp", "html", "ref").mapInArrow(run, "of long, key long, around array<long>, chars long, first long")
    # a text that a page has twice in one place counts once
    found = found.groupBy("of", "key", "around").agg(F.sum("first").alias("pages"), F.sum("chars").alias("chars"))
    found = written(found, "slots")
    counts = found.where("key <> 0").groupBy("of", "key").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= LEAST)
    sizes = refs.select(F.col("of").alias("g"), "n")
    constant = counts.join(sizes, F.col("of") == F.col("g")).where(F.col("pages") >= SHARE * F.col("n")).select("of", "key")
    constant = written(constant, "template")
    template = constant.groupBy("of").agg(F.sort_array(F.collect_list("key")).alias("template"))
    varying = found.where("chars > 0").join(constant, ["of", "key"], "left_anti")
    held = varying.groupBy("of", "around").agg(F.sum("chars").alias("chars"))
    total = held.groupBy(F.col("of").alias("g")).agg(F.sum("chars").alias("all"))
    held = held.select("of", "chars", F.posexplode("around").alias("level", "place")).groupBy("of", "level", "place").agg(F.sum("chars").alias("chars"))
    held = held.join(total, F.col("of") == F.col("g")).where(F.col("chars") >= REGION * F.col("all"))
    region = held.groupBy(F.col("of").alias("r")).agg(F.max_by("place", "level").alias("region"))
    base = refs.select("of").join(template.withColumnRenamed("of", "t"), F.col("of") == F.col("t"), "left")
    base = base.join(region, F.col("of") == F.col("r"), "left")
    return base.select("of", F.coalesce("template", F.array().cast("array<long>")).alias("template"), "region")


#: Most wrapper entries that are broadcast (about 8 MB); more wrappers are joined by a shuffle.
BROADCAST_ENTRIES = 1 << 20


def grouped(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, grp): pages with the group of their host and layout."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#:]*)", 1)), F.lit(""))
    layout = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LAYOUT), F.lit(1)), F.lower))
    return rows_of(pages, "page_id", "url", "html").withColumn("grp", F.xxhash64(host, F.array_join(layout, " ")))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages`."""
    rows = grouped(pages)
    found = written(wrappers(rows), "wrappers")
    small = fits(found.select(F.explode_outer("template")), BROADCAST_ENTRIES)
    joined = spread(rows).join(F.broadcast(found) if small else found, F.col("grp") == F.col("of"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [extract(h, frozenset(t or ()), r) for h, t, r in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "template", "region").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
