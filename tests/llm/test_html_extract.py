from helpers import words

from tokenloom.llm import dom
from tokenloom.llm.dom import match, parse, texts
from tokenloom.llm.html_extract import extract, extract_pages, grouped, induce, wrappers

SCHEMA = "page_id long, url string, html string, template string, host string, text string"


def page(body, nav="Home", extra=""):
    return f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href='/'>{nav}</a></nav>{body}<footer>&copy; us</footer>{extra}"


def test_article_alone_is_kept():
    html = page(
        "<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies</div><aside>side</aside><form>mail <input></form>"
        "<article><h1>A &amp; B</h1><p><b>First\n  line&nbsp;here<br>more<br><p>Second &lt;x&gt; &#233;</p><div class='ad'>Buy</div>"
        "<ul><li>one<li>two</ul><section class='comments'><p>troll</p></section></article>"
    )
    assert extract(html) == "A & B\n\nFirst line here more\n\nSecond <x> é\n\none\n\ntwo"


def test_odd_markup_never_fails():
    assert extract("") == ""
    assert extract("plain & simple < 3") == "plain & simple < 3"
    assert extract("<p>a<!-- unclosed <p>b") == "a"
    assert extract("<article>" + "<div>" * 3000 + "deep" + "<p>" * 10) == "deep"
    assert extract("<article><script>x") == ""
    assert extract('<article><p title="a>b">c</p></bogus></article>') == "c"


def test_without_article_menus_and_template_go():
    pages = [
        f"<body><div class=x><a href=/>Menu one</a> <a href=/>Menu two</a></div><div><p>Published by us</p><p>text {k} is long enough {k}</p></div></body>"
        for k in ("alpha", "beta", "gamma", "delta")
    ]
    template = frozenset(induce(pages[:3]))
    assert template
    assert extract(pages[3], template) == "text delta is long enough delta"


def test_copies_are_no_template():
    same = page("<div><p>the very same article text, every word of it</p></div>")
    template = frozenset(induce([same, same, same.replace("every", "each")]))
    assert extract(same, template) == "the very same article text, every word of it"
    assert induce([same, same]) == []


def test_tree_matching_aligns_in_order():
    a, b = parse("<ul><li>x<li>y<li>z</ul>"), parse("<ul><li>x<li>z</ul>")
    size, pairs = match(a, b)
    assert size > 4 and all(p.tag == q.tag for p, q in pairs)
    assert [t.text for t, _ in texts(a)] == ["x", "y", "z"]


def test_table(spark):
    import random

    rng = random.Random(1)
    rows = [(i, f"http://host{i % 3}.org:80/p{i}", page(f"<article><h1>t{i}</h1><p>{words(rng, 9, ['a', 'b', f'w{i}'])}</p></article>"), "c", "c", "c") for i in range(30)]
    rows += [(30, None, None, "", "", ""), (31, "no host", "", "", "", ""), (31, "no host", "", "", "", ""), (None, "//h/x", "<p>" + "word " * 50000, "", "", "")]
    got = extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[7] == extract(rows[7][2])
    assert [r.text for r in got if r.page_id in (30, 31)] == ["", "", ""]
    assert extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def site(k, layout="div", title=None, extra=""):
    rng_words = " ".join(f"{k}w{i}" for i in range(40))
    return (
        f"<body><div class=top><a href=/>Home of the site</a></div><{layout} class='c{k}'><h1>{title or f'Title {k}'}</h1><p>Published by us</p>"
        f"<h2>Ingredients</h2><p>{rng_words}</p>{extra}</{layout}><div class=tail><p>All rights stay with the house</p><p>odd {k}</p></div></body>"
    )


def test_wrapper_of_an_unnamed_article(spark):
    """Without a named article the wrapper alone finds region and template; one
    page of another layout changes nothing; equal headings of articles stay."""
    rows = [(i, "http://one.org/x", site(i), "", "", "") for i in range(9)]
    rows += [(20, "http://one.org/gallery", "<body><div class=top><a href=/>Home of the site</a></div><table><tr><td>picture</td></tr></table></body>", "", "", "")]
    rows += [(30 + i, "http://two.org/x", site(i, "article"), "", "", "") for i in range(4)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i in range(9):
        assert got[i] == f"Title {i}\n\nIngredients\n\n" + " ".join(f"{i}w{j}" for j in range(40))
    assert got[20] == "picture"
    for i in range(4):  # nothing inside a named article is template
        assert got[30 + i].split("\n\n")[:3] == [f"Title {i}", "Published by us", "Ingredients"]


def test_wrappers_equal_plain_induction(spark):
    pages = [site(i % 7, extra=f"<ul><li>{i}<li>same item</ul>" * (i % 3)) for i in range(12)]
    rows = [(i, "http://one.org/x", h, "", "", "") for i, h in enumerate(pages)]
    found = wrappers(grouped(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    assert len(found) == 1 and found[0].region is not None
    orders = [induce([ref, *(p for p in pages if p is not ref)]) for ref in set(pages)]
    assert found[0].template in orders and found[0].template


def test_hostile_and_long_pages_take_linear_time():
    import time

    at = time.time()
    for bad in ('<a "', "<a b", '<a ">" ', "</style", "<div></b>", "<b><td>", "<!--", "<a '\""):
        extract(bad * 8000)
    grids = [parse("<table>" + "".join("<tr>" + "".join(f"<td>{k}{i}-{j}" for j in range(100)) for i in range(100)) + "</table>") for k in "ab"]
    assert len(match(*grids)[1]) == 10_000
    deep = "<div>" * 5000
    assert len(match(parse(deep + "a"), parse(deep + "b"))[1]) == 1
    assert time.time() - at < 10


def test_deep_menus_and_comments_are_still_seen():
    deep = "<div>" * 210
    assert extract(f"<article><p>text</p>{deep}<nav>MENU x</nav><section class=comments>troll</section>") == "text"


def test_link_words_inside_an_article():
    assert extract("<article><p>a b</p><div class='related-work legal'>Earlier studies</div></article>") == "a b\n\nEarlier studies"
    assert extract("<article><p>a b</p><div class='related'><a href=/>Read this too</a></div></article>") == "a b"


def test_all_pages_by_an_independent_reading(spark):
    """The pages of sf0.01 have one layout; a regex reading of it, without trees."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1|li|ul)>", re.sub(r"<br>", " ", inner[1] if inner else ""))
        texts_ = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
        want[r.page_id] = "\n\n".join(t for t in texts_ if t)
    assert got == want


def test_a_reference_is_measured_once():
    """A tree that every page of a group is matched with is not walked anew for each."""
    ref, html = dom.parse("<body><p class=x1>a</p><p class=x2>b</p></body>"), "<body><p class=x3>a</p><p>c</p></body>"
    size, texts = dom.match(dom.parse(html), ref)
    assert size == 5 and [(p.text, q.text) for p, q in texts] == [("a", "a")]
    mark = ref.children[0].children[1].sum = object()
    dom.match(dom.parse(html), ref)
    assert ref.children[0].children[1].sum is mark
