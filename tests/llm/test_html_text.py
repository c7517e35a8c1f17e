import html
import itertools
import random
import re

from tallyloom.llm import html_text as ht
from tallyloom.llm.catalog import QUERIES


def plain(page):
    """The one <article> of the given pages, block by block."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    out = []
    for part in re.split(r"</?(?:h1|p)>", body):
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))).split())
        if text:
            out.append(text)
    return "\n".join(out)


def test_query_against_the_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op1_html_extraction"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        want = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


PAGE = """<html><body class="has-sidebar"><header class="site-header"><h1>Site name</h1><a href=/>home</a></header>
<div id="cookie-notice">We use cookies to improve your experience on this site, accept them please, thank you very much indeed, all of you out there who read this.</div>
<ul class="main-menu"><li><a href=1>One</a><li><a href=2>Two</a></ul>
<aside><p>Related stories you might like to read this long weekend in the sun and so on and on and on for a while.</p></aside>
<form action=x><main><div class="post-content"><header><h2>Title &amp; more</h2><p>By someone</p></header><p>First paragraph of the story, with a <a href="a>b">link</a> and&nbsp;text   that
goes on.</p><form><label>Name</label><input><button>Send</button></form><p>Short.</p><ul><li>one item<li>two</ul>
<div class="ad-slot">Buy now</div><div class=newsletter-signup>Subscribe</div><p>Second paragraph<br>after a break, with &lt;tags&gt; and &#8364; and &eacute.</p><p hidden>not shown</p><p style="display: none">nor this</p>
<noscript>Please enable scripts</noscript><style>p{}</style><!-- <p>not this</p> --></div>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I like this article very much indeed, thank you for writing it down for us all, it is a joy to read on a day like this.</p></div></section>
</main></form><footer>&copy; 2024</footer><script>if (a<b) { x("<article><p>no</p></article>") }</script></body></html>"""


def test_kinds_of_boilerplate_go():
    want = ["Title & more", "First paragraph of the story, with a link and text that goes on.", "Short.", "one item", "two", "Second paragraph after a break, with <tags> and € and é."]
    assert ht.main_text(PAGE).split("\n") == want


def test_pages_without_article():
    page = '<div class="nav"><a href=1>a</a><a href=2>b</a></div><div><p>This page has no article element at all, but it does have a long paragraph.</p><p>And another one, with some more words in it.</p></div><div id=footer>c</div><a href="open'
    assert ht.main_text(page) == "This page has no article element at all, but it does have a long paragraph.\nAnd another one, with some more words in it."
    assert ht.main_text("just text < 5 &amp; more") == "just text < 5 & more"
    assert ht.main_text("<article><p>cut off he") == "cut off he"


def test_min_cut_against_all_cuts():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(1, 7)
        source, sink = ([rng.choice([0, 1, 2, 5, 9]) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.6]

        def cost(side):
            return sum(sink[i] if side[i] else source[i] for i in range(n)) + sum(c for a, b, c in edges if side[a] != side[b])

        assert cost(ht.min_cut(source, sink, edges)) == min(cost(s) for s in itertools.product([False, True], repeat=n))


def test_ties_carry_a_doubtful_block():
    found = [ht.Block("a " * 30, 0, (1, 2, k), frozenset(["article"]), "p") for k in (3, 5)]
    found.insert(1, ht.Block("x", 0, (1, 2, 4), frozenset(), "div"))
    alone = ht.log_odds(found[1], True)
    assert alone < 0 and ht.label([found[1]]) == [False]
    found[1].kinds = frozenset(["content"])
    assert ht.log_odds(found[1], True) < 0


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "<article>" + "<p>word word</p>" * 20000 + "</article>"), (5, "u", "<div>" * 20000 + "<p>deep</p>"), (6, "u", '<a "' * 5000), (6, "u", "<b>x</i></b>"), (None, "u", "<p>İ<script>x</SCRIPT>y</p>")]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = ht.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[3] == "" and by[4] == "\n".join(["word word"] * 20000) and by[5] == "deep" and by[None] == "İy"
    assert ht.extract(df.limit(0)).count() == 0


LONG = "This paragraph belongs to the story and says at some length what the story is about, so that nobody could take it for a line of a menu or for a note beside the text of the page at all."


def test_names_of_sections_and_paragraphs_are_weak():
    """Words in the names of a section, heading or paragraph do not outweigh an article or a long paragraph."""
    menu = '<nav><a href=1>one</a></nav>'
    page = f'{menu}<article><h1>Title</h1><p>{LONG}</p><section id="discussion"><h2 id="related-work">Discussion</h2><p>{LONG}</p></section></article>'
    assert ht.main_text(page) == f"Title\n{LONG}\nDiscussion\n{LONG}"
    page = f'{menu}<article><section class="section toc-section"><p>{LONG}</p></section></article>'
    assert ht.main_text(page) == LONG
    page = f'{menu}<div class="content"><p class="has-share-text">{LONG}</p></div><div class="related-posts"><p>{LONG}</p></div>'
    assert ht.main_text(page) == LONG
    page = f'<article><p>{LONG}</p><section id="comments"><h3>Comments</h3><div class="comment-body"><p>{LONG}</p></div></section></article>'
    assert ht.main_text(page) == LONG


def test_ties_do_not_depend_on_depth():
    """Neighbours keep their tie however deep they stand, and however different their depths are."""
    for depth in range(5, 61, 5):
        deep = "<div>" * depth
        found = ht.blocks(f"{deep}<p>a</p><p>b</p><div><div><p>c</p></div></div>")
        assert [ht.apart(x.place, y.place) for x, y in zip(found, found[1:])] == [2, 4]
        page = f'<div class=nav><a href=1>x</a></div>{deep}<p>{LONG}</p><div><div><p>short</p></div></div><p>{LONG}</p>'
        assert ht.main_text(page) == f"{LONG}\nshort\n{LONG}"
    assert ht.apart(ht.Place.of((1, 2, 3)), ht.Place.of((1, 4))) == 3
