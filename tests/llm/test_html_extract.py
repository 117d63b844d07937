import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import html_extract as he

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>if(a<b){"</p>"}</script></head>
<body class="post"><header class="site"><a href=1>Home</a> Some site</header><nav><ul><li><a href=2>About</a></ul></nav>
<div class="cookie-notice">We use cookies to improve our site. Accept them all.</div>
<div class=content><h1>The title</h1><p>First para with <a href=x>a link</a> in it, and it goes on for a while.
<p>Second &amp; more&nbsp;text<br>here, is &lt;also&gt; fine.<div class="ad">Buy now! It is cheap, and it is very good.</div>
<p>Short.</p><ul><li>One item of the list</li><li>Two items</ul><!-- gone --></div>
<div id="comments"><h3>Comments</h3><p>I think that this is a very long comment, it goes on and on, you know.</p></div>
<aside><p>More of this kind of thing is found elsewhere, if you look for it.</p></aside>
<form>Your name <input name=n> <button>Send it now</button></form><footer><p>Copyright 2020, all rights are reserved.</p></footer>
</body></html>"""


def test_article_without_its_surroundings():
    assert he.main_text(PAGE).split("\n\n") == [
        "The title", "First para with a link in it, and it goes on for a while.",
        "Second & more text here, is <also> fine.", "Short.", "One item of the list", "Two items"]


def test_wrappers_named_after_boilerplate():
    text = ["A title", "The first paragraph of the article goes on for a while, as they do.",
            "The second paragraph, too, has some words to say about it."]
    inner = f"<h1>{text[0]}</h1><p>{text[1]}</p><p>{text[2]}</p>"
    side = ('<div class="sidebar-left"><p>Read what others say of this, here and there.</p></div>'
            '<div id="main-nav"><a href=1>Home</a> <a href=2>About us</a></div><div class="site-footer"><p>Some rights.</p></div>')
    for wrapper in ('class="content has-sidebar"', 'id="page" class="header-fixed"', 'class="layout menu-left"'):
        for page in (f"<div {wrapper}>{inner}</div>{side}", f"<div {wrapper}><article>{inner}</article>{side}</div>",
                     f"<div {wrapper}><div class=content>{inner}</div>{side}</div>"):
            assert he.main_text(f"<body>{page}</body>").split("\n\n") == text, page
    page = f'<article><header class="entry-header"><h1>{text[0]}</h1></header><p>{text[1]}</p><p>{text[2]}</p></article>{side}'
    assert he.main_text(page).split("\n\n") == text


def test_attribute_values_are_no_names():
    head = "<article><h1>Title of it</h1><p>A first paragraph of the text that goes on for a while.</p>"
    for piece, want in (
            ('<p>See the <a href="/wiki/Hidden_Markov_model">Markov model</a> there.</p>', "See the Markov model there."),
            ('<p title="the hidden village">A hidden village is here.</p>', "A hidden village is here."),
            ('<p data-hidden="false">Some words that are shown.</p>', "Some words that are shown."),
            ('<div data-id="menu"><p>Not a menu but a paragraph.</p></div>', "Not a menu but a paragraph."),
            ("""<p data-role=banner title='id="menu" hidden'>Words of a paragraph.</p>""", "Words of a paragraph."),
            ("<ul><li><a href=1>First linked work</a></li><li><a href=2>Second linked work</a></li></ul>",
             "First linked work\n\nSecond linked work"),
            ("<p hidden>It is not shown at all.</p>", None), ('<p HIDDEN="">It is not shown at all.</p>', None),
            ('<ul class="menu"><li><a href=1>First linked work</a></li></ul>', None),
            ('<section id="discussion"><p>I think so too, it is very good and long.</p></section>', None)):
        texts = he.main_text(f"{head}{piece}</article>").split("\n\n", 2)[2:]
        assert texts == ([want] if want else []), piece


def test_deep_pages_take_time_in_proportion():
    import time

    start = time.monotonic()
    n = 60_000
    assert he.main_text("<article>" + "<div>" * n + "deep text is found here." + "</span></div>" * n) == "deep text is found here."
    page = "<article>" + "".join(f"<div><p>text {k} is here.</p>" for k in range(n))
    assert he.main_text(page).count("\n\n") == n - 1
    assert time.monotonic() - start < 60  # minutes, where every tag walks the whole depth


def test_broken_pages():
    for page in ("", " ", "<", "<<<>>>", "<p", "<!-- never closed", "<script>var a", "<p class='x", "</div></p>", "&", "a<b"):
        he.main_text(page)
    assert he.main_text("<article><p>One, two, three and four.<p>Five<b>six") == "One, two, three and four.\n\nFivesix"
    assert he.main_text("<article><p>A paragraph that is cut off in a ta<foo bar=\"x") == "A paragraph that is cut off in a ta"
    assert he.main_text("<article>" + "<p>Some words in a paragraph.</p>" * 3000).count("\n\n") == 2999
    assert he.main_text("<article>" + "<div>" * 3000 + "deep text is found here.") == "deep text is found here."


def cost(gain, edges, label):
    return sum(-g for g, x in zip(gain, label, strict=True) if x) + sum(w for a, b, w in edges if label[a] != label[b])


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 8).flatmap(lambda n: st.tuples(
    st.lists(st.integers(-6, 6), min_size=n, max_size=n),
    st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 6)), max_size=14))))
def test_minimum_cut_equals_enumeration(case):
    gain, edges = case
    edges = [(min(a, b), max(a, b), w) for a, b, w in edges if a != b]
    label = he.minimum_cut(gain, edges)
    every = list(itertools.product([False, True], repeat=len(gain)))
    least = min(cost(gain, edges, x) for x in every)
    assert cost(gain, edges, label) == least
    assert sum(label) == min(sum(x) for x in every if cost(gain, edges, x) == least)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = he.main_texts(pages).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    assert all("<" not in r.text or "&" in r.text for r in rows) and min(r.n_chars for r in rows) > 0


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, label int"
    rows = [(1, None, None, None, None, None), (None, "u", "", "t", "c", 1), (2, "u", PAGE, None, None, 2),
            (2, "u", PAGE, None, None, 2), (3, "u", "<article>" + "<p>word word. " * 20_000, None, None, 3)]
    out = he.main_texts(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((str(r.page_id), r.url, len(r.text), r.n_chars) for r in out.collect())
    n = len(he.main_text(PAGE))
    assert got[0][:2] == ("1", None) and got[0][2] == 0
    assert [g for g in got if g[0] == "2"] == [("2", "u", n, n)] * 2
    assert [g[2] for g in got if g[0] == "3"] == [20_000 * 10 + 19_999 * 2]
    assert he.main_texts(spark.createDataFrame([], schema)).collect() == []
