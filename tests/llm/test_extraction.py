import html as html_module
from itertools import product
from math import exp

import pytest

from fleetspan.llm import extraction as ex

SCHEMA = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def seen():
    return ex.layout_counts()


def test_marginals_are_exact(seen):
    model = ex.Model(seen)
    order = ex.elements(ex.Tree("<body><nav><a href=x>a b</a></nav><div><h1>t</h1><p>some <b>text</b></p></div></body>").root)
    got = model.marginals(order)
    place = {id(n): i for i, n in enumerate(order)}
    weights = {}
    for state in product((0, 1), repeat=len(order)):
        total = 0.0
        for n, y in zip(order, state, strict=True):
            total += model.prior[y] + sum(model.own[e][y] for e in ex.evidence(n) if e in model.own)
            if n.parent:
                total += model.step[ex.relation(n)][state[place[id(n.parent)]]][y]
        weights[state] = exp(total)
    for i, n in enumerate(order):
        want = sum(w for s, w in weights.items() if s[i]) / sum(weights.values())
        assert abs(got[id(n)] - want) < 1e-9


def text(seen, page):
    root = ex.Tree(page).root
    return ex.text_of(root, ex.Model(seen).marginals(ex.elements(root)))


def test_unseen_layout(seen):
    page = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><div id="top-menu" class="nav"><ul>
    <li><a href=/1>Home</a><li><a href=/2>World</a></ul></div><article><h1>The  big&nbsp;story</h1><p>First &amp; longest
    paragraph of the story with <em>many</em> words in it.<p>Second one, which also has quite some words in it.<form><p>Join
    our list</p><input></form><div class="advert">Buy things</div></article><div class="comments"><p>Nice story I must say,
    it was good to read.</p></div><footer><p>Copyright</p></footer>"""
    assert text(seen, page).split("\n") == [
        "The big story",
        "First & longest paragraph of the story with many words in it.",
        "Second one, which also has quite some words in it.",
    ]


STORY = "<h1>The story</h1><p>It begins with a long sentence of many words, as stories do.</p>{}<p>It goes on, and then it ends well.</p>"
LINES = ["The story", "It begins with a long sentence of many words, as stories do.", "It goes on, and then it ends well."]
NAV = "<nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>"
END = "<footer><p>All rights are reserved by the owner of this site.</p></footer>"

LONG = "<article><p>A long comment of a reader who does not come to an end, and so it goes on and on.</p></article>"


def story(inside=""):
    return STORY.replace("{}", inside)


# What surrounds the story, or stands inside of it, differs from the labelled layouts in names, nesting and texts.
UNSEEN = {
    "comments as articles": f"""{NAV}<article>{story()}</article><section id=comments><h2>3 comments</h2><article class=comment><p>I read all of
        this and I liked it very much, thank you.</p></article><article class=comment><p>Me too.</p></article></section>{END}""",
    "comments area": f"""{NAV}<main><article>{story()}</article></main><section class=comments-area><ol class=commentlist><li id=comment-7>
        <p>A reader has a lot to say about this story, and says it here at some length.</p></ol></section>{END}""",
    "notice inside main": f"{NAV}<main>{story('<div class=notice><p>We have changed our terms, please read them with care.</p></div>')}</main>{END}",
    "right column": f"{NAV}<div id=page><div id=maincol>{story()}</div><div id=rightcol><p>What else there is to see on this site, in one paragraph.</p></div></div>{END}",
    "comments beside the story in one wrapper": f"""<div class=wrap><div class=post-body>{story()}</div><div class="post-comments"><div><p>This is what I
        think of it, and there is more that I could say.</p></div></div></div>{END}""",
    "comments longer than the story": f"""{NAV}<article>{story()}</article><div class=disqus_thread>{LONG * 30}</div>{END}""",
    "advert and share links": f"{NAV}<article>{story('<div class=advert-box><p>Buy now, it is cheap and it is good.</p></div><div class=share-links><a href=/t>Tell</a></div>')}</article>",
    "newsletter inside": f"<article class=story>{story('<section class=newsletter><h3>Our letter</h3><p>Get it every week, for free, in your mail.</p></section>')}</article>{END}",
    "cookie bar with a title": f"""<div id=cookieBar><h2>Cookies</h2><p>This site keeps cookies on your machine to know you again, if you let
        it do so.</p></div><main>{story()}</main>""",
    "header with a text": f"<header class=site-header><p>The site that tells stories, since a long time ago.</p></header><article>{story()}</article>{END}",
    "body named after its side bar": f"<body class=with-sidebar>{NAV}<div class=page><div class=content>{story()}</div><div class=side-bar><p>Some words about us and our site.</p></div></div>",
    "one form around the page": f"<form action=/><div class=menu><a href=/a>A</a></div><div class=content>{story()}</div><div class=footer><p>The end of the page.</p></div></form>",
    "related stories": f"""{NAV}<article>{story()}</article><section class=related-stories><article><h2><a href=/o>Another story</a></h2><p>What
        the other story is about, in a few words.</p></article></section>{END}""",
    "sponsored part": f"<main><article>{story('<aside class=sponsored><p>Paid for by someone who wants you to buy things.</p></aside>')}</article></main>{END}",
    "roles": f"<div role=banner><p>Name of the site</p></div><div role=main>{story()}</div><div role=complementary><p>Words in a column beside the story.</p></div><div role=contentinfo><p>Who made it</p></div>",
    "table of columns": f"<table><tr><td class=navcol><a href=/a>A</a> <a href=/b>B</a><td class=text>{story()}<td class=rightPanel><p>What else is new, in a column.</p></table>",
    "commentary is an article": f"{NAV}<article class=commentary>{story()}</article>{END}",
    "header inside the article": f"{NAV}<article><header>{story().split('</h1>')[0]}</h1></header>{story().split('</h1>')[1]}</article><div class=replies><p>Well said, and I agree with it.</p></div>",
}


@pytest.mark.parametrize("name", UNSEEN)
def test_unseen_layouts_give_the_whole_story(seen, fitted, name):
    for counts in (seen, fitted):
        assert text(counts, UNSEEN[name]).split("\n") == LINES


@pytest.fixture(scope="module")
def fitted(spark):
    return ex.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_the_tag_that_marks_is_hidden():
    counts = ex.count("<body><article><h1>a b</h1><section id=comments><article><p>c</p></article></section></article>")
    assert not any("tag:article" in k for k in counts) and counts["e|under:comments|0"] == 2


def test_rows_of_all_kinds(spark, seen):
    deep = "<article>" + "<div>" * 5000 + "<p>deep text in many words</p>" + "</div>" * 5000 + "</article>"
    long = "<article><h1>x</h1>" + "".join(f"<p>paragraph {i} of a long page with words</p>" for i in range(5000)) + "</article>"
    pages = [(1, "u", None, "c"), (2, None, "", "c"), (3, "u", "<article><p>cut off &am", "c"), (4, "u", long, "c"), (4, "u", long, "c"), (5, "u", deep, "c")]
    pages += [(None, "u", "<article><p>a<p>b</b></i></article><footer>f</footer>", "c"), (6, "u", "no markup at all", "c")]
    out = ex.extract(spark.createDataFrame(pages, SCHEMA), dict(seen)).collect()
    by_key = {r.page_id: r for r in out}
    assert len(out) == len(pages) and all(r.n_chars == len(r.text) for r in out)
    assert by_key[1].text == by_key[2].text == "" and by_key[None].text == "a\nb"
    assert by_key[3].text == "cut off " + html_module.unescape("&am")
    assert by_key[4].text.count("\n") == 5000 and "deep text" in by_key[5].text


def test_fitted_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = ex.extract(pages, ex.fit(pages))
    for page, got in zip(pages.orderBy("page_id").collect(), out.orderBy("page_id").collect(), strict=True):
        inside = page.html.split("<article>")[1].split("</article>")[0]
        assert " ".join(html_module.unescape(inside.replace("<", "\n<").split(">")[1].split("<")[0]).split()) == got.text.split("\n")[0]
        assert "footer" not in got.text and html_module.unescape(page.html.split("<footer>")[1].split("</footer>")[0]).split("·")[0] not in got.text
    assert ex.extract(pages.limit(0), ex.fit(pages.limit(0))).count() == 0
