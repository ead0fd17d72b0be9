import time

import pytest

from casebook.llm.html_text import Page, attributes, main_text, secondary, tokens

ARTICLE = "<h1>Title of it</h1><p>" + "Some words of the article itself. " * 12 + "</p><p>" + "A second paragraph of it. " * 8 + "</p>"
WANT = "Title of it\n" + ("Some words of the article itself. " * 12).strip() + "\n" + ("A second paragraph of it. " * 8).strip()


def page(attrs, inner=ARTICLE, tail=""):
    return f"<html><body><nav><a href='/'>Home</a> Menu</nav><div {attrs}>{inner}</div>{tail}<footer>All rights reserved</footer></body></html>"


@pytest.mark.parametrize("attrs", ['class="wrap has-sidebar"', 'class="no-sidebar"', 'class="post comment-open"', 'class="story ad-free"',
                                   'class="content social-media-policy"', 'id="skip-target"', 'class="with-comments"', 'class="page sidebar-layout"'])
def test_wrappers_keep_their_article(attrs):
    assert Page(page(attrs)).text(None) == WANT
    assert Page(page(attrs, "<div class='body'>" + ARTICLE + "</div>")).text(None) == WANT


@pytest.mark.parametrize("attrs", ['class="sidebar"', 'class="ad"', 'id="comments"', 'class="related posts"', 'class="cookie-banner"', 'class="share-buttons"', 'class="site-header"'])
def test_secondary_parts_still_go(attrs):
    part = f"<div {attrs}><p>" + "Not the article at all, " * 5 + "</p></div>"
    for source in (page('class="post"', ARTICLE + part), page('class="post"', ARTICLE, part), page('class="wrap has-sidebar"', ARTICLE + part)):
        assert Page(source).text(None) == WANT


def test_long_comments_do_not_win():
    comments = '<div id="comments">' + "".join(f'<article class="comment"><p>Reader {k} says a good deal about it here.</p></article>' for k in range(200)) + "</div>"
    for source in (page('class="post"', ARTICLE, comments), page('class="post"', ARTICLE + comments), page('class="has-sidebar"', ARTICLE + comments)):
        assert Page(source).text(None) == WANT


def test_vote_overrules_the_list(spark):
    """Pages of one template: on a short page the wrapper does not stand out, its host's other pages vote for it."""
    short = "<p>Only a few words.</p>"
    extra = "<div class='note'><p>Besides, a remark here.</p></div>"
    rows = [(k, "http://a.example/x", page('class="sidebar-page"', ARTICLE, extra)) for k in range(3)] + [(9, "http://a.example/y", page('class="sidebar-page"', short, extra))]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == WANT and got[9] == "Only a few words."


def test_names():
    assert secondary("div", {"class": "main sidebar"}) and secondary("div", {"id": "comment-list"}) and secondary("div", {"class": "post-comments"})
    assert not secondary("div", {"class": "no-ads"}) and not secondary("body", {"class": "sidebar"}) and not secondary("article", {"class": "share"})
    assert secondary("article", {"class": "comment"}) and not secondary("div", {"class": "entry-header"})


@pytest.mark.parametrize("unit", ["<svg>", "<div>a</p>", '<a title="', "<a title='x>\" ", '<a x=">', "<b><i></u>", "<!--", "<x", "<a ", "<div>", "</div>", "<b>x<hr>", "&amp", "<i><div></i>", "<p><li>", "<script>"])
def test_hostile_pages_take_linear_time(unit):
    """1 MB of one unit, with and without a last >."""
    for tail in ("", ">"):
        start = time.process_time()
        p = Page(unit * (1_000_000 // len(unit)) + tail)
        p.text(None), p.own(">html")
        assert time.process_time() - start < 12


def test_time_doubles_with_length():
    for unit in ("<svg>", "<div>a</p>", '<a title="', '<a x=">'):
        took = []
        for n in (200_000, 800_000):
            start = time.process_time()
            Page(unit * (n // len(unit)))
            took.append(time.process_time() - start)
        assert took[1] < 8 * took[0] + 0.3


def test_tags():
    got = [(tag, closes, inner) for _, _, closes, tag, inner in tokens('<P class="a>b">x</p ><svg><g></svg><br/><a b="<i>">')]
    assert got == [("p", False, ' class="a>b"'), ("p", True, " "), (None, False, ""), ("br", False, "/"), ("a", False, ' b="<i>"')]
    assert attributes(' class="a>b"') == {"class": "a>b"}
