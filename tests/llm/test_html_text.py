"""Main text of pages: hand-written pages, the given pages against plain patterns, edge cases."""

import html as entities
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.html_text import extract_text, main_text

SF = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t="</p><article>";</script></head>
<body class="has-sidebar menu"><header id=top><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><!-- note -->
<main><article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>
  three&nbsp;four<br>five.<p>Short<form><label>mail</label><input></form>
<aside>Side</aside><div class="share">Tweet</div><p>Last &lt;p&gt; &#233;.</p><footer>by me</footer></article>
<section id="comments"><h2>Comments</h2><p>First!</p></section></main>
<aside>Related</aside><footer>&copy; 2020</footer></body></html>"""


def test_furniture_goes_and_content_stays():
    assert main_text(PAGE) == "Title & more\nOne two three four five.\nShort\nLast <p> é."


def test_names_that_are_not_what_an_element_is_for():
    page = '<div class="page has-sidebar no-ads"><article class="post comments-open"><p>Stays</p></article>{}</div>'
    assert main_text(page.format('<article class="comment odd"><p>Nice!</p></article>')) == "Stays"
    assert main_text(page.format('<div id="ad-top" class="box">Buy</div><p role="alert">Look</p>')) == "Stays"


def test_wrappers_that_hold_content_are_no_furniture():
    for wrapper in ('<div class="content-sidebar-wrap">{}</div>', '<div class="layout-sidebar-right"><div id="nav-ok">{}</div></div>'):
        for tag in ("main", "article"):
            page = wrapper.format(f'<div class="sidebar">Links</div><{tag}><h1>Title</h1><p>Text</p></{tag}>')
            assert main_text(f"<body>{page}<div id=footer>by me</div></body>") == "Title\nText"
            assert main_text(f"<main>{page}</main>") == "Title\nText"
    both = '<div class="page-menu-left"><article>One</article></div><article>Two</article>'
    assert main_text(both) == "One\nTwo"


def test_comments_go_with_their_articles_if_there_are_others():
    comments = '<div id="comments" class="comments-area"><article class="comment-body">Nice</article></div>'
    assert main_text(f"<article>Text</article>{comments}") == "Text"
    assert main_text(comments) == "Nice"


def test_headings_within_content_stay():
    page = """<article><div class="post-header"><h1>Title</h1><div class="share">Tweet</div></div><h2 id="related-work">Related</h2>
    <p id="search-1">One</p><h2 id="search-algorithms">Search</h2><p>Two</p><p class="ad">Buy</p></article>"""
    assert main_text(page) == "Title\nRelated\nOne\nSearch\nTwo"


def test_text_to_tag_ratio_finds_the_region():
    links = "".join(f"<div><a href=x>link {i}</a> | <a href=y>b</a></div>" for i in range(12))
    body = "".join(f"<p>{'long words of a paragraph ' * 12}{i}</p>" for i in range(6)) + "<p>short</p>"
    body += f"<p>{'long words of a paragraph ' * 12}end</p>"
    got = main_text(f"<html><body><div>{links}</div><div>{body}</div><div>{links}</div></body></html>").split("\n")
    assert "short" in got and got[0].startswith("long words") and got[-1].endswith("end")
    assert len(got) == 8


def test_region_keeps_short_blocks_at_its_edges():
    long = "".join(f"<p>{'long words of a paragraph ' * 12}{i}</p>" for i in range(8))
    links = "<div>" + "".join(f"<div><a href=x>link {i}</a> | <a href=y>b</a></div>" for i in range(12)) + "</div>"
    for before, after in (("", ""), (links, links)):
        for body in ("<div><h1>Title</h1><p>A lead.</p>{}<p>Short end.</p></div>", "<section><h2>Title</h2><ul><li>A lead.</ul>{}<p>Short <i>end</i>.</section>"):
            got = main_text(f"<body>{before}{body.format(long)}{after}</body>").split("\n")
            assert got[:2] == ["Title", "A lead."] and got[-1] == "Short end." and len(got) == 11
    parts = f"<div><div><h2>One</h2>{long}</div><div><h2>Two</h2>{long}<p>End.</p></div><div><p>By me</p></div></div>"
    got = main_text(f"<body>{links}<h1>Title</h1>{parts}{links}</body>").split("\n")
    assert got[:2] == ["Title", "One"] and got[-2:] == ["End.", "By me"] and len(got) == 21
    assert main_text("<h1>Title</h1><p>Short end.</p>") == "Title\nShort end."


def test_region_in_the_body_itself():
    long = "".join(f"<p>{'long words of a paragraph ' * 12}{i}</p>" for i in range(8))
    links = "<ul>" + "".join(f"<li><a href=x>link {i}</a>" for i in range(12)) + "</ul>"
    got = main_text(f"<html><body>{links}<h1>Title</h1>{long}<p><a href=z>Source</a></p>{links}</body></html>").split("\n")
    assert got[0] == "Title" and got[-1] == "Source" and len(got) == 10


MARKUP = ["<![", "<![foo[ x ]]>", "<![CDATA[x]]>", "<!", "<!--", "-->", "<!doctype", "<?", "</", "<p", "<a href='", "&#", "&#x", "&", "<", ">", "]]>", "]", "--", "x", " ", "=", "'", '"', "/", "<script>", "</script>", "<form>", "</form>", "<article>", "</article>", "<template>", "\x00"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(MARKUP) | st.text(max_size=3), max_size=25).map("".join))
def test_no_markup_breaks_the_parser(html):
    main_text(html)
    assert main_text(f"<article><p>{'Stays. ' * 40}</p></article>{html}").startswith("Stays")


@pytest.mark.parametrize("odd", ["<![foo[ x ]]>", "<![[", "<![a]", "<![endif]-->", "<!ELEMENT x>", "<![CDATA[y]]>"])
def test_marked_sections_are_comments(odd):
    assert main_text(f"<article><p>One</p>{odd}<p>Two</p></article>").split("\n")[0] == "One"


def test_wrappers_by_tag():
    long = "".join(f"<p>{'long words of a paragraph ' * 12}{i}</p>" for i in range(4))
    for tag in ("form", "noscript", "template"):
        page = f"<body><{tag} id=aspnet><div>Menu</div><article><h1>Title</h1><p>Text</p><form><p>Mail</p></form></article></{tag}></body>"
        assert main_text(page) == "Title\nText"
        assert main_text(f"<article><p>Text</p><{tag}><p>Not this</p></{tag}></article>") == "Text"
    got = main_text(f"<body><form action=x><div><h1>Title</h1>{long}<label>Mail</label></div></form></body>").split("\n")
    assert got[0] == "Title" and len(got) == 5
    assert main_text(f"<div>{long}</div><form><p>Write</p><p>to</p><p>us</p></form>").count("\n") == 3


def test_ratio_chooses_between_content_elements_and_the_rest():
    long = "".join(f"<p>{'long words of a paragraph ' * 12}{i}</p>" for i in range(6))
    card = "<article><h3><a href=x>Another story</a></h3><p>Teaser <a href=y>more</a></p></article>"
    got = main_text(f"<body><div><h1>Title</h1>{long}<p>End.</p></div><div>{card}{card}</div></body>").split("\n")
    assert got[0] == "Title" and got[-1] == "End." and len(got) == 8
    links = "<article><a href=x>Another story</a></article>"
    got = main_text(f"<article><h1>Title</h1>{long}</article><div>{links}{links}</div><p>Imprint of the page</p>").split("\n")
    assert got[0] == "Title" and len(got) == 7
    short = f"<div>{'A notice that nobody named as one. ' * 3}</div><article><p>A short piece of forty letters or so.</p></article>"
    assert main_text(short) == "A short piece of forty letters or so."


def test_comments_without_a_telling_name():
    items = "<ol><li>Nice.<ul><li>Indeed</ul><li><p>First!</p></ol>"
    for heading in ("3 Responses", "12 comments", "Comments (2)", "3 Responses to “Title”", "Comments"):
        assert main_text(f"<article><p>Text</p><div><h3>{heading}</h3>{items}</div><p>Note</p></article>") == "Text\nNote"
        assert main_text(f"<article><p>Text</p><h3>{heading}</h3>{items}</article>") == "Text"
    for heading in ("Three responses to heat", "Comments on the method", "10 reactions in acids"):
        assert main_text(f"<article><h3>{heading}</h3><ul><li>One</ul></article>") == f"{heading}\nOne"
    assert main_text("<article><h3>Comments</h3><p>As follows.</p></article>") == "Comments\nAs follows."


def test_stray_end_tags_take_linear_time():
    page = "<article><p>x</p>" + "<b>" * 50_000 + "</i>" * 50_000 + "</article>"
    begin = time.perf_counter()
    assert main_text(page) == "x" and time.perf_counter() - begin < 5


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    for row in pages.collect():
        article = re.search("(?s)<article>(.*)</article>", row.html)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", article))
        blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert got[row.page_id].text == "\n".join(b for b in blocks if b)
        assert got[row.page_id].n_chars == len(got[row.page_id].text) and got[row.page_id].url == row.url


def test_edge_cases(spark):
    rows = [
        (1, None, None), (2, "u", ""), (3, "u", "plain text"), (4, "u", "<p>a</p>"), (4, "u", "<p>a</p>"), (None, "u", "<nav>x</nav>"),
        (5, "u", "<article>" + "<p>word</p>" * 50_000), (6, "u", "</b></p><![CDATA[x]]><p <a>b"), (7, "u", "<div hidden>x</div>y &bogus; &#x41;"),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = extract_text(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == texts[None] == "" and texts[3] == "plain text" and texts[4] == "a"
    assert texts[5] == "\n".join(["word"] * 50_000) and texts[7] == "y &bogus; A"
    assert extract_text(df.limit(0)).collect() == []
