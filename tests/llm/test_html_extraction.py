import html
import re
import time

from strata.llm import html_extraction as he

SF = "/root/testdata/sf0.01"


def test_test_pages_give_their_article(spark):
    out = {r["page_id"]: r for r in he.op4_block_tree_html_extraction(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(out) == len(pages)
    for p in pages:
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", p["html"], re.S)[1])
        want = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", inner))).strip()
        assert out[p["page_id"]]["text"] == want and out[p["page_id"]]["n_chars"] == len(want)


PARAGRAPH = "This paragraph belongs to the story and has quite a few words in it, so that it reads as text."
PAGE = f"""<html><head><title>T</title><style>p {{}}</style></head><body class="post">
<header><p>The Daily Paper of the town and all its streets and houses and people</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for you and all your friends</div>
<div id="content"><h1>A Title &amp; more</h1><p>{PARAGRAPH}</p><script>var x = "<p>no</p>";</script>
<p>Short.</p><div class="advert">Buy this thing now, it is the best of all the things that there are</div>
<p>{PARAGRAPH} <a href="#">One link</a>.</p></div>
<aside>Other stories that you may like to read when you are done with this one</aside>
<form><label>Your mail</label><input name="a"><button>Send</button></form>
<section id="comments"><p>I liked this story very much, it was a good read for a long evening</p></section>
<footer>&copy; The Daily Paper</footer></body></html>"""


def test_boilerplate_goes_and_the_article_stays():
    got = he.main_text(PAGE, he.trained())
    assert got == f"A Title & more {PARAGRAPH} Short. {PARAGRAPH} One link."


def test_plain_pages_by_length_and_links():
    page = f"<body><div><a href=a>Home</a> <a href=b>About</a></div><div>{PARAGRAPH * 2}</div><div>{PARAGRAPH}</div>" \
           "<div><a href=c>Next</a></div></body>"
    assert he.main_text(page, he.trained()) == f"{PARAGRAPH * 2} {PARAGRAPH}"


def test_broken_markup_and_time():
    tree = he.trained()
    for page in (None, "", "<", "<!-- x", "<p", '<a href="x>y', "</p></p>", "<p>a < b", "&amp;&#x41;&bogus;"):
        assert isinstance(he.main_text(page, tree), str)
    assert he.main_text(f"<article><p>{PARAGRAPH}<p>x &lt;b&gt; y < z", tree) == f"{PARAGRAPH} x <b> y < z"
    for piece in ("<", '<a "', "<div>", "<!--", "<p", "</", "<p '>", "<script>"):
        begin = time.time()
        he.main_text(piece * 50000, tree)
        assert time.time() - begin < 5


def test_query_edges(spark, write_table):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (None, "v", "", "t"),
                                   (3, "w", f"<article>{PARAGRAPH * 3000}</article>", "t")],
                                  "page_id long, url string, html string, text string")
    out = he.op4_block_tree_html_extraction(spark, write_table(pages=pages)).collect()
    size = len(he.main_text(PAGE, he.trained()))
    assert sorted(r["n_chars"] for r in out) == [0, 0, size, size, len(PARAGRAPH) * 3000]
    assert he.op4_block_tree_html_extraction(spark, write_table(pages=pages.limit(0))).count() == 0


P, Q = PARAGRAPH, "Another paragraph follows here, it is part of the same story and has many words as well."
MENU = '<nav><a href="/a">Home</a> <a href="/b">World</a> <a href="/c">Sport</a></nav>'
# page shapes and the main text a reader would copy out of them
SHAPES = [
    (f"<body>{MENU}<div class='content with-sidebar'><h1>Big title</h1><p>{P}</p><p>{Q}</p></div></body>", f"Big title {P} {Q}"),
    (f"<body><main class='has-menu social'><p>{P}</p><p>{Q}</p></main><footer>All rights</footer></body>", f"{P} {Q}"),
    (f"<body>{MENU}<article><header><h1>The title</h1><p>By a writer</p></header><p>{P}</p><p>{Q}</p></article></body>",
     f"The title By a writer {P} {Q}"),
    (f"<body><header><a href=/>Site</a></header><article class='post no-comments'><p>{P}</p><footer>Share <a href=x>this</a></footer>"
     f"</article><article class='comment'><p>{Q}</p></article></body>", P),
    (f"<body><form id=aspnet action=/>{MENU}<article><h2>Inside a form</h2><p>{P}</p></article><input name=q></form></body>",
     f"Inside a form {P}"),
    (f"<body><div id=wrapper class='has-banner'><div class='sidebar'><p>{Q}</p></div><div class='entry-content'><p>{P}</p>"
     f"<ul><li>One thing</li><li>And one more</li></ul></div></div></body>", f"{P} One thing And one more"),
    (f"<body><table><tr><td><a href=1>Home</a></td><td><a href=2>Mail</a></td></tr></table><div>{P}</div><div>{Q}</div></body>",
     f"{P} {Q}"),
    (f"<body><section class='story is-open'><h1>Title</h1><p>{P}</p><aside><p>{Q}</p></aside><p>{Q}</p></section></body>",
     f"Title {P} {Q}"),
    (f"<body><div class=related-articles><article><p>{Q}</p></article></div><div role=main><p>{P}</p></div></body>", P),
    (f"<body><div class='cookie-consent'><p>{Q}</p></div><article id='article-with-comments' class='article'><p>{P}</p>"
     f"<section class='comments'><p>{Q}</p></section></article></body>", P),
    (f"<body><div class='page sidebar-content'><p>{Q}</p></div><div class='post-body js-toolbar'><p>{P}</p><p>{Q}</p></div></body>",
     f"{P} {Q}"),
    (f"<body><main><nav><a href=1>On this page</a></nav><h1>A title</h1><p>{P}</p><div class=newsletter><p>{Q}</p></div></main></body>",
     f"A title {P}"),
]


def test_shapes_of_pages():
    tree = he.trained()
    for page, want in SHAPES:
        assert he.main_text(page, tree) == want, page
