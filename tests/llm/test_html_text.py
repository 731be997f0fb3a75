import re

from pyspark.sql import functions as F

from sessionweave.llm.html_text import blocks, decide, extracted, labelled_rows, main_text, train

PAGE = """<html><head><title>x</title><script>var a="</p>";</script></head><body class="home page">
<div id="cookie-banner"><p>We use cookies to make this site work well for you and our partners in every way possible and more</p><button>OK</button></div>
<header><h1>Site name</h1><p>Tagline of the site that is rather long and wordy too</p></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<main><article class="post"><header><h1>Title here</h1></header><p>First para &amp; more&nbsp;text<br>second <b>li</b>ne.<p>Short.</p><ul><li>item one</li><li>item two with <a href=x>link</a></li></ul>
<aside><p>Related stories that you may want to read next in this series</p></aside><p><a href=y>All a link</a></p>
<div class="ad">Buy now this thing that is long enough to look like text of a paragraph</div><form><label>Mail</label><input></form><p>Last para.</p>
<section class="comments"><article class="comment"><p>This is a reader comment with many words in it, it is very long indeed and says nothing.</p></article></section></article></main>
<footer>&copy; 2020 site</footer></body></html>"""


def test_tree_and_pages(spark, sf):
    tree = train(spark)
    assert sum(decide(tree, x) != y for y, x in labelled_rows()) <= 3
    assert main_text(PAGE, tree).split("\n") == ["Title here", "First para & more text second line.", "Short.", "item one", "item two with link", "All a link", "Last para."]
    assert main_text("just text &lt; <b>bold</b> words", tree) == "just text < bold words"
    assert main_text("", tree) == "" and main_text("<p", tree) == "" and main_text("<script>var x = 1", tree) == ""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in extracted(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        import html

        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


ARTICLE = "<h1>Title of it</h1><p>" + "long text of the article with many words in it " * 6 + "</p><p>Short one.</p><p>" + "more words of the same article follow in this paragraph " * 4 + "</p>"
MENU = "<ul><li><a>Home</a></li><li><a>News</a></li><li><a>All topics</a></li></ul>"


def test_misleading_and_missing_marks(spark):
    tree = train(spark)
    used = []

    def walk(node):
        if isinstance(node, list):
            used.append(node[0])
            walk(node[2])
            walk(node[3])

    walk(tree)
    assert set(used) & {2, 3, 4, 5}
    want = [" ".join(x.split()) for x in re.split("<[^>]*>", ARTICLE) if x.strip()]
    comments = "<article class='comment'><p>A reader says that all of this is wrong and should be read again.</p></article>"
    legal = "<p>All rights reserved by the makers of this site.</p>"
    for page in (
        f"<body class='single post comments-closed'><article>{ARTICLE}</article></body>",
        f"<body><main class='content has-comments'>{ARTICLE}</main></body>",
        f"<body><div class='content with-sidebar'>{ARTICLE}</div></body>",
        f"<body><div id='page' class='header-fixed'><article>{ARTICLE}</article></div></body>",
        f"<body class='hasSidebar'>{MENU}<div id='content'>{ARTICLE}</div>{MENU}{legal}</body>",
        f"<body><div class='no-sidebar'>{MENU}{ARTICLE}{MENU}{legal}</div></body>",
        f"<body><main class='sidebar'>{ARTICLE}</main><div class='sidebar-right'><p>Read this too, it is quite long and has no link at all.</p></div></body>",
        f"<body><article class='post comment-enabled widget'>{ARTICLE}</article>{comments}</body>",
        f"<body>{MENU}{ARTICLE}{MENU}</body>",
        f"<body class='nav-open'><nav>{MENU}</nav><section><article>{ARTICLE}</article></section><div class='comments'>{comments}</div></body>",
    ):
        assert main_text(page, tree).split("\n") == want, page


def test_blocks_have_link_density():
    found = blocks("<div>one two <a>three four</a></div><p>five")
    assert [(b.text, b.words, b.link_density) for b in found] == [("one two three four", 4, 0.5), ("five", 1, 0.0)]


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>" + "word " * 200_000), (2, "v", "<div " * 2000), (3, "w", "<a href='" * 500 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r.page_id or 0, r.n_chars) for r in extracted(pages).collect()))
    assert got[:1] == [(0, 999_999)] and got[1:3] == [(1, 0), (1, 0)] and len(got) == 5
    assert extracted(pages.limit(0)).count() == 0


def test_skipped_elements_end_where_they_close():
    texts = lambda page: " ".join(b.text for b in blocks(page)).split()
    for tag in ("svg", "math"):
        assert texts(f"<p>a<{tag} class='x'/>b</p><p>c<{tag}/>d") == ["ab", "cd"]
    for tag in ("svg-icon", "video-player", "button-group", "select-menu", "object-view", "title-bar", "script-note"):
        assert texts(f"<p>a <{tag} x=1>b</{tag}> c</p><p>d</p>") == ["a", "b", "c", "d"]
    for tag in ("button", "select", "object", "video", "canvas", "audio", "template", "svg"):
        assert texts(f"<p>a<{tag} x=1>b<p>c<p>d") == ["ab", "c", "d"]
        assert texts(f"<p>a<{tag}>b<p>c</p><{tag}>no</{tag} ><p>d") == ["ab", "c", "d"]
        assert texts(f"<p>a <{tag}>no<{tag}>no</{tag}>no</{tag}> b</{tag}> c") == ["a", "b", "c"]
    for tag in ("script", "style", "textarea", "title", "iframe", "noscript"):
        assert texts(f"<p>a<{tag} x=1>no<p>no</p>") == ["a"] and texts(f"<p>a <{tag}/>no</{tag}\n> b") == ["a", "b"]
    assert texts("<p>a <svg><title/><path d='M0'/><text>no</text></svg> b") == ["a", "b"]
    assert texts("<p>a <svg><button></svg> b") == ["a", "b"]
    assert texts("<button>" * 20_000 + "a" + "</svg>" * 20_000 + "b") == ["ab"]
