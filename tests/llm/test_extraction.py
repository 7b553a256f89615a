import time

from pyspark.sql import functions as F

from telemetry_spark.llm import extraction

PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class=home>
<header class="site"><h1>The Site</h1></header><nav><ul><li><a href="/">Home</a><li>About</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="page7"><div class="post post-12">
<h1>Title &amp; more</h1><p><b>First   line<br>goes&nbsp;on<p title="a > b">Second &lt;p&gt; <span class="ad">Buy!</span>text
<!-- hidden --><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>
<form><input value=x>Sign up <button>Go</button></form><pre>x
 y</pre></div><aside>Side text</aside><section class="comments"><p>Nice post!</p></section></div>
<footer>&copy; 2020</footer></body></html>"""
TEXT = "Title & more\nFirst line goes on\nSecond <p> text\none\ntwo\na\nb\nx y"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_one_page():
    assert extraction.extract(PAGE, None) == TEXT
    paths = extraction.path_scores(extraction.read(PAGE))
    assert max(paths, key=paths.get) == "html>body.home>div>div.post.post-"


def test_header_inside_an_article_is_kept():
    page = "<body><header>Site</header><article><header><h1>T</h1></header><p>text here</p><footer>by me</footer></article>"
    assert extraction.extract(page, None) == "T\ntext here"


def test_a_hosts_pages_agree(spark):
    """On one page a list of links is longer than the article; the host's other pages say where the article is."""
    body = "<div class=main><p>{}</p></div><div class=more><p>{}</p></div>"
    rows = [(i, f"http://h.org/{i}", body.format(f"article {i} " * 50, "see also")) for i in range(8)]
    rows.append((8, "http://H.org/8", body.format("a fairly long article " * 9, "see also this " * 17)))
    found = {r.page_id: r for r in extraction.extract_pages(pages(spark, rows)).collect()}
    assert found[8].path == "html>div.main" and found[8].text == ("a fairly long article " * 9).strip()


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no host", "plain text"), (4, "http://a.b/", "<p>un<closed <b>x"), (4, "http://a.b/", "<p>un<closed <b>x"),
            (None, "http://a.b/c", "<html><body>&#x41;&eacute;&nosuch; &amp</body>"), (5, "http://a.b/d", "<div>" * 3000 + "deep" + "</div>" * 3000),
            (6, "http://a.b/e", "<script>never closed <p>text"), (7, "http://a.b/f", "<a title='" * 2000 + "x"), (8, "http://a.b/g", "word " * 200000)]
    table = pages(spark, rows).withColumns({"host": F.lit("h"), "path": F.lit("p"), "text": F.lit("t")})
    found = {(r.page_id, r.text[:40], r.n_chars) for r in extraction.extract_pages(table).collect()}
    assert {(1, "", 0), (2, "", 0), (3, "plain text", 10), (None, "Aé&nosuch; &", 12), (5, "deep", 4), (6, "", 0)} <= found
    assert any(i == 8 and n == 999999 for i, _, n in found)
    assert extraction.extract_pages(table).count() == len(rows) and extraction.extract_pages(table.limit(0)).count() == 0


def test_given_pages_yield_their_articles(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    for r in extraction.extract_pages(table).join(table.select("page_id", "html"), "page_id").collect():
        inner = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert r.n_chars == len(r.text) and r.text
        assert r.text.replace("\n", " ").split() == __import__("html").unescape(__import__("re").sub(r"<[^>]*>", " ", inner)).split()


def test_a_long_article_keeps_title_and_lead():
    """Title and lead are under 2 % of the text and stand outside of the container with the rest."""
    body = "<div class=body><table><tbody><tr><td><p>{}</p></td></tr></tbody></table></div>".format("word " * 2000)
    for page in (f"<body><article><h1>Title</h1><p>lead</p>{body}</article>", f"<body><div><h1>Title</h1><p>lead</p>{body}</div>",
                 f"<body><main><div><h1>Title</h1></div><blockquote>lead</blockquote>{body}</main>"):
        path = extraction.best_of(extraction.path_scores(extraction.read(page)))
        for wanted in (None, path):
            assert extraction.extract(page, wanted).split("\n") == ["Title", "lead", ("word " * 2000).strip()]


def test_names_hide_only_as_a_whole():
    body = "<h1>Title</h1><p>{}</p>".format("word " * 300)
    parts = ("<section id='related-work'><h2 id='widgets'>Widgets</h2><p>prior art</p></section><h2 id='navigation'>Navigation</h2>"
             "<div class='related'>more</div><div class='sidebar-left'>side</div><div class='ad-300x250'>buy</div><ul id=comments><li>nice</ul>")
    text = ["Title", ("word " * 300).strip()]
    for opened in ("<div id=content class='has-sidebar'>", "<div class='article-with-comments'>", "<div class='no-comments'>", "<article>"):
        assert extraction.extract(f"<body>{opened}{body}{parts}</body>", None).split("\n") == [*text, "Widgets", "prior art", "Navigation"]


def test_names_do_not_hide_most_of_a_page():
    body = "<h1>Title</h1><p>{}</p><div class=share><p>Share</p></div><span class=ad>buy</span>".format("word " * 300)
    for opened in ("<div class=widget>", "<div id=notice><section class=overlay>", "<my-page class=modal>"):
        page = f"<body><div class=related>other pages</div>{opened}{body}</body>"
        assert extraction.extract(page, None).split("\n") == ["Title", ("word " * 300).strip()]
    assert extraction.extract("<body><p>short article text</p><div class=comments>no</div></body>", None) == "short article text"
    assert extraction.extract("<div class=menu>" * 3000 + "deep", None) == "deep"


def test_a_hosts_path_drops_no_article_text(spark):
    """Hosts with two layouts, pages without a host that share a path, and leads in a container of their own."""
    text = "article {} " * 100
    rows = [(i, f"http://two.org/{i}", f"<body><div class=box><p>{text.format(*[i] * 100)}</p></div></body>") for i in range(6)]
    rows.append((10, "http://two.org/x", f"<body><div class=box><p>{'lead ' * 80}</p></div><div class=col><p>{'rest ' * 200}</p></div></body>"))
    rows += [(20 + i, None, f"<body><div><p>{text.format(*[i] * 100)}</p></div></body>") for i in range(6)]
    rows.append((30, "no host", f"<body><div><p>{'lead ' * 80}</p></div><section><p>{'rest ' * 200}</p></section></body>"))
    beside = "<body><div class=lead>lead {}</div><div class=main><p>{}</p></div><div class=more>see also</div></body>"
    rows += [(40 + i, f"http://leads.org/{i}", beside.format(i, text.format(*[i] * 100))) for i in range(4)]
    found = {r.page_id: r.text.split("\n") for r in extraction.extract_pages(pages(spark, rows)).collect()}
    assert found[10] == found[30] == [("lead " * 80).strip(), ("rest " * 200).strip()]
    for i in range(4):
        assert found[40 + i] == [f"lead {i}", text.format(*[i] * 100).strip()]


def test_copies_of_a_page_do_not_make_its_lead_a_side(spark):
    page = "<body><div class=lead>lead</div><div class=main><p>{}</p></div></body>".format("word " * 400)
    for r in extraction.extract_pages(pages(spark, [(i, f"http://h.org/{i}", page) for i in range(5)])).collect():
        assert r.text.startswith("lead\n")


def test_letters_that_lower_case_lengthens_move_nothing():
    for n in (1, 20):
        page = f"<body><p>{'\u0130' * n}<script>var a = '<p>';</SCRIPT><p>one</p><svg><text>x</text></svg><p>two</p><style>p{{}}</style><p>three</p>"
        assert extraction.extract(page, None).split("\n") == ["\u0130" * n, "one", "two", "three"]


def test_long_attributes_end_at_their_quote():
    for quote, other in ("\"'", "'\""):
        value = f"<div class={other}x{other}><script>a > b</div> " * 4000
        page = f"<body><div data-props = {quote}{value}{quote} class=post><p>one</p></div><p title={quote}x > y{quote}>two</p><p title={quote}{value}>three"
        assert extraction.extract(page, None).startswith("one\ntwo")
        assert extraction.extract(page[: page.index("<p title=" + quote + value[:9])], None) == "one\ntwo"
    assert extraction.extract("<p title=it's>one</p><p>two's</p>", None) == "one\ntwo's"


def test_a_missing_end_is_searched_once():
    started = time.process_time()
    assert extraction.extract("<p>one</p>" + "<svg><p>" * 50_000 + "two", None) == "one\ntwo"
    assert time.process_time() - started < 4
