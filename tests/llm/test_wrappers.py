import html
import re

from seismiq.llm import wrappers as w
from seismiq.llm.queries import op6_wrappers


def plain(page):
    """The article of a page of the test tables."""
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_pages_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op6_wrappers(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plain(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def nodes(page):
    return w.Wrapper.of(page).nodes


def test_alignment_makes_repeats_and_options():
    a, b = nodes("<ul><li>x</li><li>y</li></ul><p>z</p>"), nodes("<ul><li>x</li></ul><b>q</b><p>z</p>")
    assert "".join(map(w.key, a)) == "<ul>(<li>#</li>)+</ul><p>#</p>"
    both = w.align(a, b)
    text = "".join(map(w.key, both))
    assert "(<b>)?(#)?(</b>)?" in text and "<p>#</p>" in text
    assert w.align(a, a) == a and "".join(map(w.key, w.align(both, a))) == text


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T &amp; U</title><script>var x = "<p>no</p>";</script><style>p{}</style></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
      <main><article><h1>Head &lt;ing</h1><!-- no --><p>One <b>bold</b>
      text<br>two &eacute; &#233; <a href='x>y'>link</a><p>Next &nbsp; para</p><div class="ad banner">Buy</div><aside>side</aside>
      <form><input value="a"><label>Name</label></form><ul><li>first<li>second</ul><section id="comments"><p>me too</p></section></article></main>
      <footer>&copy;</footer></body></html>"""
    paths = w.Wrapper.of(page).main_paths()
    assert w.extract(page, paths) == "Head <ing\n\nOne bold text two é é link\n\nNext para\n\nfirst\n\nsecond"


def test_shared_text_of_pages_without_article_is_template():
    pages = [f"<body><div><p>Same on all</p></div><table><tr><td>Body {i} text</td></tr></table></body>" for i in range(4)]
    held = w.Wrapper()
    for p in pages:
        held.add(w.Wrapper.load(w.Wrapper.of(p).dump()))
    assert [w.extract(p, held.main_paths()) for p in pages] == [f"Body {i} text" for i in range(4)]
    assert held.pages == 4


def held_of(pages):
    held = w.Wrapper()
    for p in pages:
        held.add(w.Wrapper.load(w.Wrapper.of(p).dump()))
    return held


def test_pages_without_article_beside_pages_with_one():
    pages = [f"<body><main><p>New {i}</p></main><p>beside</p></body>" for i in range(3)]
    pages += [f"<body><div><p>Old {i}</p></div></body>" for i in range(3)] + ["<body><aside><article>card</article></aside><div><p>Old 3</p></div></body>"]
    held = held_of(pages)
    assert [w.extract(p, held.main_paths()) for p in pages] == [f"New {i}" for i in range(3)] + [f"Old {i}" for i in range(4)]


def test_copies_of_one_page_are_no_template():
    pages = ["<body><div><p>The only text</p></div></body>"] * 5
    held = held_of(pages)
    assert [w.extract(p, held.main_paths()) for p in pages] == ["The only text"] * 5


def test_plain_boilerplate_on_the_path_of_the_text_is_found_by_its_slot():
    def page(i, n):
        body = "".join(f"<div><p>Text {i} part {k} <b>and</b> more {i}</p></div>" for k in range(n))
        return f"<body><div><p>Welcome to the site</p></div>{body}<div><p>All rights <i>reserved</i></p></div></body>"

    sizes = [2, 1, 5, 3, 1, 2, 4, 2, 1, 6, 3, 2]
    pages = [page(i, n) for i, n in enumerate(sizes)]
    held = held_of(pages)
    assert [w.extract(p, held.main_paths()) for p in pages] == \
        ["\n\n".join(f"Text {i} part {k} and more {i}" for k in range(n)) for i, n in enumerate(sizes)]
    # the same words elsewhere are no template: the place in the expression decides
    away = "<body><table><tr><td>Welcome to the site</td></tr></table><div><p>Text</p></div></body>"
    held.add(w.Wrapper.of(away))
    assert w.extract(away, held.main_paths()) == "Welcome to the site\n\nText"


def test_samples_do_not_depend_on_order_or_copies():
    pages = [f"<body><div><p>Same</p></div><table><tr><td>Body {i}</td></tr></table></body>" for i in range(30)]
    one, two = held_of(pages), held_of(pages[::-1] + pages[5:])
    assert one.nodes == two.nodes and all(len(s[1]) == w.SAMPLE_PAGES for s in w.slots(one.nodes))


def test_a_repeat_takes_in_its_single_group():
    a, b = nodes("<ul><li>x</li><li>y</li></ul><i>z</i>"), nodes("<ul><li>x</li></ul><i>z</i>")
    assert "".join(map(w.key, w.align(a, b))) == "".join(map(w.key, w.align(b, a))) == "".join(map(w.key, a))


def test_broken_markup():
    for page in ("", "<", "<p", "<!--", "a < b > c", "</p></div>", "<script>x", "<p class='a", "&#0;&bad;", "<p>" * 2000, "<b>" * 500 + "x"):
        w.extract(page, w.Wrapper.of(page).main_paths())
    assert w.extract("a < b", w.Wrapper.of("a < b").main_paths()) == "a < b"


def test_odd_rows(spark):
    rows = [(1, None, "<article><p>a</p></article>", "h"), (2, "no url", None, None), (3, "http://h.example/x", "", None), (1, None, "<article><p>a</p></article>", "h"),
            (None, "http://h.example/y", "<p>" + "word " * 50_000 + "</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted(map(tuple, w.main_text(pages).collect()), key=str)
    long = ("word " * 50_000).strip()
    assert got == sorted([(1, None, "a", 1), (2, "no url", "", 0), (3, "http://h.example/x", "", 0), (1, None, "a", 1), (None, "http://h.example/y", long, len(long))], key=str)
    assert w.main_text(pages.limit(0)).count() == 0


def text_of(page):
    return w.extract(page, w.Wrapper.of(page))


def test_names_around_the_article_do_not_count():
    for name in ("content with-sidebar", "layout no-sidebar", "page has-menu", "entry-content related-work", "article-header", "main-share", "sidebar"):
        for kind in ("class", "id"):
            page = f'<body><nav>menu</nav><div {kind}="{name}"><article><h1>Head</h1><p>Story of it all</p></article></div><div class="sidebar">side</div></body>'
            assert text_of(page) == "Head\n\nStory of it all", (name, kind)
            page = f'<body><nav>menu</nav><div {kind}="{name}"><h1>Head</h1><p>A story of it all without an article</p></div><div class="site-footer">foot</div></body>'
            assert text_of(page) == "Head\n\nA story of it all without an article", (name, kind)


def test_names_are_read_as_wholes():
    page = """<article><p class="reply-to-critics">One</p><p id="related-work">Two</p><p class="x with-ads">Three</p>
      <div class="cookie-notice">no</div><div class="comment-list"><p>no</p></div><ul class="share-buttons"><li>no</li></ul><div id="site-footer">no</div>
      <section class="comments"><article class="comment"><p>no</p></article></section></article>"""
    assert text_of(page) == "One\n\nTwo\n\nThree"


def test_a_teaser_is_not_the_article():
    page = "<body><article>Teaser</article><div><p>" + "The story itself. " * 20 + "</p></div><footer>foot</footer></body>"
    assert text_of(page) == "Teaser\n\n" + ("The story itself. " * 20).strip()


def test_comments_in_articles_of_their_own_are_not_the_article():
    comments = "".join(f"<article><p>comment {i} says something of some length</p></article>" for i in range(30))
    page = f'<body><article><h1>Head</h1><p>Short story that is all there is to read here, or is it, one may ask again and again.</p></article><section class="comments">{comments}</section></body>'
    assert text_of(page).startswith("Head\n\nShort story") and "comment" not in text_of(page)


def test_tables_without_their_article_element(spark):
    """Of the given pages, with the article element made a plain one, nearly all come out the same."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    changed = [(r.page_id, r.url, r.html.replace("<article>", "<div>").replace("</article>", "</div>")) for r in rows]
    got = {r.page_id: r.text for r in w.main_text(spark.createDataFrame(changed, "page_id long, url string, html string")).collect()}
    assert sum(got[r.page_id] == plain(r.html) for r in rows) >= 0.95 * len(rows)


def test_many_different_pages_of_a_host():
    import random
    import time

    rng = random.Random(1)
    tags = ["p", "div", "section", "ul", "table", "h2", "h3", "blockquote", "pre", "dl", "figure", "h4"]
    pages = ["<body>" + "".join(f"<{t}><{u}>text {rng.random()}</{u}></{t}>" for t, u in ((rng.choice(tags), rng.choice(tags[3:])) for _ in range(40))) + "</body>" for _ in range(500)]
    began, held = time.process_time(), w.Wrapper()
    for p in pages:
        held.add(w.Wrapper.of(p))
    assert time.process_time() - began < 60 and len(held.nodes) <= w.MOST_NODES and len(held.dump()) < 400_000
    assert w.extract(pages[0], held).count("text") == 40


def test_template_is_counted_on_all_pages(spark):
    """The pages of the smallest content hashes share a text that few of all have, and lack one that most have."""
    def page(i, first, note=""):
        return f"<body><div><p>{first}</p></div><table><tr><td>Body {i}{note}</td></tr></table></body>"

    def content(p):
        return w.hash_of(repr([w.hash_of(t[3]) for t in w.stream(p) if t[0] == "#" and t[1] is not None]))

    odd = sorted((page(i, "Rare words") for i in range(4_000)), key=content)[:w.SAMPLE_PAGES]
    rest = [p for p in (page(i, "Welcome to the site") for i in range(4_000, 4_400)) if content(p) > max(map(content, odd))]
    assert len(rest) > 300
    rows = [(k, "http://h.example/x", p) for k, p in enumerate(odd + rest)]
    got = {r.page_id: r.text for r in w.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[k].startswith("Rare words\n\nBody ") for k in range(len(odd)))
    assert all(re.fullmatch(r"Body \d+", got[k]) for k in range(len(odd), len(rows)))


def test_texts_that_the_bounded_expression_lacks_are_counted_by_path(spark, monkeypatch):
    monkeypatch.setattr(w, "MOST_NODES", 6)
    pages = [f"<body><div><h2>Text {i}</h2></div><ul><li>Same on all</li></ul><blockquote>More {i}</blockquote></body>" for i in range(6)]
    held = held_of(pages)
    held.nodes = held.nodes[:3]
    assert min(held.places(w.stream(pages[0]))) < 0
    expressions = spark.createDataFrame([("h", held.dump())], "host string, wrapper string")
    named = spark.createDataFrame([("h", i, p) for i, p in enumerate(pages)] * 2, "host string, page long, html string")
    found = w.template_texts(named, expressions).collect()
    assert sorted((r.page, r.template) for r in found) == [(i, [1]) for i in range(6)]
