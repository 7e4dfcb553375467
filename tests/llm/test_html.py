import itertools
import random

from candlewick.llm.html_extract import content_blocks, extract_main_text, extract_text, min_cut, parse_blocks

PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<div id="cookie-notice"><p>We use cookies to improve your visit. Accept them please.</p></div><div class="layout">
<div class="sidebar"><ul><li><a href=x>Link one</a></li><li>Two</li></ul><p>About this site we know nothing at all.</p></div>
<div class="post-content"><h1>Title &amp; more</h1><p>First   paragraph<br>with&nbsp;text, and a <a href=z>link</a> inside. It has sentences.</p><p>Short.</p>
<form><p>Enter your email here to get more.</p></form><div class="ad">Buy this now, it is good.</div></div>
<section class="comments"><h2>Comments</h2><p>Nice article, I liked it a lot. Thanks.</p></section></div><script>var t="</p>";</script><footer><p>Copyright by us.</p></footer></body></html>"""


def test_article_without_chrome():
    assert extract_text(PAGE) == "Title & more\n\nFirst paragraph with text, and a link inside. It has sentences.\n\nShort."


def test_broken_markup():
    assert extract_text("") == ""
    assert extract_text("<p>One sentence that is long enough to stay. Yes.</p><!-- open <p>gone") == "One sentence that is long enough to stay. Yes."
    assert extract_text("<article><p><b>Open tags are read on. They never close.<br><p>Next one, a < b & c.") == "Open tags are read on. They never close.\n\nNext one, a < b & c."
    assert extract_text("<nav><a href='x'>Only</a> <a href=y>links</a></nav>") == ""


def test_adversarial_pages_are_linear():
    for page in ("<p>" + "<b x='" * 20000, "<!-- " * 20000, "<div>a " * 20000, "<div>" * 20000 + "</span>" * 20000, "<" * 50000, "<p a='>" * 20000, "<p a=\">" * 20001 + "<p b='>" * 20001, "<i x=" * 30000 + ">"):
        extract_text(page)


def test_min_cut_against_brute_force():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randint(1, 9)
        scores = [rnd.choice([rnd.uniform(-2, 2), 0.0, 1.0]) for _ in range(n)]
        edges = [(a, b, rnd.choice([0.5, rnd.uniform(0, 1.5)])) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.4]

        def cost(labels):
            return sum(max(-s, 0) if x else max(s, 0) for x, s in zip(labels, scores)) + sum(c for a, b, c in edges if labels[a] != labels[b])

        assert abs(cost(min_cut(scores, edges)) - min(cost(x) for x in itertools.product((0, 1), repeat=n))) < 1e-9


def test_edges_join_neighbours_and_siblings():
    texts, scores, _, edges = parse_blocks("<div><p>a</p><p>b</p></div><p>c</p>")
    assert texts == ["a", "b", "c"] and len(scores) == 3
    capacity = {(a, b): c for a, b, c in edges}
    assert capacity[0, 1] > capacity[1, 2] > 0


def both_ways(page):
    """(texts over 0 by the classifier alone, texts by the cut)."""
    texts, scores, second, edges = parse_blocks(page)
    return [t for t, x in zip(texts, scores) if x > 0], [t for t, x in zip(texts, content_blocks(scores, second, edges)) if x]


LONG = "The harbour was rebuilt after the storm, and the ships came back. Trade grew for thirty years, until the railway took most of it away. "


def test_the_cut_decides_ambiguous_blocks():
    # short lines inside an article, with and without elements that say so
    for open_, close in (("<article>", "</article>"), ("<div>", "</div>")):
        page = f"<body>{open_}<h1>Harbour</h1><p>{LONG * 3}</p><p>Yes.</p><p>{LONG * 2}</p><h2>Later</h2><p>{LONG * 2}</p>{close}</body>"
        alone, cut = both_ways(page)
        assert cut == ["Harbour", (LONG * 3).strip(), "Yes.", (LONG * 2).strip(), "Later", (LONG * 2).strip()] and alone != cut
    # a line that the classifier takes for content, among boilerplate
    line = "All prices include tax and may change at any time without further word from us. Call us. Write to us today."
    alone, cut = both_ways(f"<body><div><p>Home</p><p>{line}</p><p>Shop</p><p>Help</p></div><article><p>{LONG * 3}</p><p>{LONG * 3}</p></article></body>")
    assert line in alone and line not in cut and (LONG * 3).strip() in cut


def test_long_attributes():
    data = "x&quot;y" * 2000
    for attrs in (f'alt="a > b" data-x="{data}"', f"data-x='{data}' alt='a > b'", f'alt="\'>\'" title="c > d" data-x="{data}"', "alt=it's data-y=\"a>b\""):
        assert extract_text(f"<article><p>{LONG}</p><p><img {attrs}>{LONG}</p><p>{LONG}</p></article>") == "\n\n".join([LONG.strip()] * 3), attrs[:30]
    assert extract_text(f"<article><p>{LONG}</p><p title='open>{LONG}</p></article>") == "\n\n".join([LONG.strip()] * 2)


def test_words_that_articles_use_too():
    body = f"<p>{LONG * 2}</p><p>{LONG * 2}</p>"
    want = "\n\n".join([(LONG * 2).strip()] * 2)
    assert extract_text(f'<body><nav>Menu of this site</nav><div id="book-reviews">{body}</div></body>') == want
    assert extract_text(f'<body><main><div class="news-tags legal">{body}</div></main><footer><p>{LONG}</p></footer></body>') == want
    assert extract_text(f'<body><article>{body}</article><div class="reviews"><p>Nice read, thanks. Loved it.</p></div></body>') == want
    assert extract_text(f'<body><div class="comments">{body}</div><aside>{body}</aside></body>') == ""


def test_reader_comments_however_long():
    page = f'<article><p>{LONG}</p><section class="comments"><p>{LONG * 30}</p><p>{LONG * 9}</p></section></article><div id="comments"><p>{LONG * 30}</p></div>'
    assert extract_text(page) == LONG.strip()


def test_operator(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (3, "v", "", "z"), (4, "w", "<p>" + "word and more. " * 50000, "q")]
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.page_id in (2, 3)] == ["", ""]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_article_pages_of_the_tables(spark, sf_dir):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|div|article)[^>]*>", article)]
        assert r.text == "\n\n".join(x for x in blocks if x)
