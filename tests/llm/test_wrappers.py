import random
import time

import pytest

from pontualis.llm import wrappers
from pontualis.llm.queries import QUERIES

WORDS = "the wind over hills brings rain to every old town while people wait for better light".split()

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav>
<div class="ad banner-top">Buy</div><article><h1>Title &amp; more</h1>
<p>First   <b>bold</b>&nbsp;text<br>after break</p><script>var x="</p>";</script><!-- no -->
<div class="cookie-notice">We use</div><p>Second &lt;p&gt; &#233;</p>
<form><input value="x"> Name</form><section id="comments"><p>Nice!</p></section>
<aside>Side</aside><div role="navigation">More</div></article>
<div class="sidebar">S</div><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert wrappers.main_text(PAGE, "article") == \
        "Title & more First bold text after break Second <p> é"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("<article>x", "x"),
    ("<article>a</article>b", "a"), ("<article><p>a &am", "a &am"), ("<b", "<b"),
    ("<article><script>never closed", ""), ("</p></div><article>ok</article>", "ok"),
    ("<article>a<i>b</i>c<br/>d</article>", "abc d"), ("<ARTICLE CLASS='x'>y</ARTICLE>", "y"),
    ("<article><img alt='>'>z</article>", "z"), ("<article class=ad>kept</article>", "kept"),
])
def test_odd_pages(page, text):
    main = "article" if "article" in page.lower() else None
    assert wrappers.main_text(page, main) == text


def wrapper(*pages):
    items = None
    for page in pages:
        now = wrappers.folded(wrappers.stream(page))
        items = now if items is None else wrappers.aligned(items, now)
    return items


def test_groups_are_inferred():
    one = "<ul><li>a</li><li>b</li><li>c</li></ul><h1>x</h1><p>same</p>"
    two = "<ul><li>d</li><li>e</li></ul><h1>y</h1><img><p>same</p>"
    assert wrappers.as_text(wrapper(one, two)) == \
        "<ul> ( <li> # </li> )+ </ul> <h1> # </h1> ( <img> )? <p> same </p>"
    three = "<ul><li>f</li></ul><h1>z</h1><p>same</p>"
    assert "( <li> # </li> )" in wrappers.as_text(wrapper(one, two, three))


def test_wrappers_do_not_grow_with_pages():
    def page(n):
        blocks = "".join(f"<p>{i}</p>" if (n >> i) & 1 else f"<p><b>{i}<br></p>" for i in range(7))
        return f"<html><body><article>{blocks}</article></body></html>"

    few, many = (len(wrappers.as_text(wrapper(*map(page, range(n))))) for n in (12, 120))
    assert many <= 3 * few


def test_storage_keeps_wrappers():
    items = wrapper("<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>a</li></ul>")
    assert wrappers._loaded(wrappers._dumped(items)) == items


def test_extract(spark):
    pages = [(i, f"http://h{i % 2}.example/{i}", PAGE.replace("Second", f"Second {i}"), "x")
             for i in range(8)]
    pages += [(8, None, "<p>no host</p>", "x"), (9, "http://h0.example/", None, "x"),
              (8, None, "<p>no host</p>", "x"), (None, "", "", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    text, found = wrappers.extract(df)
    got = sorted(((r.id, r.text) for r in text.collect()), key=str)
    assert len(got) == len(pages)
    assert dict(got)[3] == "Title & more First bold text after break Second 3 <p> é"
    assert dict(got)[8] == "no host" and dict(got)[9] == "" and dict(got)[None] == ""
    by_host = {r.host: r for r in found.collect()}
    assert by_host["h0.example"].main == "article" and by_host["h0.example"].pages == 5
    empty, _ = wrappers.extract(df.limit(0))
    assert empty.count() == 0


def test_template_texts_go_where_there_is_no_article(spark):
    pages = [(i, "http://h/x", f"<body><div>Always here</div><div>Own text {i}</div></body>")
             for i in range(5)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    text, _ = wrappers.extract(df)
    assert {r.text for r in text.collect()} == {f"Own text {i}" for i in range(5)}


@pytest.mark.parametrize("articles", [1, 8])
def test_template_texts_go_from_pages_without_article(spark, articles):
    body = "<body><div>Always here</div>{}</body>"
    pages = [(i, "http://h/x", body.format(f"<div>Own text {i}</div>")) for i in range(5)]
    pages += [(9 + i, "http://h/x", body.format(f"<article>Article {i}. <p>Always here</p></article>"))
              for i in range(articles)]
    pages += [(99, "http://h/x", body.format("<!-- <article> --><main>Main only</main>"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    text, _ = wrappers.extract(df)
    assert {r.text for r in text.collect()} == {
        *(f"Own text {i}" for i in range(5)),
        *(f"Article {i}. Always here" for i in range(articles)), "Main only"}


def test_few_pages_without_article_among_many(spark):
    body = "<body><div>Always here</div>{}</body>"
    pages = [(i, "http://h/x", body.format(f"<article>Article {i}</article>")) for i in range(9)]
    pages += [(9, "http://h/x", body.format("<div>Own</div>"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    text, _ = wrappers.extract(df)
    assert {r.text for r in text.collect()} == {"Own", *(f"Article {i}" for i in range(9))}


@pytest.mark.parametrize("page, text", [
    ("<main><div class='post no-sidebar'><p>Body of it</p></div></main>", "Body of it"),
    ("<article><p>Teaser</p></article><main><p>The main text of this page.</p><p>More of it.</p></main>",
     "The main text of this page. More of it."),
    ("<article><p>One</p><p class='legal'>Two</p><h2 class='social'>Three</h2></article>", "One Two Three"),
    ("<article><p>Long enough to be the text</p><div class='share-buttons'>Share</div>"
     "<div id='ad-top'>Buy</div></article>", "Long enough to be the text"),
    ("<article><div class='related'><p>All the text is in here, whatever it is called.</p></div></article>",
     "All the text is in here, whatever it is called."),
    ("<main><article><p>The article's own words here</p></article><p>a remark</p></main>",
     "The article's own words here"),
    ("<body><div class='has-sidebar'>Own words of a page</div><div class='sidebar'>Side</div></body>",
     "Own words of a page"),
])
def test_slots_decide(spark, page, text):
    """As the only page of a host, and as one of many."""
    rows = [(0, "http://one/", page), *[(i, "http://many/", page.replace("of", f"of{i}")) for i in range(1, 5)]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.id: r.text for r in wrappers.extract(df)[0].collect()}
    assert got == {i: text.replace("of", f"of{i}") if i else text for i in range(5)}


def test_generated_hosts(spark):
    """Pages of five hosts from known templates, with the text that was put into each."""
    dice = random.Random(5)

    def sentence(n):
        return " ".join(dice.choice(WORDS) for _ in range(n)) + "."

    def menu():
        return "<ul>" + "".join(f"<li><a href='/{i}'>{dice.choice(WORDS)}</a></li>" for i in range(dice.randrange(2, 6))) + "</ul>"

    def body():
        """HTML and its text, as blocks."""
        blocks, out = [], []
        for _ in range(dice.randrange(3, 9)):
            kind, words = dice.randrange(4), sentence(dice.randrange(12, 40))
            if kind == 0:
                out.append(f"<h2>{words}</h2>")
            elif kind == 1:
                out.append(f"<p class='lead'>{words.replace('.', ' <b>now</b> &amp; then.')}</p>")
                words = words.replace(".", " now & then.")
            elif kind == 2:
                more = sentence(5)
                out.append(f"<ul><li>{words}</li>\n<li>{more}</li></ul>")
                blocks.append(words)
                words = more
            else:
                out.append(f"<p>{words}</p>")
            blocks.append(words)
        return "".join(out), " ".join(blocks)

    shells = [
        lambda b: f"<nav>{menu()}</nav><div class='ad'>{sentence(9)}</div><article>{b}</article><footer>{sentence(6)}</footer>",
        lambda b: f"<header>{menu()}</header><article><p>{sentence(4)}</p></article><main><div class='post no-sidebar'>{b}"
                  f"</div><div id='comments'>{sentence(8)}</div></main><aside>{sentence(5)}</aside>",
        lambda b: f"<div role='navigation'>{menu()}</div><main><div class='content related'>{b}</div>"
                  f"<div class='cookie-notice'>{sentence(7)}</div><form>{sentence(3)}</form></main>",
        lambda b: f"<main><article>{b}<section class='comments-area'>{sentence(9)}</section></article></main><footer>x</footer>",
        lambda b: f"<div>Always here</div><div class='site-header'>{menu()}</div><div>{b}</div><div>Contact us</div>",
    ]
    rows, wanted = [], {}
    for host, shell in enumerate(shells):
        for _ in range(12):
            html, text = body()
            wanted[len(rows)] = text
            rows.append((len(rows), f"https://host{host}.example/{len(rows)}", f"<html><head><title>t</title></head><body>{shell(html)}</body></html>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out, found = wrappers.extract(df)
    assert {r.id: r.text for r in out.collect()} == wanted
    by_host = {r.host: r for r in found.collect()}
    assert [by_host[f"host{i}.example"].main for i in range(5)] == ["article", "main", "main", "article", None]
    assert by_host["host2.example"].kept == ["content related"] and by_host["host0.example"].pages == 12


def test_very_long_pages_take_no_long_time():
    long = "<article>" + "".join(f"<p>paragraph {i} of some words &amp; more</p>\n" for i in range(24_000)) + "</article>"
    for page, least in ((long, 500_000), ("<a " * 20_000, 50_000), ("<p " * 20_000 + ">", 40_000),
                        ("<!-- " * 20_000, 0), ("</p" * 20_000, 50_000)):
        start = time.perf_counter()
        assert len(wrappers.main_text(page, wrappers.main_of(page))) >= least
        wrappers.folded(wrappers.stream(page))
        assert time.perf_counter() - start < 10  # about one on an idle machine


def test_query_takes_every_page_and_more_columns(spark, folder):
    rows = [(1, "http://h/", "<article>a b</article>"), (1, "http://h/", "<article>a b</article>"), (None, None, None),
            (2, "", ""), (3, "no host", "<p>é &#x1F600;</p>")]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows],
                               "page_id long, url string, html string, host string, template string")
    place = folder(pages=df)
    got = sorted(map(str, ((r.page_id, r.text, r.n_chars) for r in QUERIES["op4_html_extraction"](spark, place).collect())))
    assert got == sorted(map(str, [(1, "a b", 3), (1, "a b", 3), (None, "", 0), (2, "", 0), (3, "é \U0001f600", 3)]))
    empty = spark.createDataFrame([], df.schema)
    assert wrappers.extract(empty)[0].count() == 0
