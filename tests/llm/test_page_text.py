import html as entities
import re

import pytest
from pyspark.sql import functions as F

from creditloom.llm import page_text
from creditloom.llm.page_text import main_text

SCHEMA = "page_id bigint, url string, html string"


def text_of(page):
    return main_text(page, None, frozenset())


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>"<p>x</p>"
    </script></head><body class="has-sidebar"><header>Site</header><nav><ul><li>Menu</li></ul></nav>
    <div class="cookie-notice">Cookies</div><div class="ad">Buy</div>
    <div class="menu-page"><article class="post"><header><h1>A &amp;amp; B</h1></header>
    <p>One <b>bo</b>ld
     &lt;word&gt;<br>next<p>Two<!-- no --> three</p><aside>side</aside><ul><li>i<li>j</ul>
    <form><label>Name</label><input value="v"></form><div id="AdBox">Buy</div>
    <table><tr><td>c1<td>c2</table><noscript>no</noscript>
    <section class="comments"><article><p>Reader</p></article></section></article></div>
    <div class="sidebar">S</div><footer>F</footer></body></html>"""
    assert text_of(page) == "A &amp; B One bold <word> next Two three i j c1 c2"


def test_without_an_article():
    assert text_of("<body><nav>n</nav><div>a</div>b<p>c</p><footer>f</footer>") == "a b c"
    assert text_of("just text") == "just text"
    assert text_of("") == text_of(None) == text_of("<!-- x") == ""
    assert text_of("<main>a</main><p>b") == "a"


def test_broken_pages():
    assert text_of("<article><p>a</div></i><b>b<p>c</article>d<p>e") == "a b c"
    assert text_of("<article>x<script>never closed") == "x"
    assert text_of("<article><p>" + "<div>deep " * 20_000).count("deep") == 20_000


def test_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in page_text.extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        apart = re.sub(r"</?b>", "", inside)
        expected = " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", apart)).split())
        got = found[r["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (expected, len(expected), r["url"])


def host_pages(host, n, body):
    return [(i, f"http://{host}/{i}", body(i)) for i in range(n)]


def test_template_of_a_host(spark):
    """No article and no telling names: only the template shows what belongs to the host."""

    def body(i):
        return (
            "<body><div class='x1'><span>Our site</span></div><div class='x2'>"
            f"<p>Story {i} tells {i * 7} things.</p><p>{'More ' * (i + 5)}of {i}.</p>"
            "<div>Share this story</div></div><div class='x3'>All rights</div></body>"
        )

    few = [(100 + i, f"http://few.org/{i}", body(i)) for i in range(3)]
    pages = spark.createDataFrame(host_pages("a.org", 12, body) + few, SCHEMA)
    found = {r["page_id"]: r["text"] for r in page_text.extract(pages).collect()}
    for i in range(12):
        assert found[i] == f"Story {i} tells {i * 7} things. {'More ' * (i + 5)}of {i}."
    # Three pages show no template.
    assert found[101].startswith("Our site Story 1") and found[101].endswith("All rights")


def test_copies_are_no_template(spark):
    """Pages that say the same keep their text, also a text that many pages share."""
    same = host_pages("same.org", 10, lambda i: "<article><h1>T</h1><p>All the same.</p></article>")
    shared = [
        (20 + i, f"http://b.org/{i}", f"<article><p>Page {i}</p><p>Often said.</p></article>")
        for i in range(9)
    ] + [(40, "http://b.org/x", "<article><p>Page x</p></article>")]
    found = page_text.extract(spark.createDataFrame(same + shared, SCHEMA)).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert text[3] == "T All the same." and text[25] == "Page 5 Often said."


def test_templates_are_valid_classes(spark):
    def body(i):
        return f"<body><p class='t'>Same</p><p>Own {i}</p><ul>{'<li><i>x</i></li>' * (i + 1)}</ul></body>"

    rows = [(1, i, html) for i, _, html in host_pages("a", 10, body)]
    frame = spark.createDataFrame(rows, "host bigint, page bigint, html string")
    (found,) = page_text.templates(page_text.host_tokens(frame)).collect()
    # What is once on each page, and in it the list items with what is in them.
    assert found["pages"] == 10 and len(found["classes"]) == 2 and len(found["texts"]) == 1
    skeleton, items = sorted(found["classes"], key=lambda c: c["parent"] is not None)
    assert skeleton["parent"] is None and items["parent"] == skeleton["class"]
    # The page, its body, both kinds of paragraphs, the list and the text; item, <i> and text.
    assert skeleton["size"] == 6 and items["size"] == 3


def test_edges(spark):
    rows = [
        (1, None, "<p>a</p>"), (2, "http://h/", None), (None, "http://h/", "<p>n"), (3, "", ""),
        (4, "no url", "<p>" + "word " * 300_000), (5, "http://h/", "<p>r"), (5, "http://h/", "<p>r"),
    ]
    pages = spark.createDataFrame(rows, SCHEMA)
    for name in ("text", "n_chars", "host", "page", "main", "texts"):
        pages = pages.withColumn(name, F.lit("x"))
    found = page_text.extract(pages).collect()
    got = sorted((r["page_id"] or 0, r["text"][:9], r["n_chars"]) for r in found)
    assert got == [
        (0, "n", 1), (1, "a", 1), (2, "", 0), (3, "", 0), (4, "word word", 1_499_999), (5, "r", 1),
        (5, "r", 1),
    ]
    assert page_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def odd_host(spark, host, odd, n=14):
    """Pages without an article; a footer on two thirds of them; ``odd`` pages besides."""

    def body(i):
        foot = "<div class='x3'><p><i>Partly here</i></p></div>" if i % 3 else ""
        return (
            "<html><body><div class='x1'><p>Our site</p></div><div class='x2'>"
            f"<p>Story {i} tells {i * 7} things.</p></div><div class='x4'><p>All rights</p></div>"
            f"{foot}</body></html>"
        )

    rows = host_pages(host, n, body) + [(100 + i, f"http://{host}/o{i}", o) for i, o in enumerate(odd)]
    found = page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r["page_id"]: r["text"] for r in found}


@pytest.mark.parametrize(
    "odd",
    [
        [],
        [None, ""],
        ["<html><body><div class='x1'><p>Our site</p></div><div class='x2'><p>Cut"],
        ["<html><body><h1>Home</h1><ul><li>First</li><li>Second</li></ul></body></html>", None],
    ],
)
def test_template_in_spite_of_odd_pages(spark, odd):
    text = odd_host(spark, "odd.org", odd)
    for i in range(14):
        assert text[i] == f"Story {i} tells {i * 7} things."
    if odd and odd[0]:
        assert text[100] in ("Cut", "Home First Second")


def test_copies_are_no_classes(spark):
    """A page that fills half of its host's rows, with a layout of its own, keeps its text."""
    copy = "<html><body><div class='c'><h2>Copied</h2><p><i>Word</i></p><b>for word</b></div></body></html>"
    text = odd_host(spark, "copies.org", [copy] * 16)
    assert {text[100 + i] for i in range(16)} == {"Copied Word for word"}
    assert text[3] == "Story 3 tells 21 things."


def test_main_slot_is_a_gap_of_the_template(spark):
    """The slot has less text than the template around it; the loose paragraphs are not in it."""

    def body(i):
        return (
            f"<html><body><p>{i} visits</p><div class='a'><div class='b'><p>{'Same ' * 90}</p></div>"
            f"</div><div class='m'><p>{f'Own {i} ' * 9}</p></div></body></html>"
        )

    found = page_text.extract(spark.createDataFrame(host_pages("g.org", 9, body), SCHEMA)).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: (f"Own {i} " * 9).strip() for i in range(9)}


def test_names_inside_an_article():
    kept = (
        "<section id='related-work'>a</section><div class='social-sciences'>b</div><p id='share-price'>c"
        "<p class='notice'>d</p><h2 class='menu-costs'>e</h2>"
    )
    left_out = (
        "<div class='related-posts'>f</div><div class='share-buttons'>g</div><p class='ad-1'>h</p>"
        "<ul class='post-list comments'><li>i</ul><div class='cookie-notice'>j</div>"
    )
    assert text_of(f"<article>{kept}{left_out}</article>") == "a b c d e"
    assert text_of(f"<div role='main'>{kept}{left_out}</div>") == "a b c d e"
    slot = page_text.PageReader().opened("div", "class='m'").path
    assert main_text(f"<div class='m'>{kept}{left_out}</div>", slot, frozenset()) == "a b c d e"


def test_heads_outside_an_article():
    page = "<div class='site-header'>s</div><header>t</header><div class='entry-header'><h1>Title</h1></div>"
    assert text_of(page + "<header class='entry-header'>By</header><p>x") == "Title By x"


NAMELESS = [
    (r"<(/?)(?:article|main|nav|header|footer|aside|section)\b", r"<\1div"),
    (r' (?:class|id|role)="[^"]*"', ""),
]


def test_the_template_alone_finds_the_article(spark, sf_dir):
    """All pages of the table, their elements without telling names: the host's template tells."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    by_host = {}
    for r in pages:
        by_host.setdefault(r["url"].split("/")[2], []).append(r)
    rows, expected = [], {}
    for own in by_host.values():
        for r in own:
            nameless = r["html"]
            for pattern, plain in NAMELESS:
                nameless = re.sub(pattern, plain, nameless)
            rows.append((r["page_id"], r["url"], nameless))
            if len(own) >= page_text.LEAST_PAGES:
                expected[r["page_id"]] = text_of(r["html"])
    found = page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r["page_id"]: r["text"] for r in found}
    if expected:
        same = sum(got[i] == text for i, text in expected.items())
        assert same == len(expected)
        # Without the template what belongs to the host would stay.
        assert all(text_of(html) != expected[i] for i, _, html in rows if i in expected)


def test_articles_elsewhere_are_teasers(spark):
    def body(i):
        return (
            f"<body><div class='x'><article>Read this as well {i}</article></div>"
            f"<div class='story'><h1>Title {i}</h1>{f'<p>word{i} and more</p>' * (5 + i)}</div></body>"
        )

    pages = spark.createDataFrame(host_pages("a.org", 12, body), SCHEMA)
    found = {r["page_id"]: r["text"] for r in page_text.extract(pages).collect()}
    assert found[3] == "Title 3" + " word3 and more" * 8


def test_the_title_of_an_article_stays(spark):
    def body(i):
        return (
            f"<body><article><h1>Title {i}</h1><div class='text'><p>{f'word{i} ' * 40}</p></div>"
            "</article><div>Bottom</div></body>"
        )

    pages = spark.createDataFrame(host_pages("a.org", 12, body), SCHEMA)
    found = {r["page_id"]: r["text"] for r in page_text.extract(pages).collect()}
    assert found[3] == "Title 3 " + ("word3 " * 40).strip()


def test_names_that_only_hold_a_word_of_furniture():
    page = "<body><p class='share-price'>a</p><div id='related-work'>b</div><div class='share'>c</div></body>"
    assert text_of(page) == "a b"


@pytest.mark.parametrize("part", ["<a ", '<a b="', "<!--", "<a", "</", "<?", "<![CDATA[", "<", "<a b='\">"])
def test_time_grows_with_length(part):
    import time

    for end in ("", ">"):
        start = time.process_time()
        text_of(part * ((1 << 20) // len(part)) + end)
        assert time.process_time() - start < 8


def test_pages_that_end_within_markup():
    assert text_of("<p>a</p>b <i") == "a b <i"
    assert text_of("<p>a</p>b <!-- c") == "a b"
    assert text_of("<p>a</p>b <!-- c > d") == "a b"
    assert text_of("<p>a</p><![CDATA[b > c") == "a b > c"
    assert text_of("<p>a</p>b </p") == "a b"
    assert text_of("a <!-- x --> b <!-- > -->c &amp; <") == "a b c & <"
