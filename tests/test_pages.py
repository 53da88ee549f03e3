import re
import sys
import time
from html.parser import HTMLParser
from unittest import mock

import duckdb
import pytest
from conftest import failing_once
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.functions import html as html_reader
from creditloom.functions.html import read_page
from creditloom.operators import page_nodes as P

STATUS_PAGE = """<html><body>
<div class="outer status-green" data-id="a1" data-status="operational">A</div>
<div class="inner status-green" data-id="a2" data-status="degraded"><span>East</span></div>
<table class="table-service-status">
 <tr><th>Region</th><th>Status</th></tr>
 <tr><td>East US 2</td><td class="wide col-status"> Operational </td></tr>
 <tr><td>West US</td><td class="col-status"><b>Degraded</b></td></tr>
 <tr><td>West Europe</td></tr>
</table>
<p class="col-status">after</p></body></html>"""


class Found:
    """A node with its text."""

    def __init__(self, node, strings):
        for name in ("pos", "parent_pos", "below", "tag", "attrs"):
            setattr(self, name, getattr(node, name))
        own = strings.get(node.kind, [])
        self.text = "".join(own[node.start : node.start + node.count])


def read_nodes(html, tags=None, with_text=True):
    nodes, strings, _ = read_page(html, tags, with_text)
    return [Found(node, strings) for node in nodes]


def nodes_of(html, tags=None, with_text=True):
    wanted = None if tags is None else frozenset(tags)
    nodes = read_nodes(html, wanted, with_text)
    return [(n.tag, n.text, n.parent_pos) for n in nodes]


def elements(html):
    return [(tag, text) for tag, text, _ in nodes_of(html) if tag != P.TEXT]


def test_unclosed_elements_end_with_their_parent():
    assert elements("<div><p><b>one<br><p>two</p> x</div>y") == [
        ("div", "onetwo x"), ("p", "onetwo x"), ("b", "onetwo x"), ("br", ""), ("p", "two"),
    ]


def test_end_tags_without_a_start_are_ignored():
    assert elements("</p><i>a</b></i></i>b</br>") == [("i", "a")]


def test_crossed_tags_close_up_to_the_match():
    assert elements("<a><b>x</a>y</b>") == [("a", "x"), ("b", "x")]


def test_strings_that_stand_apart():
    html = "<div>a<script>if (x < '</p>') y</script><style>p{}</style><!-- no -->b</div>"
    assert elements(html) == [("div", "ab"), ("script", "if (x < '</p>') y"), ("style", "p{}")]
    strings = [text for tag, text, _ in nodes_of(html) if tag == P.TEXT]
    assert strings == ["a", "if (x < '</p>') y", "p{}", "b"]


def test_references_and_attributes():
    html = '<A HREF="/x?a=1&amp;b=2" disabled CLASS=c1 class="c2">&lt;&eacute;&#233;&amp</A>'
    node = read_nodes(html, frozenset("a"), True)[0]
    assert node.attrs == {"href": "/x?a=1&b=2", "disabled": "", "class": "c2"}
    assert node.text == "<éé&"


def test_blank_strings():
    assert [t for _, t, _ in nodes_of("<p>  </p><p> \n </p><pre>  </pre>", [P.TEXT])] == [
        " ", "\n", "  ",
    ]


def test_self_closed_and_void():
    assert elements("<div/>a<img src=x/>b<p>c</p>") == [("div", ""), ("img", ""), ("p", "c")]


def test_positions():
    nodes = read_nodes("<a>x<b><c></c></b></a><d></d>", None, False)
    found = [(n.tag, n.pos, n.parent_pos, n.below) for n in nodes]
    assert found == [
        ("a", 0, None, 3), (P.TEXT, 1, 0, 0), ("b", 2, 0, 1), ("c", 3, 2, 0), ("d", 4, None, 0),
    ]
    assert [n.below for n in read_nodes("<a>x<b><c></c></b></a>", frozenset("ac"), False)] == [1, 0]


def test_kept_tags_do_not_move_positions():
    everything = {n.pos: n.tag for n in read_nodes(STATUS_PAGE, None, False)}
    for node in read_nodes(STATUS_PAGE, frozenset(["td"]), True):
        assert everything[node.pos] == "td"


@pytest.mark.parametrize("html", ["", "   ", "plain", "<", "<a", "<a b='", "<!", "<![x[", "</", "&"])
def test_scraps_do_not_fail(html):
    read_nodes(html, None, True)


PIECES = ["<a>", "</a>", "<b c='1'>", "</b>", "<br>", "<br/>", "<p>", "</p>", "x", " ", "&amp;",
          "<!-- c -->", "<script>", "</script>", "<b", ">", "<ul><li>", "</ul>", "\n"]


@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_nodes_form_a_tree(html):
    nodes = read_nodes(html, None, True)
    assert [n.pos for n in nodes] == list(range(len(nodes)))
    for node in nodes:
        below = nodes[node.pos + 1 : node.pos + 1 + node.below]
        end = node.pos + node.below
        assert all(n.parent_pos is not None and n.parent_pos >= node.pos for n in below)
        if node.parent_pos is not None:
            parent = nodes[node.parent_pos]
            assert parent.pos < node.pos <= end <= parent.pos + parent.below
            assert parent.tag not in (P.TEXT, "br")
        if node.tag not in (P.TEXT, "script"):
            own = [n for n in below if n.tag == P.TEXT and nodes[n.parent_pos].tag != "script"]
            assert node.text == "".join(n.text for n in own)


@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_kept_tags_are_a_selection(html):
    everything = read_nodes(html, None, True)
    chosen = read_nodes(html, frozenset(["b", "li"]), True)
    key = [(n.pos, n.parent_pos, n.tag, n.attrs, n.text) for n in everything]
    assert [(n.pos, n.parent_pos, n.tag, n.attrs, n.text) for n in chosen] == [
        k for k in key if k[2] in ("b", "li")
    ]
    for node in chosen:
        below = everything[node.pos + 1 : node.pos + 1 + everything[node.pos].below]
        assert node.below == sum(n.tag in ("b", "li") for n in below)


def test_a_rejected_page_does_not_fail_the_others(spark):
    rows = [(1, "<p>&#" + "9" * 5000 + ";</p>"), (2, "<p>a</p>")]
    parsed = P.parse_pages(spark.createDataFrame(rows, "page_id int, html string"), tags=["p"])
    found = {r["page_id"]: (len(r["nodes"]), r["error"] is None) for r in parsed.collect()}
    assert found == {1: (1, False), 2: (1, True)}


def test_a_rejected_page_keeps_what_came_before(spark):
    rows = [(1, "<p>a</p><b>b</b><![foo bar]><i>c</i>")]
    parsed = P.parse_pages(spark.createDataFrame(rows, "page_id int, html string"))
    tags = P.node_rows(parsed).where("tag != '#text'").select("tag", "text").collect()
    assert [tuple(r) for r in tags] == [("p", "a"), ("b", "b")]
    assert parsed.first()["error"]


def test_deep_and_long_pages_take_linear_space(spark):
    deep = "<div>some words here " * 15_000
    long = "<p>" + "word " * 200_000
    rows = [(1, deep), (2, long)]
    parsed = P.parse_pages(spark.createDataFrame(rows, "page_id int, html string"))
    held = parsed.select(
        "page_id", F.size("nodes").alias("nodes"), F.length(F.array_join(F.col("strings")[""], "")).alias("chars")
    ).collect()
    assert {r["page_id"]: (r["nodes"], r["chars"]) for r in held} == {
        1: (30_000, 15_000 * 16), 2: (2, 1_000_000),
    }
    first = P.node_text(P.first_node("nodes", P.where(tag="div")))
    assert len(parsed.where("page_id = 1").select(first).first()[0]) == 15_000 * 16


def test_only_strings_of_kept_nodes_are_passed_on(spark):
    html = "<p>a<b>b</b><i>c</i></p>d<script>e</script><b>f<i>g</i></b>"
    parsed = P.parse_pages(spark.createDataFrame([(1, html)], "page_id int, html string"), tags=["b", "i"])
    row = parsed.first()
    assert row["strings"] == {"": ["b", "c", "f", "g"], "script": []}
    texts = P.node_rows(parsed).select("tag", "text").collect()
    assert [tuple(r) for r in texts] == [("b", "b"), ("i", "c"), ("b", "fg"), ("i", "g")]


TAGS = st.builds(
    "<{}{}{}>{}".format,
    st.sampled_from(["p", "DIV", "a1", "br", "title", "script", "b-c", "1", "é"]),
    st.lists(
        st.sampled_from([' a="1"', '\n B="x y"', " c", " d='2'", ' e="&amp;"', 'f="3"', ' a="4"',
                         "\u00a0g=\"5\"", ' h="<"', ' i-j=""', " k=v", "/"])
    ).map("".join),
    st.sampled_from(["", " ", "/", " /", "\t", "<"]),
    st.sampled_from(["", "text", "</p>", "</title>", "</script>"]),
)


@given(st.lists(TAGS, max_size=6).map("".join))
def test_plain_tags_read_the_same(html):
    def read():
        nodes = read_nodes(html, None, True)
        return [(n.pos, n.parent_pos, n.below, n.tag, n.attrs, n.text) for n in nodes]

    plain = read()
    with mock.patch.object(html_reader, "PLAIN_TAG", re.compile("(?!)")):
        assert read() == plain


class StandardReader(HTMLParser):
    """The same nodes by way of the standard library's tokenizer."""

    def __init__(self, reader):
        super().__init__(convert_charrefs=True)
        self.reader = reader
        self.handle_starttag, self.handle_endtag = reader.on_start, reader.on_end
        self.handle_data, self.unknown_decl = reader.on_data, reader.on_section
        self.handle_comment = self.handle_decl = self.handle_pi = lambda data: reader.on_apart()

    def scan(self, html):
        self.feed(html)
        self.close()


def by_standard_library(html):
    reader = html_reader.PageReader(None, True)
    reader.scan = StandardReader(reader).scan
    return reader, reader.read(html)


def same_as_standard(html):
    expected, expected_error = by_standard_library(html)
    nodes, strings, error = read_page(html, None, True)
    key = [(n.pos, n.parent_pos, n.below, n.tag, n.attrs, n.kind, n.start, n.count) for n in nodes]
    assert key == [
        (n.pos, n.parent_pos, n.below, n.tag, n.attrs, n.kind, n.start, n.count)
        for n in expected.nodes
    ]
    assert strings == expected.strings and error == expected_error


# Later versions of the library read comments, raw text and scraps in another way.
as_in_library = pytest.mark.skipif(
    not (3, 12) <= sys.version_info < (3, 13, 4), reason="another version of the tokenizer"
)
SCRAPS = [
    "<", ">", "<a", "<a ", "</", "</a", "</a >", "</ a>", "</1>", "</>", "<!", "<!-", "<!--", "--", "-->",
    "<?", "?>", "<![", "<![CDATA[", "]]>", "<![if x", "]>", "<!doctype x", "=", "\"", "'", "/", "/>", " ",
    "\n", "\x00", "\u00a0", "b", "b=", "c='", 'd="', "e=f", "&", "&amp", "&#65;", "&lt;", "x y",
    "<script>", "</script>", "<style ", "</STYLE >", "<p>", "<br/>", "<i/ >", "é", "<é>", "<b\x00",
]


@as_in_library
@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(SCRAPS), max_size=25).map("".join))
def test_scraps_read_as_by_the_standard_library(html):
    same_as_standard(html)


@as_in_library
@settings(max_examples=300, deadline=None)
@given(st.lists(TAGS | st.sampled_from(SCRAPS), max_size=12).map("".join))
def test_tags_read_as_by_the_standard_library(html):
    same_as_standard(html)


@as_in_library
def test_all_pages_read_as_by_the_standard_library(sf_dir):
    pages = duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet' WHERE html IS NOT NULL").fetchall()
    for (html,) in pages:
        same_as_standard(html)


MEGABYTE = 1 << 20


@pytest.mark.parametrize(
    "part",
    ["<a ", '<a b="', "<a b='", "<!--", "<!-- >", "<a", "</a", "</", "<?", "<!x", "<![cdata[", "<![if x ",
     "<![cdata[ >", "<a b=\"> '", "<a b='\">", "<a b=c ", "<a/", "<", "&", "<a b=\">'<a c='>\"", "]] ", "<a\t\n",
     "<script>", "<p>", "<a =", "<a b=\"'<c d='\">"],
)
def test_time_grows_with_length(part):
    """A megabyte of any scrap, also with a closing sign at its very end."""
    for end in ("", ">", '">', "'\">"):
        html = part * (MEGABYTE // len(part)) + end
        start = time.process_time()
        read_page(html, frozenset("a"), True)
        assert time.process_time() - start < 6


def test_deep_nesting():
    assert len(read_nodes("<i>" * 20_000 + "x", None, False)) == 20_001


@pytest.fixture
def status(spark):
    rows = [(1, STATUS_PAGE), (2, None), (3, "<p>nothing here</p>")]
    return spark.createDataFrame(rows, "page_id bigint, html string")


def test_first_by_tag_and_attributes(status):
    parsed = P.parse_pages(status)
    both = P.where(tag="div", attrs={"class": "status-green", "data-id": "a2"})
    first = P.first_node("nodes", both)
    rows = parsed.select("page_id", P.node_text(first), first["attrs"]["data-status"])
    rows = rows.orderBy("page_id")
    assert [tuple(r) for r in rows.collect()] == [
        (1, "East", "degraded"), (2, None, None), (3, None, None),
    ]


def test_first_by_attribute_alone(status):
    first = P.first_node("nodes", P.where(attrs={"data-id": "a1"}))
    row = P.parse_pages(status).select(first["tag"], first["attrs"]["data-status"]).first()
    assert tuple(row) == ("div", "operational")


@pytest.mark.parametrize(
    ("value", "count"),
    [("status-green", 2), ("inner status-green", 1), ("status-green inner", 0), ("status", 0),
     ("outer status-green ", 0)],
)
def test_class_is_a_list_of_names(status, value, count):
    found = P.all_nodes("nodes", P.where(tag="div", attrs={"class": value}))
    assert P.parse_pages(status, tags=["div"]).select(F.size(found)).first()[0] == count


def test_exact_string(status):
    first = P.first_node("nodes", P.where(string="East"))
    row = P.parse_pages(status).select(P.node_text(first), first["tag"]).first()
    assert tuple(row) == ("East", P.TEXT)


def inside(pages, tags, outer, inner):
    found = P.first_inside("nodes", outer, inner)
    rows = P.parse_pages(pages, tags=tags).select("page_id", "strings", F.inline(found))
    text = P.stripped(P.node_text(F.col("found"))).alias("text")
    ordered = rows.select("page_id", "node.pos", text).orderBy("page_id", "pos").collect()
    return [r["text"] for r in ordered]


def test_cell_of_the_row_that_names_a_region(status):
    cell = P.where(tag="td", attrs={"class": "col-status"})
    every = [None, "Operational", "Degraded", None]
    assert inside(status, ["tr", "td"], P.where(tag="tr"), cell) == every
    assert inside(status, None, P.where(tag="tr"), cell) == every
    assert inside(status, ["tr", "td"], P.where(tag="tr", contains="West US"), cell) == ["Degraded"]


@pytest.mark.parametrize("tags", [None, ["table", "tr", "td"]])
def test_cells_of_the_rows_of_the_first_table(status, tags):
    """First table of a class, all its rows, the cell of the row that names a region, stripped."""
    table = P.where(tag="table", attrs={"class": "table-service-status"})
    rows = P.all_inside("nodes", table, P.where(tag="tr"))
    cells = P.first_inside(
        "nodes", P.where(tag="tr", contains="East US 2"), P.where(tag="td", attrs={"class": "col-status"}),
        among=rows,
    )
    found = P.parse_pages(status, tags=tags).select("page_id", "strings", F.inline_outer(cells))
    text = P.stripped(P.node_text(F.col("found"))).alias("text")
    assert {r["page_id"]: r["text"] for r in found.select("page_id", text).collect()} == {
        1: "Operational", 2: None, 3: None,
    }


def test_stripped(spark):
    df = spark.createDataFrame([("\u00a0\n a  b\x1f ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(P.stripped(F.col("t"))).collect()] == ["a  b", "", None]


def test_inside_is_strictly_below(spark):
    html = "<ul><li>a<ul><li>b</li></ul></li></ul><li>c</li>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert inside(pages, ["li"], P.where(tag="li"), P.where(tag="li")) == ["b", None, None]


def test_copies_of_a_page_do_not_mix(spark):
    rows = [(1, "<p>a<b>x</b></p>")] * 5 + [(1, "<p>c</p>")]
    pages = spark.createDataFrame(rows, "page_id int, html string")
    found = inside(pages, ["p", "b"], P.where(tag="p"), P.where(tag="b"))
    assert sorted(map(str, found)) == ["None"] + ["x"] * 5


def test_pages_survive_batches(spark, conf, monkeypatch):
    """Pages larger than a batch's share and batches of a few pages give the same rows."""
    text = F.repeat(F.lit("x"), (F.col("id") * 7).cast("int"))
    pages = spark.range(0, 500, 1, 3).select(
        F.col("id").alias("page_id"), F.concat(F.lit("<p>"), text, F.lit("</p>")).alias("html")
    )
    monkeypatch.setattr(P, "BATCH_CHARS", 1000)
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    rows = P.node_rows(P.parse_pages(pages, tags=["p"]))
    sizes = {r["page_id"]: len(r["text"]) for r in rows.collect()}
    assert sizes == {i: i * 7 for i in range(500)}


def test_a_lost_task_repeats_no_page(spark):
    pages = spark.range(0, 200, 1, 8).select(
        F.col("id").alias("page_id"), F.concat(F.lit("<p>"), "id", F.lit("</p>")).alias("html")
    )
    rows = P.node_rows(failing_once(P.parse_pages(pages, tags=["p"]), 2)).collect()
    assert sorted((r["page_id"], r["text"]) for r in rows) == [(i, str(i)) for i in range(200)]


def test_text_keys_and_null_pages(spark):
    rows = [("u1", "<p>a</p>"), ("u2", None), ("u3", "")]
    pages = spark.createDataFrame(rows, "url string, body string")
    parsed = P.parse_pages(pages, key="url", html="body").orderBy("url").collect()
    assert [(r["url"], None if r["nodes"] is None else len(r["nodes"])) for r in parsed] == [
        ("u1", 2), ("u2", None), ("u3", 0),
    ]


def test_a_table_of_few_splits_is_dealt_out(spark, tmp_path):
    pages = spark.range(0, 400, 1, 1).select(F.col("id").alias("page_id"), F.lit("<p>").alias("html"))
    pages.write.parquet(f"{tmp_path}/one")
    pages.repartition(40).write.option("maxRecordsPerFile", 5).parquet(f"{tmp_path}/many")
    one, many = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("one", "many"))
    cores = spark.sparkContext.defaultParallelism
    assert P.parse_pages(one).rdd.getNumPartitions() == 1
    assert P.parse_pages(one, spread=True).rdd.getNumPartitions() == cores
    sizes = P.parse_pages(one, spread=True).rdd.glom().map(len).collect()
    assert min(sizes) > 0 and sum(sizes) == 400
    splits = many.rdd.getNumPartitions()
    assert splits >= cores
    read = P.parse_pages(many, spread=True)
    assert read.rdd.getNumPartitions() == splits
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()


def test_two_hundred_splits_stay(spark, tmp_path, conf):
    pages = spark.range(0, 400, 1, 200).select(F.col("id").alias("page_id"), F.lit("<p>").alias("html"))
    pages.write.parquet(str(tmp_path / "pages"))
    # Every file a split of its own.
    conf(spark__sql__files__openCostInBytes=str(128 << 20))
    read = P.parse_pages(spark.read.parquet(str(tmp_path / "pages")), spread=True)
    assert read.rdd.getNumPartitions() == 200
