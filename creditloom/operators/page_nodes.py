"""Web pages as rows: one row per page with its nodes as an array, or one row per node.

Finding things within a page is a narrow operation on the array, so it needs no shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import html as html_reader
from creditloom.functions.html import TEXT, read_page

# ``place`` is the node's index in the array.
NODES = (
    "array<struct<place:int,pos:int,parent_pos:int,below:int,tag:string,"
    "attrs:map<string,string>,kind:string,start:int,count:int>>"
)
STRINGS = "map<string,array<string>>"
# A record batch is sent once its markup reaches this size, however few pages that is.
BATCH_CHARS = 8 << 20

# Attributes that hold a list of names.
LIST_ATTRS = ("accesskey", "class", "dropzone")

# The reader travels with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(html_reader)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parse_pages(
    pages: DataFrame,
    key: str = "page_id",
    html: str = "html",
    tags: Collection[str] | None = None,
    with_text: bool = True,
    spread: bool = False,
) -> DataFrame:
    """``(key, nodes, strings, error)``, one row per page, nodes in document order.

    ``strings`` are the page's texts, of which ``node_text`` makes that of a node. ``tags`` names
    the tags to keep (``TEXT`` for text nodes) and ``with_text=False`` leaves the texts out: both keep
    what no later step reads out of the transfer from Python. A page that the tokenizer rejects
    keeps the nodes before that place and has an ``error``; a null page has null nodes. ``key`` need
    not be unique. ``spread`` is for a scan of a table, see ``for_all_cores``.
    """
    wanted = None if tags is None else frozenset(tags)
    source = pages.select(key, html)
    if spread:
        source = for_all_cores(source)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = chars = 0
            found: list = []
            for at, text in enumerate(batch.column(1)):
                markup = text.as_py()
                found.append(read_page(markup, wanted, with_text) if markup is not None else None)
                chars += len(markup or "")
                if chars >= BATCH_CHARS:
                    yield _to_batch(key, batch.column(0)[start : at + 1], found)
                    start, chars, found = at + 1, 0, []
            if found:
                yield _to_batch(key, batch.column(0)[start:], found)

    key_type = source.schema[key].dataType.simpleString()
    return source.mapInArrow(
        parse, f"`{key}` {key_type}, nodes {NODES}, strings {STRINGS}, error string"
    )


def for_all_cores(scan: DataFrame) -> DataFrame:
    """``scan`` with a split for every core at least.

    A table whose files make that many splits is read as it is, and no page moves. Only one of fewer
    splits, which is no more than a split's bytes a core, is dealt out: reading pages is work for many
    cores, and a small file is one split. ``scan`` is a plain scan of files, so that counting its splits
    runs no job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan if splits >= cores else scan.repartition(cores)


def _to_batch(key: str, keys: pa.Array, found: list) -> pa.RecordBatch:
    nodes, places, ends = [], [], [0]
    for page in found:
        if page is not None:
            nodes.extend(page[0])
            places.extend(range(len(page[0])))
        ends.append(len(nodes))
    attr_ends, names, values = [0], [], []
    for node in nodes:
        names.extend(node.attrs.keys())
        values.extend(node.attrs.values())
        attr_ends.append(len(names))
    attrs = pa.MapArray.from_arrays(
        pa.array(attr_ends, pa.int32()), pa.array(names, pa.string()), pa.array(values, pa.string())
    )
    columns = {
        "place": pa.array(places, pa.int32()),
        "pos": pa.array([n.pos for n in nodes], pa.int32()),
        "parent_pos": pa.array([n.parent_pos for n in nodes], pa.int32()),
        "below": pa.array([n.below for n in nodes], pa.int32()),
        "tag": pa.array([n.tag for n in nodes], pa.string()),
        "attrs": attrs,
        "kind": pa.array([n.kind for n in nodes], pa.string()),
        "start": pa.array([n.start for n in nodes], pa.int32()),
        "count": pa.array([n.count for n in nodes], pa.int32()),
    }
    lists = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()),
        pa.StructArray.from_arrays(list(columns.values()), list(columns)),
        mask=pa.array([page is None for page in found]),
    )
    strings = pa.array(
        [None if page is None else list(page[1].items()) for page in found],
        pa.map_(pa.string(), pa.list_(pa.string())),
    )
    errors = pa.array([page and page[2] for page in found], pa.string())
    return pa.RecordBatch.from_arrays(
        [keys, lists, strings, errors], [key, "nodes", "strings", "error"]
    )


def node_rows(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per node: ``(key, pos, parent_pos, below, tag, attrs, text)``."""
    rows = parsed.select(key, "strings", F.explode("nodes").alias("node"))
    fields = [F.col(f"node.{name}") for name in ("pos", "parent_pos", "below", "tag", "attrs")]
    return rows.select(key, *fields, node_text(F.col("node")).alias("text"))


def node_text(node: Column, strings: str = "strings") -> Column:
    """The text of a node, a column of a frame with the page's ``strings``; null without texts."""
    own = F.try_element_at(F.col(strings), node["kind"])
    # A kind without any string has no entry.
    empty = F.when(node.isNotNull() & (F.size(strings) > 0), "")
    return F.coalesce(F.array_join(F.slice(own, node["start"] + 1, node["count"]), ""), empty)


def stripped(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def where(
    tag: str | None = None,
    attrs: Mapping[str, str] | None = None,
    string: str | None = None,
    contains: str | None = None,
) -> Callable[[Column], Column]:
    """A condition on one node (a struct column) of a frame with the page's ``strings``.

    ``string`` asks for a text node with exactly this text, ``contains`` for any node whose text
    contains it. Without ``string`` and without ``tag`` every element matches.
    """

    def matches(node: Column) -> Column:
        if string is not None:
            found = (node["tag"] == TEXT) & (node_text(node) == string)
        elif tag is not None:
            found = node["tag"] == tag
        else:
            found = node["tag"] != TEXT
        for name, value in (attrs or {}).items():
            found = found & _attr_equals(node["attrs"][name], name, value)
        if contains is not None:
            found = found & node_text(node).contains(contains)
        return found

    return matches


def _attr_equals(actual: Column, name: str, value: str) -> Column:
    if name not in LIST_ATTRS:
        return actual == value
    names = F.split(F.trim(F.regexp_replace(actual, r"\s+", " ")), " ")
    return F.array_contains(names, value) | (F.array_join(names, " ") == value)


def all_nodes(nodes: Column | str, matches: Callable[[Column], Column]) -> Column:
    return F.filter(nodes, matches)


def first_node(nodes: Column | str, matches: Callable[[Column], Column]) -> Column:
    """The first matching node of a page, null when there is none."""
    return F.get(F.filter(nodes, matches), 0)


def below(nodes: Column | str, node: Column) -> Column:
    """The nodes inside a node, null for a null node.

    They are the ``below`` entries after it, so a search in them reads only that slice, and searches
    can be nested: the cells of the rows of a table.
    """
    nodes = F.col(nodes) if isinstance(nodes, str) else nodes
    return F.slice(nodes, node["place"] + 2, node["below"])


def all_inside(
    nodes: Column | str, outer: Callable[[Column], Column], inner: Callable[[Column], Column]
) -> Column:
    """All ``inner`` nodes inside the first ``outer`` node of a page; null when there is none."""
    return F.filter(below(nodes, first_node(nodes, outer)), inner)


def first_inside(
    nodes: Column | str,
    outer: Callable[[Column], Column],
    inner: Callable[[Column], Column],
    among: Column | None = None,
) -> Column:
    """For every ``outer`` node of a page a ``(node, found)``, the first ``inner`` node inside it.

    ``found`` is null when there is none. ``among`` looks for outer nodes in a part of the page
    only, such as ``all_inside``.
    """
    outer_nodes = F.filter(nodes if among is None else among, outer)

    def search(node: Column) -> Column:
        found = first_node(below(nodes, node), inner)
        return F.struct(node.alias("node"), found.alias("found"))

    return F.transform(outer_nodes, search)
