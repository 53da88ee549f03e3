"""The main text of web pages, by the template that pages of a host share.

1. A page is read as a stream of tokens: its tags, each with the path above it, and its blocks of text.
2. Per host the tokens are grouped by their occurrence vectors, which page holds them how often.
   Pages without tags and text are no evidence, and pages that say the same count once. A vector is
   kept as a hash that adds up in any order, so these are two aggregates and no host is gathered in
   one place.
3. Tokens of one vector are an equivalence class. The classes of what most pages hold, and hold once,
   are the skeleton, the root of the template. Another class of at least ``LEAST_CLASS`` tokens on at
   least half of the host's pages is valid if it nests: the elements around its tokens are its own
   or of one other valid class, its parent. Template texts are those of the skeleton, and those of
   other valid classes whose element is of the same class. What half of the pages hold is at most
   twice an average page, so a host's classes are found in one task.
4. What is left are slots, the gaps between class tokens. The main slot is the deepest element of a
   valid class that holds half of the text that varies on its host, with the article it is in or that is
   in it. Where a page has no such element it is the article, and without one the body. Slots that are
   boilerplate by their element or its whole names (menus, headers, footers, sidebars, notices, adverts,
   forms, comments) are left out; a name that only has such a word in it says nothing.

Hosts of fewer than ``LEAST_PAGES`` pages show no template; there, only elements and names tell.

Per page the result is the texts of the blocks left, character references decoded, white space of a
block turned into single spaces, joined by single spaces. A null html is an empty page; a page that
breaks off, has unclosed or crossed tags or no article gives what was found. A null url is a host of
its own. Rows that repeat come back each and are evidence once; an empty table gives an empty result.
A very long page is read in time that grows with its length and is one value of its task. Columns other
than page_id, url and html, whatever their names, are not read.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.sources.shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_CLASS, LEAST_PAGES = 3, 8
# What so many of a host's pages hold once is of the skeleton.
MOST = 3, 4
# Characters of text that leave Python at once.
BATCH_CHARS = 4 << 20

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that end an open one of the same kind.
SELF_CLOSING = frozenset("li dt dd tr td th option".split())
# Elements and names that are never main text.
DROPPED = frozenset(
    "nav footer aside form button select input label fieldset dialog menu svg canvas object audio"
    " video map".split()
)
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored"
    " promo promotion banner sidebar menu nav"
    " navbar navigation breadcrumb breadcrumbs footer masthead comment comments reply replies"
    " disqus cookie cookies consent gdpr notice notices alert newsletter subscribe subscription"
    " signup share sharing social related recommended widget popup modal overlay login toolbar"
    " pagination pager".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar"
    " note".split()
)
OF_READERS = frozenset("comment comments reply replies disqus".split())
# Words that also name ordinary parts of an article, and words that may stand beside a name there.
OF_ARTICLES = frozenset("notice notices alert menu banner consent popup overlay".split())
BESIDE = frozenset(
    "box block container wrapper wrap area list links link buttons button bar section widgets icons"
    " icon top bottom left right inner outer item items unit slot form posts articles stories x".split()
)
SITE = frozenset("header site page top main global masthead".split()) | BESIDE
TITLED = frozenset("entry post article story content title".split())
MAIN = ("article", "main")

TOKEN = re.compile(
    r"<!--.*?(?:-->|(?P<open>\Z))"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|(?P<open2>\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
# What begins where no tag can end and is no text, or is text to the end.
TAIL = re.compile(r"<!--|<!\[CDATA\[|<[!?/]")
NAMED = re.compile(r"(?:\s|^)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Open:
    """An open element. ``path`` names it and all above it; ``drop``, ``main`` and ``in_slot`` say
    whether text below is left out, is in an article, is in the slot that was asked for."""

    __slots__ = ("tag", "path", "depth", "drop", "readers", "main", "in_slot", "block", "chars")

    def __init__(self, tag, path, depth, drop, readers, main, in_slot, block):
        self.tag, self.path, self.depth = tag, path, depth
        self.drop, self.readers, self.main, self.in_slot = drop, readers, main, in_slot
        # The nearest element, this one included, that is a block.
        self.block = self if tag in BLOCKS or block is None else block
        # Characters of text below that are not left out.
        self.chars = 0


class Block:
    __slots__ = ("path", "drop", "main", "in_slot", "text")

    def __init__(self, top: Open, text: str):
        self.path, self.drop, self.main, self.in_slot = top.path, top.drop, top.main, top.in_slot
        self.text = text


def name_parts(attrs: str) -> tuple[list[frozenset[str]], str, str]:
    """The words of each name in class and id, the class itself, and the role."""
    names, kind, role = [], "", ""
    for name, *values in NAMED.findall(attrs):
        value = entities.unescape("".join(values))
        if name.lower() == "role":
            role = value.strip().lower()
            continue
        if name.lower() == "class":
            kind = ".".join(value.split())
        for whole in value.split():
            names.append(frozenset(part.lower() for part in NAME_PART.findall(whole)))
    return names, kind, role


def furniture(names: list[frozenset[str]]) -> bool:
    """Whether a whole name, not a part of it, is one of ``NAMES``."""
    return any(
        words & NAMES - OF_ARTICLES
        and all(word in NAMES or word in BESIDE or word in SITE or word.isdigit() for word in words)
        for words in names
    )


def number(*parts: object) -> int:
    """A 64-bit hash of strings and numbers."""
    data = "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)


class PageReader:
    """Reads one page: its blocks, the numbers of its tag paths, and the text below each path.

    Everything an element hands down is a flag, and what it hands up is added when it closes, so a
    page takes time and memory in proportion to its length however deep it is nested.
    """

    def __init__(self, slot: int | None = None):
        self.slot = slot
        self.stack = [Open("", 0, 0, False, False, False, False, None)]
        self.open_tags: Counter = Counter()
        self.blocks: list[Block] = []
        self.paths: Counter = Counter()
        self.parents: dict[int, int] = {}
        self.below: dict[tuple[int, int], int] = {}
        self.pending: list[str] = []
        self.holder = self.stack[0]

    def read(self, page: str) -> PageReader:
        at, size = 0, len(page)
        # No tag ends after the last closing sign, so none is looked for there: a start that leads nowhere
        # would otherwise be followed to the end of the page each time.
        last = page.rfind(">") + 1
        while at < size:
            found = TOKEN.search(page, at, last)
            if found is None or found["open"] is not None or found["open2"] is not None:
                # From here on, or from an open comment or section on, there are no tags.
                begin = found.start() if found else at
                rest = TAIL.search(page, begin)
                self.add(entities.unescape(page[at : rest.start() if rest else size]))
                if rest and rest[0] == "<![CDATA[":
                    self.add(page[rest.end() :])
                break
            if found.start() > at:
                self.add(entities.unescape(page[at : found.start()]))
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if found["cdata"] is not None:
                self.add(found["cdata"])
            elif tag and (found["end"] or found["end2"]):
                self.end_tag(tag.lower())
            elif tag:
                tag, attrs = tag.lower(), found["attrs"] or found["attrs2"] or ""
                self.start_tag(tag, attrs)
                if tag in RAW and not attrs.endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                    at = close.end() if close else size
        self.flush()
        self.pop_to(1)
        return self

    def flush(self) -> None:
        if self.pending:
            text = " ".join("".join(self.pending).split())
            self.pending.clear()
            if text:
                self.blocks.append(Block(self.holder, text))

    def add(self, text: str) -> None:
        """Text of an inline element belongs to the block around it, unless it is left out."""
        top = self.stack[-1]
        if self.pending and self.holder.drop != top.drop:
            self.flush()
        if not self.pending:
            self.holder = top.block if top.block.drop == top.drop else top
        self.pending.append(text)
        if not top.drop:
            top.chars += len(text.strip())

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            closed = self.stack.pop()
            self.open_tags[closed.tag] -= 1
            self.stack[-1].chars += closed.chars
            if closed.chars:
                key = (closed.path, closed.depth)
                self.below[key] = self.below.get(key, 0) + closed.chars

    def close(self, tag: str) -> None:
        if self.open_tags[tag] > 0:
            at = len(self.stack) - 1
            while self.stack[at].tag != tag:
                at -= 1
            self.pop_to(at)

    def end_tag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.close(tag)

    def start_tag(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.add(" ")
        if tag in RAW:
            self.count(number(self.stack[-1].path, tag))
            return
        if tag in BLOCKS:
            self.flush()
            if tag != "head":
                self.close("head")
            if tag not in ("html", "body"):
                self.close("p")
        if tag in SELF_CLOSING and self.stack[-1].tag == tag:
            self.pop_to(len(self.stack) - 1)
        element = self.opened(tag, attrs)
        self.count(element.path)
        if tag not in VOID and not attrs.endswith("/"):
            self.stack.append(element)
            self.open_tags[tag] += 1

    def count(self, path: int) -> None:
        self.paths[path] += 1
        self.parents[path] = self.stack[-1].path

    def opened(self, tag: str, attrs: str) -> Open:
        parent = self.stack[-1]
        names, kind, role = name_parts(attrs) if attrs.strip() else ([], "", "")
        words = frozenset().union(*names)
        inside = parent.main or parent.in_slot
        path = number(parent.path, tag, kind)
        in_slot = parent.in_slot or path == self.slot
        readers, main = parent.readers or bool(words & OF_READERS), parent.main
        if tag in ("html", "body"):
            readers, drop = parent.readers, parent.drop
        elif tag in MAIN or role == "main":
            # A wrapper's name says nothing about the article inside, unless readers wrote it.
            named = tag == "article" and furniture(names)
            drop, main = readers or named or (parent.main and parent.drop), True
        else:
            # The head of an article has its title; the head of a page is a banner.
            title = any("header" in whole and whole & TITLED for whole in names)
            headed = any("header" in whole and whole <= SITE for whole in names)
            banner = not inside and ((tag == "header" and not title) or headed)
            drop = parent.drop or banner or tag in DROPPED or role in ROLES or furniture(names)
        return Open(tag, path, parent.depth + 1, drop, readers, main, in_slot, parent.block)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"
# Kinds of tokens: the page itself, a tag path, a text, a path with text below.
PAGE, TAG, TEXT, BELOW = range(4)
TOKENS = (
    "host bigint, kind int, token bigint, parent bigint, said bigint, count bigint, chars bigint,"
    " depth int"
)


def page_tokens(page: str | None) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """``(kind, token, parent, said, count, chars, depth)``, nothing for a page without tags and text.

    The parent is the path of the element around a token, 0 for none; what the page says in all is
    the page's name in a vector. Characters are those that are not left out.
    """
    found = PageReader().read(page or "")
    if not found.paths and not found.blocks:
        return
    said = number(*[block.text for block in found.blocks if not block.drop])
    yield PAGE, 0, 0, said, 1, found.stack[0].chars, 0
    for path, count in found.paths.items():
        yield TAG, path, found.parents[path], said, count, 0, 0
    texts = Counter((block.path, block.text, block.drop) for block in found.blocks)
    for (path, text, drop), count in texts.items():
        yield TEXT, number(path, text), path, said, count, 0 if drop else count * len(text), 0
    for (path, depth), chars in found.below.items():
        yield BELOW, path, 0, said, 0, chars, depth


def host_tokens(pages: DataFrame) -> DataFrame:
    """Columns ``TOKENS`` for ``pages (host, html)``."""
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.int32()]
    names = [field.split()[0] for field in TOKENS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.extend((host, *token) for token in page_tokens(page.as_py()))
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    return pages.select("host", "html").mapInArrow(read, TOKENS)


def template_of(pages: int, tokens: list[dict]) -> dict:
    """The template of one host from its tokens on at least half of its pages: ``classes``,
    ``texts``, ``parts`` and ``main``, see ``templates``."""
    members: dict[tuple[int, int], list[dict]] = {}
    paths: dict[int, dict] = {}
    for token in tokens:
        if token["kind"] != BELOW:
            token["class"] = (token["support"], token["vector"])
            members.setdefault(token["class"], []).append(token)
            if token["kind"] != TEXT:
                paths[token["token"]] = token

    def most(token: dict) -> bool:
        return token["most"] == 1 and MOST[1] * token["support"] >= MOST[0] * pages

    def in_skeleton(token: dict) -> bool:
        if token["kind"] != TEXT or token["support"] == pages:
            return True
        alike = members[token["class"]]
        around = paths.get(token["parent"])
        own_tags = len(alike) >= LEAST_CLASS and any(other["kind"] == TAG for other in alike)
        return own_tags or (around is not None and most(around))

    page = paths[0]
    skeleton = [
        token for alike in members.values() for token in alike if most(token) and in_skeleton(token)
    ]
    for token in skeleton:
        token["class"] = page["class"]
    valid = {page["class"]: skeleton}
    outer: dict[tuple[int, int], tuple[int, int]] = {}
    for name, alike in members.items():
        alike = [token for token in alike if token["class"] == name]
        if name in valid or len(alike) < LEAST_CLASS:
            continue
        around = {paths[t["parent"]]["class"] if t["parent"] in paths else None for t in alike}
        others = around - {name}
        if len(others) == 1 and None not in others:
            valid[name], (outer[name],) = alike, others
    # A class without a valid parent is none, nor are those in it.
    while lost := [name for name, around in outer.items() if around not in valid]:
        for name in lost:
            del valid[name], outer[name]

    root = skeleton if len(skeleton) >= LEAST_CLASS else []
    texts = [token for token in root if token["kind"] == TEXT]
    parts = [
        token
        for name in outer
        for token in valid[name]
        if token["kind"] == TEXT and paths[token["parent"]]["class"] == name
    ]
    # Text that varies below each path: all text but the template's.
    same: Counter = Counter()
    for token in texts + parts:
        at = token["parent"]
        while at in paths and at:
            same[at] += token["chars"]
            at = paths[at]["parent"]
        same[0] += token["chars"]
    whole = page["chars"] - same[0]
    slots = [
        (below["depth"], below["chars"] - same[below["token"]], below["token"])
        for below in tokens
        if below["kind"] == BELOW and paths.get(below["token"], {}).get("class") in valid
    ]
    slots = [slot for slot in slots if slot[1] > 0 and 2 * slot[1] >= whole]
    return {
        "classes": [
            {"class": number(*name), "parent": number(*outer[name]) if name in outer else None,
             "size": len(alike)}
            for name, alike in valid.items()
        ],
        "texts": [token["token"] for token in texts],
        "parts": [token["token"] for token in parts],
        "main": max(slots)[2] if slots else None,
    }


TEMPLATE = (
    "host bigint, pages bigint, classes array<struct<class: bigint, parent: bigint, size: bigint>>,"
    " texts array<bigint>, parts array<bigint>, main bigint"
)


def templates(tokens: DataFrame) -> DataFrame:
    """``(host, pages, classes, texts, parts, main)`` per host with enough pages.

    ``pages`` counts what says something of its own; ``classes`` are the valid classes ``(class,
    parent, size)``, the parent null at the root; ``texts`` the texts of the skeleton, ``parts``
    those of the other classes; ``main`` the path of the main slot, null if there is none.
    """
    once = tokens.groupBy("host", "kind", "token", "said").agg(
        F.max("count").alias("count"), F.max("parent").alias("parent"),
        F.max("chars").alias("chars"), F.max("depth").alias("depth"),
    )
    counted = once.groupBy("host", "kind", "token").agg(
        F.count("*").alias("support"),
        F.bit_xor(F.xxhash64("said", "count")).alias("vector"),
        F.max("count").alias("most"),
        F.max("parent").alias("parent"),
        F.sum("chars").alias("chars"),
        F.max("depth").alias("depth"),
    )
    stats = written(counted.where("support > 1 OR kind = 0"), "tokens")
    hosts = stats.where(F.col("kind") == PAGE).select("host", F.col("support").alias("pages"))
    hosts = hosts.where(F.col("pages") >= LEAST_PAGES)
    common = stats.join(hosts, "host").where(2 * F.col("support") >= F.col("pages"))
    kinds = pa.schema(
        [
            ("host", pa.int64()), ("pages", pa.int64()),
            ("classes", pa.list_(pa.struct([(c, pa.int64()) for c in ("class", "parent", "size")]))),
            ("texts", pa.list_(pa.int64())), ("parts", pa.list_(pa.int64())), ("main", pa.int64()),
        ]
    )

    def of_host(rows: pa.Table) -> pa.Table:
        tokens = rows.to_pylist()
        host, pages = tokens[0]["host"], tokens[0]["pages"]
        found = {"host": host, "pages": pages} | template_of(pages, tokens)
        return pa.Table.from_pylist([found], kinds)

    return common.groupBy("host").applyInArrow(of_host, TEMPLATE)


def main_text(page: str | None, main: int | None, texts: frozenset[int]) -> str:
    """The text of the main slot, without template texts.

    The host's template decides where the slot is. An article that shares text with it is it, with its
    title; articles elsewhere are teasers. Without a template, or on a page that does not have its slot,
    the article is the slot, and without one the page.
    """
    free = [block for block in PageReader(main).read(page or "").blocks if not block.drop]
    articles = [block for block in free if block.main]
    slot = [block for block in free if block.in_slot]
    chosen = articles or free
    if slot and not any(block.main for block in slot):
        chosen = slot
    if texts:
        chosen = [block for block in chosen if number(block.path, block.text) not in texts]
    return " ".join(block.text for block in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per row of ``pages``."""
    host = F.lower(F.regexp_extract("url", HOST, 1))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.xxhash64(host).alias("host"),
    )
    known = written(templates(host_tokens(rows)), "templates")
    # As a written table its size is known: Spark broadcasts it while small, and splits a host with
    # many pages otherwise.
    known_texts = F.concat("texts", "parts").alias("texts")
    joined = rows.join(known.select("host", "main", known_texts), "host", "left").select(
        "page_id", "url", "html", "main", "texts"
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, found = 0, 0, []
            for at, (page, main, texts) in enumerate(
                zip(batch.column(2), batch.column(3), batch.column(4))
            ):
                of_template = frozenset(texts.as_py() or ())
                found.append(main_text(page.as_py(), main.as_py(), of_template))
                held += len(found[-1])
                if held > BATCH_CHARS:
                    yield of(batch, start, found)
                    start, held, found = at + 1, 0, []
            yield of(batch, start, found)

    def of(batch: pa.RecordBatch, start: int, found: list[str]) -> pa.RecordBatch:
        part = slice(start, start + len(found))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0)[part], batch.column(1)[part], pa.array(found, pa.string()),
                pa.array([len(text) for text in found], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    return joined.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
