"""HTML text to node records, for use inside tasks.

Scanning rules, those of tolerant HTML readers: a tag needs its closing sign; markup that never gets one
is text up to the next sign that may begin markup. Comments end at ``-->``, declarations at ``>``, marked
sections at their brackets; ``script`` and ``style`` hold text up to their end tag, and without one
nothing. A marked section of an unknown kind ends the page with an error.

Every page is read in one pass, in time that grows with its length whatever it holds: what has been
looked for in vain is remembered, so a closing sign that is not ahead is searched for once, and a start tag
stops where an earlier one has been found to lead nowhere.

Tree rules: a void element closes at once; an end tag closes everything up to the nearest open
element of its name, and is ignored when none is open; nothing else is closed implicitly.
"""

from __future__ import annotations

import re
from html import unescape

# Elements without content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link"
    " menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose strings are not part of the text around them.
APART_TAGS = frozenset("rp rt script style template".split())
# Elements in which blank strings are kept as they are.
PRE_TAGS = frozenset("pre textarea".split())
# Elements that hold text only, and the ends of that text.
RAW_ENDS = {tag: re.compile(rf"</\s*{tag}\s*>", re.I | re.A) for tag in ("script", "style")}
# The usual start tag: attributes in double quotes and without character references.
ATTRIBUTE = r'([a-zA-Z][a-zA-Z0-9-]*)="([^"&<>]*)"'
PLAIN_TAG = re.compile(
    rf"<([a-zA-Z][a-zA-Z0-9]*)((?:\s+{ATTRIBUTE.replace('(', '(?:')})*)\s*>", re.ASCII
)
PLAIN_ATTRIBUTE = re.compile(ATTRIBUTE)
# What may stand where markup is not that plain.
NAME_STOP = re.compile(r"[\t\n\r\f />\x00]")
BETWEEN = re.compile(r"(?:\s|/(?!>))*")
ANY_ATTRIBUTE = re.compile(
    r"""(?<=['"\s/])([^\s/>][^\s/=>]*)(\s*=+\s*('[^']*'|"[^"]*"|(?!['"])[^>\s]*))?(?:\s|/(?!>))*"""
)
END_TAG = re.compile(r"</\s*([a-zA-Z][-.a-zA-Z0-9:_]*)\s*>")
COMMENT_END = re.compile(r"--\s*>")
SECTION_NAME = re.compile(r"([a-zA-Z][-_.a-zA-Z0-9]*)\s*")
# The kinds of marked sections and what ends them.
SECTION_ENDS = dict.fromkeys(("temp", "cdata", "ignore", "include", "rcdata"), re.compile(r"]\s*]\s*>"))
SECTION_ENDS |= dict.fromkeys(("if", "else", "endif"), re.compile(r"]\s*>"))
# The tag of a text node.
TEXT = "#text"
ERROR_CHARS = 200


class Node:
    """An element or a text node; ``below`` counts the kept nodes among its descendants.

    Nodes are in document order, so its descendants are the ``below`` nodes that follow it. Its text
    is ``count`` strings from ``start`` on in the page's strings of its ``kind``: nested elements
    share strings, so a page takes memory in proportion to its length however deep it is nested.
    """

    __slots__ = ("pos", "parent_pos", "below", "tag", "attrs", "kind", "start", "count")

    def __init__(self, pos, parent_pos, tag, attrs, kind, start):
        self.pos = pos
        self.parent_pos = parent_pos
        self.below = 0
        self.tag = tag
        self.attrs = attrs
        self.kind = kind
        self.start = start
        self.count = 0


class Scanner:
    """Finds tags, text, comments and declarations in one pass and calls the ``on_`` methods."""

    def scan(self, html: str) -> None:
        self.html, self.size = html, len(html)
        self.last_close = html.rfind(">")
        # The one sign before which a start tag may stop without any closing sign ahead.
        self.has_null = "\x00" in html
        # Patterns that do not occur from here on.
        self.missing: set[re.Pattern] = set()
        # Places before an attribute from which a start tag comes to no end.
        self.dead: set[int] = set()
        # From name_from to name_end there is nothing that ends a name.
        self.name_from = self.name_end = -1
        self.raw: str | None = None
        at = 0
        while at < self.size:
            if self.raw:
                end = RAW_ENDS[self.raw].search(html, at)
                if end is None:
                    return
                self.on_data(html[at : end.start()])
                self.on_end(self.raw)
                self.raw, at = None, end.end()
                continue
            sign = html.find("<", at)
            if sign < 0:
                self.on_data(unescape(html[at:]))
                return
            if sign > at:
                self.on_data(unescape(html[at:sign]))
            at = self._markup(sign)

    def _markup(self, at: int) -> int:
        """Reads what begins with the ``<`` at ``at`` and returns where it ends."""
        html, sign = self.html, self.html[at + 1 : at + 2]
        if sign.isascii() and sign.isalpha():
            return self._start_tag(at)
        if sign not in ("/", "!", "?"):
            self.on_data("<")
            return at + 1
        if html.startswith("<![", at):
            return self._section(at)
        if self.last_close <= at:
            return self._no_markup(at)
        if sign == "/":
            return self._end_tag(at)
        if html.startswith("<!--", at):
            end = self._find(COMMENT_END, at + 4)
            if end is None:
                return self._no_markup(at)
            self.on_apart()
            return end.end()
        # A declaration or an instruction.
        self.on_apart()
        return html.index(">", at + 2) + 1

    def _no_markup(self, at: int) -> int:
        """Text up to the next closing sign, or else up to the next sign that may begin markup."""
        if self.last_close > at:
            end = self.html.index(">", at + 1) + 1
        else:
            end = self.html.find("<", at + 1)
            end = at + 1 if end < 0 else end
        self.on_data(unescape(self.html[at:end]))
        return end

    def _find(self, pattern: re.Pattern, at: int) -> re.Match | None:
        found = None if pattern in self.missing else pattern.search(self.html, at)
        if found is None:
            self.missing.add(pattern)
        return found

    def _start_tag(self, at: int) -> int:
        html = self.html
        if self.last_close < at and not self.has_null:
            return self._no_markup(at)
        plain = PLAIN_TAG.match(html, at)
        if plain:
            tag = plain[1].lower()
            found = PLAIN_ATTRIBUTE.findall(plain[2])
            self.on_start(tag, [(name.lower(), value) for name, value in found])
            self.raw = tag if tag in RAW_ENDS else None
            return plain.end()
        if not self.name_from <= at + 1 < self.name_end:
            stop = NAME_STOP.search(html, at + 1)
            self.name_from, self.name_end = at + 1, stop.start() if stop else self.size
        name_end = self.name_end
        place = BETWEEN.match(html, name_end).end()
        passed, found = [], []
        while place not in self.dead:
            attribute = ANY_ATTRIBUTE.match(html, place)
            if attribute is None:
                break
            passed.append(place)
            found.append(attribute)
            place = attribute.end()
        sign = html[place : place + 1]
        closes = sign == ">" or html.startswith("/>", place)
        if place in self.dead or sign == "" or (not closes and (sign in "=/" or _is_letter(sign))):
            self.dead.update(passed)
            self.dead.add(place)
            return self._no_markup(at)
        if not closes:
            # A sign that no tag can hold: all before it is text.
            self.on_data(html[at:place])
            return place
        tag = html[at + 1 : name_end].lower()
        self.on_start(tag, [_attribute(one) for one in found])
        if sign == "/":
            self.on_end(tag)
            return place + 2
        self.raw = tag if tag in RAW_ENDS else None
        return place + 1

    def _end_tag(self, at: int) -> int:
        html = self.html
        plain = END_TAG.match(html, at)
        if plain:
            self.on_end(plain[1].lower())
            return plain.end()
        close = html.index(">", at + 2)
        if _is_letter(html[at + 2 : at + 3]):
            self.on_end(html[at + 2 : NAME_STOP.search(html, at + 2).start()].lower())
        elif close > at + 2:
            self.on_apart()
        return close + 1

    def _section(self, at: int) -> int:
        name = SECTION_NAME.match(self.html, at + 3)
        if at + 3 == self.size or (name and name.end() == self.size):
            return self._no_markup(at)
        if name is None:
            raise AssertionError(f"expected name token at {self.html[at : at + 20]!r}")
        if name[1].lower() not in SECTION_ENDS:
            raise AssertionError(f"unknown status keyword {name[0]!r} in marked section")
        end = self._find(SECTION_ENDS[name[1].lower()], at + 3)
        if end is None:
            return self._no_markup(at)
        self.on_section(self.html[at + 3 : end.start()])
        return end.end()


def _is_letter(sign: str) -> bool:
    return sign.isascii() and sign.isalpha()


def _attribute(found: re.Match) -> tuple[str, str | None]:
    name, rest, value = found.groups()
    if not rest:
        return name.lower(), None
    return name.lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value)


class PageReader(Scanner):
    """Collects the nodes of one page in document order."""

    def __init__(self, tags: frozenset[str] | None, with_text: bool):
        self.wanted = tags
        self.with_text = with_text
        self.nodes: list[Node] = []
        self.open: list[Node] = []
        self.open_count: dict[str, int] = {}
        self.apart: list[str] = []
        # By kind: the strings of the page itself ("") and of elements that stand apart.
        self.strings: dict[str, list[str]] = {"": []}
        self.pending: list[str] = []
        self.next_pos = 0

    def read(self, html: str) -> str | None:
        """Reads the page; what the scanner rejects ends it, and the reason is returned."""
        error = None
        try:
            self.scan(html)
        except (AssertionError, ValueError) as rejected:
            # A marked section it cannot read, or a character reference of thousands of digits.
            error = str(rejected)[:ERROR_CHARS] or type(rejected).__name__
        self._end_string()
        while self.open:
            self._close_last()
        return error

    def drop_other_strings(self) -> None:
        """Keep only strings that are part of a kept node's text."""
        for kind, strings in self.strings.items():
            steps = [0] * (len(strings) + 1)
            own = [node for node in self.nodes if node.kind == kind and node.count]
            for node in own:
                steps[node.start] += 1
                steps[node.start + node.count] -= 1
            kept, moved, depth = [], [], 0
            for string, step in zip(strings, steps):
                depth += step
                moved.append(len(kept))
                if depth:
                    kept.append(string)
            for node in own:
                node.start = moved[node.start]
            self.strings[kind] = kept

    def _keeps(self, tag: str) -> bool:
        return self.wanted is None or tag in self.wanted

    def _add(self, tag, attrs, kind) -> Node:
        parent = self.open[-1].pos if self.open else None
        node = Node(self.next_pos, parent, tag, attrs or {}, kind, len(self.strings.get(kind, ())))
        self.next_pos += 1
        if self._keeps(tag):
            self.nodes.append(node)
        # Until the element closes: the number of nodes up to and including itself.
        node.below = len(self.nodes)
        return node

    def _end_string(self) -> None:
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending = []
        if not text.strip(" \t\n\r\f") and not any(self.open_count.get(t) for t in PRE_TAGS):
            text = "\n" if "\n" in text else " "
        kind = self.apart[-1] if self.apart else ""
        node = self._add(TEXT, None, kind)
        node.below = 0
        if self.with_text:
            node.count = 1
            self.strings.setdefault(kind, []).append(text)

    def _close_last(self) -> None:
        node = self.open.pop()
        tag = node.tag
        self.open_count[tag] -= 1
        if tag in APART_TAGS:
            self.apart.pop()
        node.below = len(self.nodes) - node.below
        node.count = len(self.strings.get(node.kind, ())) - node.start

    def on_start(self, tag, attrs):
        self._end_string()
        values = None
        if attrs and self._keeps(tag):
            values = {name: "" if value is None else value for name, value in attrs}
        kind = tag if tag in APART_TAGS else ""
        node = self._add(tag, values, kind)
        self.open.append(node)
        self.open_count[tag] = self.open_count.get(tag, 0) + 1
        if kind:
            self.apart.append(tag)
        if tag in VOID_TAGS:
            self._close_last()

    def on_end(self, tag):
        self._end_string()
        if not self.open_count.get(tag):
            return
        while self.open[-1].tag != tag:
            self._close_last()
        self._close_last()

    def on_data(self, data):
        if data:
            self.pending.append(data)

    def on_apart(self):
        """Comments, declarations and instructions end a string."""
        self._end_string()

    def on_section(self, data):
        self._end_string()
        if data.startswith("CDATA["):
            self.pending.append(data[len("CDATA[") :])
            self._end_string()


def read_page(html: str, tags: frozenset[str] | None, with_text: bool) -> tuple:
    """``(nodes, strings by kind, error)`` of a page; what was read before an error stays."""
    reader = PageReader(tags, with_text)
    error = reader.read(html)
    if not with_text:
        return reader.nodes, {}, error
    if tags is not None:
        reader.drop_other_strings()
    return reader.nodes, reader.strings, error
