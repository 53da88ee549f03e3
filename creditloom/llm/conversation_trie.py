"""The prefix trie of conversations, by union-find over the LCP edges of sorted neighbours.

1. A turn becomes ``ENTRY`` bytes: a digest of its role and text and the words of its text. A conversation
   is the string of its entries, its path; paths sort like the sequences they stand for, a prefix first.
   Equal conversations are one path with a count. Their ids are joined in runs of at most 4,096, and the
   runs are digested in order as a stream, so no task holds the ids of a group.
2. Paths are range partitioned and sorted. A partition is read in blocks of bounded size. Neighbours in a
   block share an edge whose depth is the length of their longest common prefix. For depths from the
   deepest to 0 the edges of that depth unite their components; what a component is after that step is a
   node, and where several were united, a branching node. A node adds up its members, its childless nodes
   and saved tokens from the components of the step before.
3. Nodes that hold neither the first nor the last path of their block are complete. Those that do may
   reach over its boundary: a block's forest is contracted to these two paths, with what hangs on each
   of their depths. The contracted paths of all blocks, two a block, are sorted and go through the
   same step, until one block holds them all and every node is complete. At least ``LEAST_PATHS`` paths
   make a block, so each level is a small part of the one before.
4. Going back, every open node has learned its smallest member at the level where it was completed, and
   its children get it as their parent.

Every level is one shuffle of paths and is written, so a lost task finds the same blocks again. The whole
of the turns moves twice: to order each conversation, and by path, as 20 bytes a turn.

A null role or text is empty, a null turn comes first, turns of one number are ordered by role and text.
Rows that repeat are turns of their own. Rows without a conversation id belong to no conversation and are
left out. A conversation of no turns is a member of the root; without conversations there are no nodes.
A conversation's entries are one value and have to fit into a task; very long texts go into their entry
and no further. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.sources.shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of an entry: 16 of the digest of role and text, 4 of the number of words.
ENTRY = 20
WORD = r"[^\x20\x09-\x0D]+"
# A block ends at so many paths, or at so many entries if it has LEAST_PATHS by then.
BLOCK_PATHS, BLOCK_ENTRIES, LEAST_PATHS = 1 << 16, 1 << 20, 64
# Bits of a conversation id within a run of ids.
RUN_BITS = 12
NO_ENDS = hashlib.sha256(b"").hexdigest()
NO_ID = np.iinfo(np.int64).max

# Per path, an entry of each list for each depth: what hangs on the node there and is no part of
# another path. ``row`` tells the path from others of its level.
PATHS = (
    "row bigint, path binary, n array<bigint>, first array<bigint>, kids array<bigint>,"
    " leaves array<bigint>, saved array<bigint>, ends array<string>"
)
LISTS = ("n", "first", "kids", "leaves", "saved")
NAMES = ("row", "path", *LISTS, "ends")
# What a block yields: complete nodes ("node"), contracted paths ("path"), and for every depth of a path
# that went in the node it is part of ("place").
FOUND = (
    "kind string, level int, conv_id bigint, depth bigint, parent_conv_id bigint,"
    " parent_row bigint, parent_depth bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    f" saved_tokens bigint, ends_sha256 string, from_row bigint, from_depth bigint, {PATHS}"
)
NODE = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, entries)``: the entries of each conversation's turns."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(WORD))), 8, "0")
    # The role's length keeps apart what ends the role and what begins the text.
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    entry = F.unhex(F.concat(digest, words)).alias("entry")
    placed = rows.withColumn("place", F.row_number().over(order)).select("conv_id", "place", entry)
    listed = F.array_sort(F.collect_list(F.struct("place", "entry")))
    return placed.groupBy("conv_id").agg(F.transform(listed, lambda t: t["entry"]).alias("entries"))


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """``(conv_id, path)``: every conversation with the opening of its group's first one.

    The opening of c are the first h turns of conversation c - c % ``group``, in place of its own first
    h, where h = crc32(c) % (``most`` + 1).
    """
    own = written(turns_in_order(conversations), "turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    openings = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("entries", 1, most).alias("opening")
    )
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    met = own.select("conv_id", base, h.alias("h"), "entries").join(openings, "base", "left")
    none = F.array().cast("array<binary>")
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    rest = F.slice("entries", F.col("h") + 1, F.greatest(F.size("entries") - F.col("h"), F.lit(0)))
    joined = F.array_join(F.transform(F.concat(opening, rest), F.hex), "")
    return met.select("conv_id", F.unhex(joined).alias("path"))


def classes(paths: DataFrame) -> DataFrame:
    """``(path, n, first, ends)`` per distinct path: how many, the smallest id, the digest of all ids."""
    run = F.shiftright("conv_id", RUN_BITS).alias("run")
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids")
    runs = paths.groupBy("path", run).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), ids
    )
    ordered = runs.repartition("path").sortWithinPartitions("path", "run")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = total = smallest = state = None
        for batch in batches:
            done = []
            columns = [batch.column(name).to_pylist() for name in ("path", "n", "first", "ids")]
            for key, n, first, listed in zip(*columns):
                if state is not None and key == path:
                    state.update(b"," + listed.encode())
                    total += n
                    continue
                if state is not None:
                    done.append((path, total, smallest, state.hexdigest()))
                path, total, smallest, state = key, n, first, hashlib.sha256(listed.encode())
            yield rows_of(done)
        if state is not None:
            yield rows_of([(path, total, smallest, state.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        kinds = {"path": pa.binary(), "n": pa.int64(), "first": pa.int64(), "ends": pa.string()}
        columns = zip(*done) if done else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds.values())], list(kinds)
        )

    return ordered.mapInArrow(digest, "path binary, n bigint, first bigint, ends string")


class Block:
    """Sorted distinct paths with what hangs on them, as flat arrays: a value per path and depth."""

    def __init__(self, table: pa.Table, level: int):
        self.size = table.num_rows
        self.path = table["path"].to_pylist()
        self.length = np.array([len(path) // ENTRY for path in self.path], np.int64)
        # Depths 0 to its length.
        self.start = np.concatenate([[0], np.cumsum(self.length + 1)])
        if level:
            self.row = table["row"].to_numpy()
            lists = {name: table[name].combine_chunks().flatten() for name in (*LISTS, "ends")}
            self.ends = np.array(lists.pop("ends").to_pylist(), object)
            self.hangs = {name: values.to_numpy().copy() for name, values in lists.items()}
        else:
            # All of a class hangs on the end of its path.
            end, n = self.start[1:] - 1, int(self.start[-1])
            self.hangs = {name: np.zeros(n, np.int64) for name in LISTS}
            self.hangs["first"][:] = NO_ID
            self.hangs["n"][end] = table["n"].to_numpy()
            self.hangs["first"][end] = table["first"].to_numpy()
            self.ends = np.full(n, None, object)
            self.ends[end] = table["ends"].to_pylist()
        entries = np.frombuffer(b"".join(self.path), np.uint8).reshape(-1, ENTRY)
        self.words = entries[:, 16:].copy().view(">u4").ravel().astype(np.int64)
        _, self.name = np.unique(
            np.ascontiguousarray(entries).view(f"V{ENTRY}").ravel(), return_inverse=True
        )
        self.entry_start = np.concatenate([[0], np.cumsum(self.length)])

    def common(self) -> np.ndarray:
        """The longest common prefix of each path and the one before it; -1 for the first path."""
        shared = np.zeros(self.size, np.int64)
        shared[0] = -1
        rows, depth = np.arange(1, self.size), 0
        while len(rows):
            rows = rows[np.minimum(self.length[rows], self.length[rows - 1]) > depth]
            here, before = self.entry_start[rows] + depth, self.entry_start[rows - 1] + depth
            rows = rows[self.name[here] == self.name[before]]
            depth += 1
            shared[rows] = depth
        return shared


def found_root(root: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The representatives of ``rows``; the ways there become short."""
    while True:
        at = root[rows]
        onward = root[at]
        if (onward == at).all():
            return at
        root[rows] = onward


def forest(table: pa.Table, level: int, number: int, last: bool) -> Iterator[dict[str, list]]:
    """Yield columns of ``FOUND`` for a block; ``last`` if no node can reach beyond it."""
    block = Block(table, level)
    shared = block.common()
    root = np.arange(block.size)
    deepest = int(block.length.max())
    by_depth = np.argsort(shared, kind="stable")
    bounds = np.searchsorted(shared[by_depth], np.arange(deepest + 2))
    by_length = np.argsort(block.length, kind="stable")
    shorter = np.searchsorted(block.length[by_length], np.arange(deepest + 1))
    # Contracted: the first path and the last one; one if they are the same.
    kept = [] if last else sorted({0, block.size - 1})
    chains = {row: {name: np.zeros(block.length[row] + 1, np.int64) for name in LISTS} for row in kept}
    chain_ends = {row: [None] * int(block.length[row] + 1) for row in kept}
    for chain in chains.values():
        chain["first"][:] = NO_ID
    new_row = {row: (number << 1) | side for side, row in enumerate(kept)}
    below: dict[str, np.ndarray] | None = None
    for depth in range(deepest, -1, -1):
        edges = by_depth[bounds[depth] : bounds[depth + 1]]
        # All edges of this depth at once: a run of neighbours points one step back, and following
        # the pointers doubles the way each time.
        root[edges] = edges - 1
        found_root(root, edges)
        rows = np.sort(by_length[shorter[depth] :])
        heads = found_root(root, rows)
        starts = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
        head = heads[starts]
        at = block.start[rows] + depth
        sums = {
            name: (np.minimum if name == "first" else np.add).reduceat(block.hangs[name][at], starts)
            for name in LISTS
        }
        ends = np.full(len(head), None, object)
        texts = block.ends[at]
        has = np.flatnonzero(texts != None)  # noqa: E711
        ends[np.searchsorted(starts, has, side="right") - 1] = texts[has]
        open_row = np.full(len(head), -1)
        for row in reversed(kept):
            if block.length[row] >= depth:
                open_row[np.searchsorted(head, found_root(root, np.array([row]))[0])] = row
        if below is not None and len(below["head"]):
            parent = np.searchsorted(head, found_root(root, below["head"]))
            np.add.at(sums["kids"], parent, (below["open"] < 0).astype(np.int64))
            done = below["open"] < 0
            for name in ("n", "leaves", "saved"):
                np.add.at(sums[name], parent[done], below[name][done])
            np.minimum.at(sums["first"], parent[done], below["first"][done])
        is_open = open_row >= 0
        leaves = sums["leaves"] + (~is_open & (sums["kids"] == 0))
        saved = sums["saved"].copy()
        if depth:
            own = block.words[block.entry_start[head] + depth - 1] * (sums["n"] - 1)
            saved += np.where(is_open, 0, own)
        if below is not None and len(below["head"]):
            yield nodes_of(below, depth + 1, level, parent, sums["first"], open_row, new_row)
        for at_row in np.flatnonzero(is_open):
            row = int(open_row[at_row])
            for name in LISTS:
                chains[row][name][depth] = sums[name][at_row]
            chain_ends[row][depth] = ends[at_row]
        if level:
            node = np.searchsorted(head, heads)
            yield places_of(block, rows, depth, node, sums["first"], open_row, new_row, level)
        below = {
            "head": head, "open": open_row, "n": sums["n"], "first": sums["first"],
            "kids": sums["kids"], "leaves": leaves, "saved": saved, "ends": ends,
        }
    none = np.zeros(len(below["head"]), np.int64)
    yield nodes_of(below, 0, level, none, np.full(1, -1), np.full(1, -1), new_row)
    if kept:
        yield {
            "kind": ["path"] * len(kept),
            "level": [level + 1] * len(kept),
            "row": [new_row[row] for row in kept],
            "path": [block.path[row] for row in kept],
            "ends": [chain_ends[row] for row in kept],
        } | {name: [chains[row][name].tolist() for row in kept] for name in LISTS}


def nodes_of(below, depth, level, parent, first, open_row, new_row) -> dict[str, list]:
    """The complete nodes among those of a depth; a parent that is open is named by path and depth."""
    done = np.flatnonzero(below["open"] < 0)
    parent = parent[done]
    parent_open = open_row[parent]
    is_open = parent_open >= 0
    blank = is_open if depth else np.ones(len(done), bool)
    renamed = np.array([new_row.get(int(row), -1) for row in parent_open], np.int64)
    return {
        "kind": ["node"] * len(done),
        "level": [level] * len(done),
        "conv_id": below["first"][done],
        "depth": np.full(len(done), depth),
        "parent_conv_id": pa.array(first[parent], pa.int64(), mask=blank),
        "parent_row": pa.array(renamed, pa.int64(), mask=~is_open),
        "parent_depth": pa.array(np.full(len(done), depth - 1), pa.int64(), mask=~is_open),
        "n_convs": below["n"][done],
        "n_children": below["kids"][done],
        "n_leaves": below["leaves"][done],
        "saved_tokens": below["saved"][done],
        "ends_sha256": [NO_ENDS if text is None else text for text in below["ends"][done]],
    }


def places_of(block, rows, depth, node, first, open_row, new_row, level) -> dict[str, list]:
    """Of which node each path is part at a depth: its smallest member, or again a path and depth."""
    still = open_row[node]
    is_open = still >= 0
    renamed = np.array([new_row.get(int(row), -1) for row in still], np.int64)
    return {
        "kind": ["place"] * len(rows),
        "level": [level] * len(rows),
        "from_row": block.row[rows],
        "from_depth": np.full(len(rows), depth),
        "conv_id": pa.array(first[node], pa.int64(), mask=is_open),
        "parent_row": pa.array(renamed, pa.int64(), mask=~is_open),
        "parent_depth": pa.array(np.full(len(rows), depth), pa.int64(), mask=~is_open),
    }


FOUND_TYPES = pa.schema(
    [
        (name, {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(),
                "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[kind])
        for name, kind in (field.split() for field in FOUND.split(", "))
    ]
)


def one_level(paths: DataFrame, level: int, last: bool, parts: int | None = None) -> DataFrame:
    """``FOUND`` of one level, written; with ``last`` all paths are one block."""
    if last:
        ordered = paths.coalesce(1).sortWithinPartitions("path")
    else:
        dealt = paths.repartitionByRange(*([parts] if parts else []), "path")
        ordered = dealt.sortWithinPartitions("path")
    bounds = (BLOCK_PATHS, BLOCK_ENTRIES, LEAST_PATHS)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows, entries = [], 0, 0
        for batch in batches:
            lengths = pa.compute.binary_length(batch.column("path")).to_numpy() // ENTRY
            start = 0
            for at, length in enumerate(lengths.tolist()):
                rows, entries = rows + 1, entries + length
                full = rows >= bounds[0] or (entries >= bounds[1] and rows >= bounds[2])
                if full and not last:
                    held.append(batch.slice(start, at + 1 - start))
                    yield pa.Table.from_batches(held)
                    held, rows, entries, start = [], 0, 0, at + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield pa.Table.from_batches(held)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, table in enumerate(blocks(batches)):
            for columns in forest(table, level, (part << 24) | number, last):
                n = len(columns["kind"])
                yield pa.RecordBatch.from_arrays(
                    [typed(columns.get(field.name), field.type, n) for field in FOUND_TYPES],
                    schema=FOUND_TYPES,
                )

    def typed(column, kind: pa.DataType, n: int) -> pa.Array:
        if column is None:
            return pa.nulls(n, kind)
        return column if isinstance(column, pa.Array) else pa.array(column, kind)

    return written(ordered.mapInArrow(read, FOUND), "trie")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    A row per distinct sequence of the first turns of rebuilt conversations, see ``rebuilt``.
    """
    levels = [one_level(classes(rebuilt(conversations)), 0, last=False)]
    while True:
        contracted = levels[-1].where("kind = 'path'").select(*NAMES)
        n, entries = contracted.agg(F.count("*"), F.sum(F.octet_length("path")) / ENTRY).first()
        if not n:
            break
        last = n <= LEAST_PATHS or (n <= BLOCK_PATHS and entries <= BLOCK_ENTRIES)
        # Few enough partitions that each again makes many paths two.
        parts = max(1, n // (64 * LEAST_PATHS))
        levels.append(one_level(contracted, len(levels), last, parts))
    # From the last level back: every path and depth with the smallest member of its node.
    known = None
    found = None
    for level in reversed(levels):
        node = level.where("kind = 'node'")
        place = level.where("kind = 'place'").select(
            "from_row", "from_depth", "conv_id", "parent_row", "parent_depth"
        )
        if known is None:
            nodes = node.select(*NODE)
            known = place.select("from_row", "from_depth", "conv_id")
        else:
            asked = known.select(
                F.col("from_row").alias("parent_row"), F.col("from_depth").alias("parent_depth"),
                F.col("conv_id").alias("learned"),
            )
            key = ["parent_row", "parent_depth"]
            left = node.where("parent_row IS NOT NULL").join(asked, key)
            taught = left.withColumn("parent_conv_id", F.col("learned")).select(*NODE)
            nodes = node.where("parent_row IS NULL").select(*NODE).unionAll(taught)
            settled = place.where("parent_row IS NULL").select("from_row", "from_depth", "conv_id")
            known = settled.unionAll(
                place.where("parent_row IS NOT NULL").join(asked, key)
                .select("from_row", "from_depth", F.col("learned").alias("conv_id"))
            )
        found = nodes if found is None else found.unionAll(nodes)
    return found
