"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

1. Every text becomes its set of word shingles and a sketch of some hundred coordinates, the rows of
   bands that the threshold asks for (``plan_bands``). In round i of the sketch each shingle is thrown into a hashed bin with the value (i, hash); a
   coordinate keeps the smallest value its bin got. After as many rounds as there are coordinates,
   each further round fills one given bin, so all get filled. Equal coordinates of two sketches
   estimate the Jaccard similarity with the concentration of independent samples.
2. Texts with equal sets form a class and go on as one row.
3. Classes that agree in all coordinates of a band are candidates. Each is first compared with the
   smallest class of its band, on full sets. That joins most of a group of near copies at a
   comparison per member. Where a band still holds several components, its classes are compared
   across them: sketches first, which must agree in ``least_agreement`` coordinates, five standard
   deviations below the threshold, and then on full sets. This happens inside tasks, in pairs of
   blocks of bounded size and each pair in its first common band; pairs are never emitted, only
   the links found.
4. Links make components; the document with the smallest id stays.

Nulls and empty texts have an empty set and link with nothing. Documents without an id link with
nothing, have no component and are not kept. Rows that repeat a doc_id come back each; texts of one
doc_id that are the smallest of their classes count as one document. A very long text is read whole and is
one set of its task. An empty table gives an empty result. Columns other than doc_id and text, whatever
their names, are not read, and ``without_copies`` returns them as they are.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import words
from creditloom.llm.components import components
from creditloom.sources.shared import checkpointed, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The chance that two texts at the threshold agree in no band, and the coordinates of a sketch.
MISS, SIZE = 5e-5, 125
# What a block of a band holds on average: classes, and shingles of all of them together.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
# Rows of a block that are compared at a time.
STRIP = 64


def sketch(place: np.ndarray, shingles: np.ndarray, n: int, size: int) -> np.ndarray:
    """An (n, size) matrix: the sketch of each of n sets, given as pairs (set, element)."""
    filled = np.full(n * size, words.EMPTY, np.uint64)
    open_sets = np.zeros(n, bool)
    open_sets[place] = True
    base = place * size
    for turn in range(2 * size):
        if not len(place):
            break
        hashed = words.mix(shingles, turn + 1)
        if turn < size:
            bins = ((hashed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(place), turn - size)
        values = (hashed & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32)
        np.minimum.at(filled, base + bins, values)
        done = (filled.reshape(n, size) != words.EMPTY).all(axis=1) & open_sets
        if done.any():
            open_sets &= ~done
            keep = open_sets[place]
            place, shingles, base = place[keep], shingles[keep], base[keep]
    return filled.reshape(n, size)


def plan_bands(percent: int) -> tuple[int, int]:
    """``(bands, rows)`` for texts of that similarity: as many rows a band as ``SIZE`` coordinates allow.

    25 bands of 5 at 80 percent. Below some 8 percent a band of one row is not enough and more
    coordinates are taken.
    """
    if not 0 < percent <= 100:
        raise ValueError("the similarity is between 0 and 100 percent")
    p, found = min(percent, 99) / 100, None
    for rows in range(1, SIZE + 1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(p**rows)))
        if found is None or bands * rows <= SIZE:
            found = (bands, rows)
    return found


def sketched(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, carried, n_shingles, set1, set2, bands, marks)`` per ``(doc_id, carried, text)``.

    ``set1`` and ``set2`` name the set in 128 bits; ``marks`` is a byte per coordinate.
    """
    size = bands * rows

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in words.parts(batch.column(2)):
                n = end - start
                place, found = words.shingle_sets(batch.column(2)[start:end], k)
                full = sketch(place, found, n, size)
                sums = np.zeros((2, n), np.uint64)
                for i in range(2):
                    np.add.at(sums[i], place, words.mix(found, 1001 + i))
                keys = np.zeros((n, bands), np.uint64)
                for j in range(rows):
                    keys = words.mix(keys ^ full[:, j::rows], 2001 + j)
                keys = words.mix(keys + np.arange(bands, dtype=np.uint64), 3001)
                marks = (words.mix(full, 4001) & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:end],
                        batch.column(1)[start:end],
                        pa.array(np.bincount(place, minlength=n).astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)),
                            pa.array(keys.view(np.int64).ravel()),
                        ),
                        pa.array([row.tobytes() for row in marks], pa.binary()),
                    ],
                    ["doc_id", "carried", "n_shingles", "set1", "set2", "bands", "marks"],
                )

    return docs.select("doc_id", "carried", "text").mapInArrow(
        read,
        "doc_id bigint, carried bigint, n_shingles bigint, set1 bigint, set2 bigint,"
        " bands array<bigint>, marks binary",
    )



def shingle_rows(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, shingles)``: the full set of each row as hashes."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in words.parts(batch.column(1)):
                n = end - start
                place, found = words.shingle_sets(batch.column(1)[start:end], k)
                ends = np.zeros(n + 1, np.int32)
                np.cumsum(np.bincount(place, minlength=n), out=ends[1:])
                sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], sets], ["doc_id", "shingles"]
                )

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, shingles array<bigint>")


def least_agreement(percent: int, size: int) -> int:
    """The coordinates, of ``size``, in which sketches of sets above the threshold agree."""
    p = percent / 100
    return max(1, int(size * (p - 5 * (p * (1 - p) / size) ** 0.5)))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row per row of ``docs``.

    Documents are linked if 100 * shared shingles >= ``percent`` * all their shingles.
    """
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    rows = docs.select(doc_id, doc_id.alias("carried"), "text")
    return grouped_rows(rows, k, percent).drop("carried")


def grouped_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` of ``(doc_id, carried, text)``, with what each row carries."""
    bands, rows = plan_bands(percent)
    all_rows = written(sketched(docs, k, bands, rows), "sketches")
    same_set = ["n_shingles", "set1", "set2"]
    classes = written(
        all_rows.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy(*same_set)
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("bands").alias("bands"),
            F.first("marks").alias("marks"),
        ),
        "classes",
    )
    named = checkpointed(
        class_components(docs, classes, k, percent).select(
            *same_set, F.col("component").alias("component_id")
        )
    )
    empty = F.col("n_shingles") == 0
    key = [F.when(~empty & F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in same_set]
    rows = all_rows.select("doc_id", "carried", F.col("n_shingles").alias("size"), *key)
    found = rows.join(named, same_set, "left").select(
        "doc_id",
        "carried",
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
    return found.withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def class_components(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The classes' names and ``component``, the smallest representative reachable by links."""
    banded = classes.select("rep", F.explode("bands").alias("band"))
    pivots = checkpointed(
        banded.groupBy("band")
        .agg(F.min("rep").alias("pivot"), F.count("*").alias("members"))
        .where("members > 1")
    )
    stars = checkpointed(
        banded.join(pivots, "band").where("rep != pivot")
        .groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b"))
        .agg(F.count("*").alias("bands"))
    )
    # Full sets are read again only for texts with a candidate.
    asked = stars.select(F.col("a").alias("doc_id")).union(stars.select("b")).distinct()
    sets = written(shingle_rows(docs.join(asked, "doc_id", "left_semi"), k), "sets")
    grouped = components(confirmed(stars, sets, percent), "a", "b")
    names = ["rep", "n_shingles", "set1", "set2"]
    first = checkpointed(
        classes.select(*names)
        .join(grouped, F.col("rep") == F.col("node"), "left")
        .select(*names, F.coalesce("component", "rep").alias("component"))
    )
    wide = banded.join(pivots.where("members > 2").select("band"), "band")
    members = wide.join(first.select("rep", "n_shingles", "component"), "rep")
    blocks = F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
    )
    # A band of one component has nothing left to compare.
    open_bands = checkpointed(
        members.groupBy("band")
        .agg(
            blocks.cast("int").alias("blocks"),
            F.min("component").alias("c1"),
            F.max("component").alias("c2"),
        )
        .where("c1 != c2")
        .select("band", "blocks")
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = members.join(open_bands, "band").withColumn("block", block)
    sketches = classes.select("rep", "marks", "bands")
    asked = checkpointed(promising(placed.join(sketches, "rep"), percent))
    # What is found now links components of the first labelling, which is carried on.
    more = linked(asked.join(sets, F.col("rep") == F.col("doc_id")), percent)
    again = components(more, "a", "b").withColumnsRenamed({"component": "final"})
    return first.join(again, F.col("component") == F.col("node"), "left").select(
        *names, F.coalesce("final", "component").alias("component")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough.

    Nothing that needs rows of one key together follows the joins, so that Spark can split the rows of a
    ``b`` that many pairs name.
    """
    first = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    union = F.size("set_a") + F.size("set_b") - shared
    met = pairs.select("a", "b").join(first, "a").join(second, "b")
    return checkpointed(met.where(100 * shared >= percent * union).select("a", "b"))


def promising(members: DataFrame, percent: int) -> DataFrame:
    """The members of each pair of blocks of a band that have a pair to verify there.

    ``(band, i, j, block, rep, component)``. A pair is verified if it is of two components, its
    sizes and the agreement of its sketches allow for a link, and this is its first common band.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = members.withColumn("other", other).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "rep", "component", "n_shingles", "marks", "bands",
    )
    least = least_agreement(percent, math.prod(plan_bands(percent)))

    def sift(group: pa.Table) -> pa.Table:
        i, j, band = (group[name][0].as_py() for name in ("i", "j", "band"))
        block, size = group["block"].to_numpy(), group["n_shingles"].to_numpy()
        component = group["component"].to_numpy()
        marks = np.frombuffer(b"".join(group["marks"].to_pylist()), np.uint8)
        marks = marks.reshape(len(block), -1).T.copy()
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(len(block), -1)
        turn = int(np.flatnonzero((bands == band).all(axis=0))[0])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        wanted = np.zeros(len(block), bool)
        for start in range(0, len(left), STRIP):
            rows = left[start : start + STRIP]
            small = np.minimum(size[rows][:, None], size[right][None, :])
            large = np.maximum(size[rows][:, None], size[right][None, :])
            ok = (100 * small >= percent * large) & (
                component[rows][:, None] != component[right][None, :]
            )
            if not ok.any():
                continue
            agree = np.zeros(ok.shape, np.int16)
            for mark in marks:
                agree += mark[rows][:, None] == mark[right][None, :]
            ok &= agree >= least
            for earlier in bands.T[:turn]:
                ok &= earlier[rows][:, None] != earlier[right][None, :]
            wanted[rows[ok.any(axis=1)]] = True
            wanted[right[ok.any(axis=0)]] = True
        return group.select(["band", "i", "j", "block", "rep", "component"]).filter(
            pa.array(wanted)
        )

    return met.groupBy("band", "i", "j").applyInArrow(
        sift, "band bigint, i int, j int, block int, rep bigint, component bigint"
    )


def linked(asked: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of components, confirmed on the full sets of ``asked``; per task a forest.

    The members' shingles are numbered; each set in turn is marked in a table, and the marks under
    the sets of another component are counted.
    """

    def compare(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        group = group.sort_by("rep")
        block, rep = group["block"].to_numpy(), group["rep"].to_numpy()
        component = group["component"].to_numpy()
        lists = group["shingles"].combine_chunks()
        sizes = pa.compute.list_value_length(lists).to_numpy()
        _, numbers = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        marked = np.zeros(int(numbers.max()) + 1, np.int64)
        right = np.flatnonzero(block == j)
        root = np.arange(len(rep))
        _, names = np.unique(component, return_inverse=True)
        # One tree per known component, so that only links between trees count.
        first = np.full(int(names.max()) + 1, len(rep))
        np.minimum.at(first, names, root)
        root = first[names]
        found_a, found_b = [], []
        for x in np.flatnonzero(block == i):
            own = numbers[ends[x] : ends[x + 1]]
            others = right[root[right] != root[x]]
            if i == j:
                others = others[others > x]
            small, large = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
            others = others[100 * small >= percent * large]
            if not len(others):
                continue
            marked[own] = 1
            each = np.repeat(ends[others] - np.cumsum(sizes[others]) + sizes[others], sizes[others])
            under = marked[numbers[each + np.arange(len(each))]]
            starts = np.cumsum(sizes[others]) - sizes[others]
            shared = np.add.reduceat(under, starts)
            marked[own] = 0
            hit = others[100 * shared >= percent * (sizes[others] + sizes[x] - shared)]
            # One link per tree is enough.
            _, one = np.unique(root[hit], return_index=True)
            for y in hit[one]:
                found_a.append(component[x])
                found_b.append(component[y])
                low, high = sorted((root[x], root[y]))
                root[root == high] = low
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return asked.groupBy("band", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest id.

    Here each text of a doc_id is a document of its own. Of several texts of that id in a component
    the one with the smallest hash stays, and of equal rows one. Documents without words link with
    nothing and stay, and so do rows without an id.
    """
    known = F.col("doc_id").isNotNull()
    text_id = F.when(known, F.xxhash64("doc_id", "text")).alias("text_id")
    rows = docs.select(
        text_id.alias("doc_id"), F.col("doc_id").cast("bigint").alias("carried"), "text"
    )
    grouped = grouped_rows(rows, k, percent).where("doc_id IS NOT NULL AND n_shingles > 0")
    texts = checkpointed(
        grouped.groupBy(F.col("doc_id").alias("text_id"), "carried", "component_id").agg(
            F.count("*").alias("rows")
        )
    )
    first = F.min(F.struct("carried", "text_id"))["text_id"].alias("first")
    stays = checkpointed(texts.groupBy("component_id").agg(first))
    is_first = F.col("text_id") == F.col("first")
    chosen = texts.join(stays, "component_id").withColumn("stays", is_first)
    gone = chosen.where("NOT stays OR rows > 1").select("text_id")
    # The row as a struct: its columns may have the names of those added here.
    named = docs.select(text_id, F.struct("*").alias("row"))
    single = named.join(gone, "text_id", "left_anti")
    repeated = chosen.where("stays AND rows > 1").select("text_id")
    once = named.join(repeated, "text_id", "left_semi").dropDuplicates(["text_id"])
    return single.unionAll(once).select("row.*")
