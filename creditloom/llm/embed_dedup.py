"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, verified pairs.

A hash is the axis, with its sign, nearest to the vector after three rounds of random signs and a
fast Hadamard rotation. A table joins several hashes to a bucket; a vector lives in its main bucket
and also visits those in which any of the hashes takes the second nearest axis instead. Two vectors
are candidates if one lives where the other lives or visits, and every candidate pair is verified by
its cosine in double precision. At cosine 0.98 and 64 dimensions a pair misses a table of three
hashes with a probability of about 0.17, and all seven with 4e-6; closer pairs far less. The number
of hashes grows with that of the vectors, so that buckets stay small, and the tables with it.

Equal vectors are one class first, so copies cost nothing. The pairs of a bucket are computed in
blocks and never emitted: a call returns, for each vector, its number of links and the smallest
vector it reaches there. Small buckets share calls. A pair that meets in several buckets counts in the first only. So a bucket
of m near copies costs m * m products but passes on m rows.

Vectors link only within equal, non-null labels and equal lengths. Vectors that are null, zero or
hold null or non-finite components link with nothing and are components of their own, as are rows
with a null label. A null vec_id links with nothing, has no component and is not kept. Rows that
repeat a vec_id count as vectors of their own. An empty table gives an empty result. A very long vector is
one value of its task. Columns other than vec_id, label and embedding, whatever their names, are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm import words
from creditloom.llm.components import components
from creditloom.sources.shared import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Hashes per table at least, and the chance that a pair at the threshold meets in no table.
LEAST_HASHES, MISS = 3, 5e-6
# A threshold that takes more tables than this is refused.
MOST_TABLES = 400
# Random pairs by which it is measured how often one hash agrees.
PAIRS = 100_000
# Vectors of a bucket that meet in one task, squared; 4 MB at 64 dimensions.
BLOCK = 8192
# Rows of a block that are multiplied at a time, and confirmed pairs that are held before they count.
STRIP, HELD = 256, 1 << 20
# Buckets of at most so many members share a task's call, about so many rows in each.
SMALL, PACK = 64, 4096


def usable(vector: str | Column) -> Column:
    """Not null, not zero, all components finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(lists: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as rows of doubles."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(lists), -1)


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Random signs and a Hadamard rotation, once per row of ``signs``; element by element, so a
    vector gets the same result in every batch."""
    n, width = x.shape
    for row in signs:
        x = x * row
        step = 1
        while step < width:
            pairs = x.reshape(n, width // (2 * step), 2, step)
            left, right = pairs[:, :, 0], pairs[:, :, 1]
            x = np.stack([left + right, left - right], axis=2).reshape(n, width)
            step *= 2
    return x


def buckets(x: np.ndarray, seeds: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """(vectors, tables, 2 ** hashes) bucket numbers, the main one first; ``seeds`` per vector."""
    width = max(2, 1 << (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    random = np.random.default_rng(20240210)
    found = np.zeros((len(x), tables, 1 << hashes), np.uint64)
    rows = np.arange(len(x))
    for t in range(tables):
        keys = np.repeat(words.mix(seeds, t)[:, None], 1 << hashes, axis=1)
        for h in range(hashes):
            turned = rotate(padded, random.choice([-1.0, 1.0], size=(3, width)))
            size = np.abs(turned)
            axes = []
            for _ in range(2):
                best = size.argmax(axis=1)
                axes.append(2 * best + (turned[rows, best] > 0))
                size[rows, best] = -1
            flips = (np.arange(1 << hashes) >> h) & 1
            keys = words.mix(keys ^ np.stack(axes, axis=1)[:, flips].astype(np.uint64), 100 + h)
        found[:, t] = keys
    return found


def seeds_of(labels: np.ndarray, width: int) -> np.ndarray:
    return words.mix(labels.astype(np.int64).view(np.uint64), 1000 + int(width))


def visits(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    """``(rep, bucket, main)``: the buckets of every class."""
    per_vector = tables << hashes

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column(0).to_numpy()
            labels = batch.column(1).to_numpy()
            widths = pa.compute.list_value_length(batch.column(2)).to_numpy()
            for width in np.unique(widths):
                some = np.flatnonzero(widths == width)
                x = matrix(batch.column(2).take(pa.array(some)))
                keys = buckets(x, seeds_of(labels[some], width), tables, hashes)
                main = np.zeros(keys.shape, bool)
                main[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(reps[some], per_vector)),
                        pa.array(keys.view(np.int64).ravel()),
                        pa.array(main.ravel()),
                    ],
                    ["rep", "bucket", "main"],
                )

    return classes.select("rep", F.col("label").cast("bigint"), "embedding").mapInArrow(
        read, "rep bigint, bucket bigint, main boolean"
    )


def agreement(cosine: float, width: int) -> tuple[float, float]:
    """How often, for a pair of that cosine and one hash, the nearest axis of the first is one of the two
    nearest of the second, and how often that holds both ways.

    Rotations being random, it is measured on random pairs, always the same ones.
    """
    size, random = max(2, 1 << (max(width, 1) - 1).bit_length()), np.random.default_rng(7)
    step = max(1, (1 << 20) // size)
    one = both = seen = 0
    while seen < PAIRS:
        x, y = random.standard_normal((2, step, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * y
        first, second = _visits_home(x, y), _visits_home(y, x)
        one += int(first.sum()) + int(second.sum())
        both, seen = both + int((first & second).sum()), seen + step
    return one / (2 * seen), both / seen


def _visits_home(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the nearest axis of each x is one of the two nearest of its y."""
    axis, rows = np.abs(x).argmax(axis=1), np.arange(len(x))
    nearer = (np.abs(y) > np.abs(y[rows, axis])[:, None]).sum(axis=1)
    return (nearer < 2) & ((x[rows, axis] > 0) == (y[rows, axis] > 0))


def meets(cosine: float, width: int, hashes: int) -> float:
    """The chance that such a pair meets in a table: all hashes agree one way or the other."""
    one, both = agreement(cosine, width)
    return 2 * one**hashes - both**hashes


def plan_tables(n: int, width: int, least_cosine: float) -> tuple[int, int]:
    """``(tables, hashes)``: so many hashes that there are as many buckets as vectors, and as many
    tables as then keep the chance of a miss at the threshold."""
    hashes = max(LEAST_HASHES, math.ceil(math.log(max(n, 1)) / math.log(2 * max(width, 2))))
    chance = min(meets(least_cosine, width, hashes), 1 - MISS)
    tables = math.ceil(math.log(MISS) / math.log1p(-chance)) if chance > 0 else MOST_TABLES + 1
    if tables > MOST_TABLES:
        raise ValueError(f"cosine {least_cosine} takes more than {MOST_TABLES} tables of {hashes} hashes")
    return tables, hashes


def near_duplicates(vectors: DataFrame, least_cosine: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per row of ``vectors``."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    good = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    classes = checkpointed(
        rows.where(good)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(2))).first()
    tables, hashes = plan_tables(n, width, least_cosine)
    light = visits(classes, tables, hashes)
    shared = checkpointed(
        light.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.max("main").alias("lived_in"))
        .where("members > 1 AND lived_in")
        .select("bucket", "members")
    )
    met = light.join(shared, "bucket").join(classes, "rep")
    rows_met = shared.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    packs = max(1, rows_met // PACK)
    found = checkpointed(verified(met, packs, least_cosine, tables, hashes))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "root").withColumnRenamed("node", "rep")
    known = checkpointed(
        classes.join(counts, "rep", "left").join(joined, "rep", "left").select(
            F.col("label").alias("l"),
            F.col("embedding").alias("e"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    key = [F.when(good, F.col(c)).alias(c) for c in ("label", "embedding")]
    keyed = rows.select("vec_id", *key)
    same = (keyed["label"] == known["l"]) & (keyed["embedding"] == known["e"])
    result = keyed.join(known, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return result.withColumn("kept", kept)


def verified(
    met: DataFrame, packs: int, least_cosine: float, tables: int, hashes: int
) -> DataFrame:
    """``(rep, links, root)``: confirmed links counted with their copies, and the smallest class
    reached, for each call. Small buckets are dealt into ``packs`` calls, large ones have a call per
    pair of blocks."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    small = F.col("members") <= SMALL
    call = F.when(small, F.pmod("bucket", F.lit(packs))).otherwise(F.col("bucket"))
    placed = met.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    cut = placed.select(
        small.alias("small"), call.alias("call"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "bucket", "block", "rep", "main", F.col("label").cast("bigint").alias("label"), "copies",
        "embedding",
    )

    def compare(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        group = group.sort_by([("bucket", "ascending"), ("rep", "ascending")])
        bucket = group["bucket"].to_numpy().view(np.uint64)
        copies, main = group["copies"].to_numpy(), group["main"].to_numpy()
        block, labels = group["block"].to_numpy(), group["label"].to_numpy()
        widths = pa.compute.list_value_length(group["embedding"]).to_numpy()
        # A class is in several buckets of a call.
        rep, name = np.unique(group["rep"].to_numpy(), return_inverse=True)
        links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            if not held:
                return
            a, b = (np.concatenate(side) for side in zip(*held))
            held.clear()
            # Only vectors of confirmed pairs are hashed again.
            some, (x, y) = np.unique([a, b], return_inverse=True)
            vectors = matrix(group["embedding"].take(pa.array(some)))
            seeds = seeds_of(labels[some], vectors.shape[1])
            first = first_meeting(buckets(vectors, seeds, tables, hashes), x, y) == bucket[a]
            a, b = a[first], b[first]
            np.add.at(links, name[a], copies[b])
            np.add.at(links, name[b], copies[a])
            unite(root, name[a], name[b])

        for width in np.unique(widths[starts]):
            own = np.flatnonzero(widths == width)
            x = matrix(group["embedding"].take(pa.array(own)))
            unit = np.zeros((len(widths), width))
            unit[own] = x / np.sqrt((x * x).sum(axis=1))[:, None]
            pairs = 0
            for start, end in zip(starts, [*starts[1:], len(bucket)]):
                if widths[start] != width:
                    continue
                inside = np.arange(start, end)
                left, right = inside[block[inside] == i], inside[block[inside] == j]
                for at in range(0, len(left), STRIP):
                    strip = left[at : at + STRIP]
                    near = unit[strip] @ unit[right].T >= least_cosine
                    near &= main[strip][:, None] | main[right][None, :]
                    if i == j:
                        near &= strip[:, None] < right[None, :]
                    a, b = np.nonzero(near)
                    if len(a):
                        held.append((strip[a], right[b]))
                        pairs += len(a)
                    if pairs > HELD:
                        count()
                        pairs = 0
            count()
        some = np.flatnonzero(links > 0)
        return pa.table({"rep": rep[some], "links": links[some], "root": rep[root[some]]})

    return cut.groupBy("small", "call", "i", "j").applyInArrow(
        compare, "rep bigint, links bigint, root bigint"
    )


def first_meeting(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bucket in which each pair counts: of their first table, the smaller if there are two."""
    result = np.zeros(len(a), np.uint64)
    open_pairs = np.arange(len(a))
    for t in range(keys.shape[1]):
        if not len(open_pairs):
            break
        x, y = keys[a[open_pairs], t], keys[b[open_pairs], t]
        one = np.where((x[:, :1] == y).any(axis=1), x[:, 0], words.EMPTY)
        two = np.where((y[:, :1] == x).any(axis=1), y[:, 0], words.EMPTY)
        least = np.minimum(one, two)
        met = least != words.EMPTY
        result[open_pairs[met]] = least[met]
        open_pairs = open_pairs[~met]
    return result


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked places; a root is the smallest place of its tree."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            onward = root[root]
            if (onward == root).all():
                break
            root[:] = onward
