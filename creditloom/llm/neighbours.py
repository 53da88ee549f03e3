"""Nearest vectors by inner product: collision-counting hashing.

A hash is one random projection, kept as a sorted array. For a query each array gives the vectors in
a window around the query's own value. The windows grow with a search radius (virtual rehashing: a
wider window stands for a coarser bucket), beginning at the distance of the nearest few of a sample.
A vector that collides with the query in enough arrays is verified: its exact inner product is taken.
At a radius R the threshold lies so low that a vector at distance R exceeds it with a probability of
90 %, a nearer one more often; the search ends once the k-th verified vector is within R.

Inner products become distances by one more coordinate: with M the largest norm, a vector gets
sqrt(M**2 - |x|**2) and a query 0, so the largest inner product is the smallest distance.

The vectors are dealt into shards of about ``SHARD`` and the queries into blocks of about ``ASKED``;
every shard meets every block in a task, which returns its k best per query, and Spark merges these.
Nothing is dropped: each vector is in one shard, and each query visits all. That is the work of a
stated query set against all rows: it grows with their product, the memory of a task does not.

Null, zero and non-finite vectors and rows without an id take no part; vectors of different length
are never compared. A candidate is every row with another vec_id than the query's; rows that repeat
a vec_id are candidates each, and as a query the smallest of their vectors counts.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm import embed_dedup
from creditloom.llm.embed_dedup import matrix, usable

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(embed_dedup)

PROJECTIONS = 96
SHARD, ASKED = 32768, 512
# Queries that are counted at a time.
STRIP = 16
# One in so many vectors is looked at for the first radius; the factor to the next radius.
SAMPLED, GROWTH = 16, 1.1
# Half a window, in radii.
HALF_WINDOW = 1.0
# Standard deviations that the threshold lies below the expected collisions at the radius.
SLACK = NormalDist().inv_cdf(0.9)


class SortedProjections:
    """The sorted arrays of one shard.

    ``sorted`` holds the values of each projection in order and ``ranks`` the place of each vector in
    them, so a window of an array is a range of ranks.
    """

    def __init__(self, x: np.ndarray, m: int):
        self.x = x
        squares = (x * x).sum(axis=1)
        self.norm = float(np.sqrt(squares.max()))
        rest = np.sqrt(np.maximum(0, self.norm**2 - squares))
        self.axes = np.random.default_rng(x.shape[1]).normal(size=(x.shape[1] + 1, m))
        values = (np.concatenate([x, rest[:, None]], axis=1) @ self.axes).T
        order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=1)
        places = np.arange(len(x), dtype=np.uint16 if len(x) < 1 << 16 else np.uint32)
        self.ranks = np.empty(values.shape, places.dtype)
        np.put_along_axis(self.ranks, order, places[None, :], axis=1)
        self.sample = np.random.default_rng(len(x)).permutation(len(x))[: -(-len(x) // SAMPLED)]

    def collisions(self, centres: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """(queries, vectors): in how many arrays a vector is in the window of a query."""
        counts = np.zeros((len(centres), len(self.x)), np.uint8)
        for values, ranks, centre in zip(self.sorted, self.ranks, centres.T):
            low = np.searchsorted(values, centre - halves, "left")
            high = np.searchsorted(values, centre + halves, "right")
            # Below the window the difference wraps around to a large number.
            shifted = ranks[None, :] - low.astype(ranks.dtype)[:, None]
            counts += shifted < (high - low).astype(ranks.dtype)[:, None]
        return counts

    def nearest(self, queries: np.ndarray, k: int, skip: list[np.ndarray]):
        """Per query the places and exact inner products of what was verified, at least the best k
        found. ``skip`` has the places that are no candidates."""
        n, m = len(self.x), len(self.axes.T)
        scale = self.norm
        lengths = np.sqrt((queries * queries).sum(axis=1))
        # A query in units of the shard's largest norm: its length does not change the order.
        units = queries * (scale / lengths)[:, None]
        centres = np.concatenate([units, np.zeros((len(units), 1))], axis=1) @ self.axes
        # The first radius: as far as some of a sample, about the k-th of all.
        some = min(len(self.sample), max(1, round(k / SAMPLED)) + 1)
        products = np.partition(units @ self.x[self.sample].T, len(self.sample) - some, axis=1)
        radius = np.sqrt(np.maximum(0, 2 * scale**2 - 2 * products[:, len(self.sample) - some]))
        radius = np.maximum(radius, 1e-6 * scale)
        chance = 2 * NormalDist().cdf(HALF_WINDOW) - 1
        least = m * chance - SLACK * math.sqrt(m * chance * (1 - chance))
        allowed = np.ones((len(queries), n), bool)
        for at, places in enumerate(skip):
            allowed[at, places] = False
        found = [np.zeros(0, np.int64)] * len(queries)
        scores = [np.zeros(0)] * len(queries)
        open_queries = np.arange(len(queries))
        while len(open_queries):
            counts = self.collisions(centres[open_queries], HALF_WINDOW * radius[open_queries])
            still = []
            for at, count in zip(open_queries, counts):
                whole = radius[at] >= 2 * scale
                new = np.flatnonzero(allowed[at] & ((count >= least) | whole))
                allowed[at, new] = False
                found[at] = np.concatenate([found[at], new])
                products = (self.x[new] * queries[at]).sum(axis=1)
                scores[at] = np.concatenate([scores[at], products])
                if len(found[at]) >= k and not whole:
                    kth = np.partition(scores[at], len(scores[at]) - k)[len(scores[at]) - k]
                    # |q'|**2 + |x'|**2 - 2 q'x', with both of the largest norm.
                    whole = 2 * scale**2 - 2 * kth * scale / lengths[at] <= radius[at] ** 2
                if not whole:
                    still.append(at)
            open_queries = np.array(still, np.int64)
            radius[open_queries] *= GROWTH
        return found, scores


def nearest(
    vectors: DataFrame,
    asked: Column,
    k: int = 20,
    projections: int = PROJECTIONS,
    shard: int = SHARD,
    block: int = ASKED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows for which ``asked`` holds."""
    good = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding",
        F.size("embedding").alias("width"), F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    n, q = good.agg(F.count("*"), F.count_if("asked")).first()
    shards, blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(q / block))
    place = F.xxhash64("vec_id")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    held = good.select(
        "vec_id", "embedding", "width", F.lit(False).alias("asked"),
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"),
    )
    once = good.where("asked").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asking = once.select(
        "vec_id", "embedding", F.size("embedding").alias("width"), F.lit(True).alias("asked"),
        every(shards).alias("shard"), F.pmod(place, F.lit(blocks)).cast("int").alias("block"),
    )

    def search(group: pa.Table) -> pa.Table:
        is_query = group["asked"].to_numpy()
        ids, x = group["vec_id"].to_numpy(), matrix(group["embedding"])
        # The same order, and so the same sample, whichever way the rows came.
        order = np.lexsort((x[:, -1], x[:, 0], ids))
        is_query, ids, x = is_query[order], ids[order], x[order]
        queries, rows = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        found_query, found_id, found_score = [], [], []
        if len(queries) and len(rows):
            index = SortedProjections(x[rows], projections)
            row_ids = ids[rows]
            for start in range(0, len(queries), STRIP):
                strip = queries[start : start + STRIP]
                own = [np.flatnonzero(row_ids == ids[at]) for at in strip]
                for at, place, score in zip(strip, *index.nearest(x[strip], k, own)):
                    best = np.lexsort((row_ids[place], -score))[:k]
                    found_query.append(np.full(len(best), ids[at]))
                    found_id.append(row_ids[place[best]])
                    found_score.append(score[best])
        empty = [np.zeros(0, np.int64)]
        return pa.table(
            {
                "query_id": np.concatenate(found_query or empty),
                "vec_id": np.concatenate(found_id or empty),
                "score": np.concatenate(found_score or empty).astype(np.float64),
            }
        )

    found = held.unionAll(asking).groupBy("width", "shard", "block").applyInArrow(
        search, "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
