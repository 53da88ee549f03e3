"""Quality of documents by a sparse ensemble of rules.

1. Statistics of a text are Spark column expressions (``STATISTICS``): counts and shares that hold for
   any language. Labels, lang, source and doc_id are never among them.
2. Small boosted trees are grown on a sample of labelled rows. Every path from a root to a node is
   a rule, a conjunction of conditions "statistic <= bound" or "statistic > bound".
3. A logistic regression with an L1 penalty gives the rules weights; most become zero.
4. The rules left are compiled into one Spark column, the score: no model leaves the JVM and no row
   goes to Python.

The sample is bounded by ``SAMPLE`` rows, the labelled rows with the smallest hash of their id, so it
does not depend on the layout; training on it takes place on the driver, on ``SAMPLE`` x statistics
numbers. Everything else covers all rows.

Null and empty texts have the statistics of no words and get a score like any other. Labels that are
null are no labels; of several labels of one document the smallest counts, of several texts the
smallest in statistics. Without labels, or with labels of one kind only, the score is their smoothed
mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
# Trees, their depth, the least rows of a leaf, the bounds tried per statistic.
TREES, DEPTH, LEAF, BOUNDS = 24, 3, 20, 32
RATE = 0.3
# The penalty, as a part of the one at which all weights are zero, and the steps taken.
PENALTY, STEPS = 0.02, 600
SPACE = r"[\x20\x09-\x0D]+"


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.greatest(whole, F.lit(1)), F.lit(0.0)).cast("double")


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text that is not null."""
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.split(text, "\n")
    chars, n = F.length(text), F.size(words)
    return {
        "words": F.log1p(n).cast("double"),
        "word_length": _share(chars, n),
        "distinct_words": _share(F.size(F.array_distinct(words)), n),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_words": F.log1p(_share(n, F.size(lines))),
        "capitals": _share(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
        "symbols": _share(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:'()-]")), n),
        "digits": _share(F.regexp_count(text, F.lit("[0-9]")), chars),
        "stops": _share(_count(text, "."), n),
        "commas": _share(_count(text, ","), n),
        "exclamations": _share(_count(text, "!"), n),
        "bars": _share(_count(text, "|"), n),
    }


NAMES = tuple(
    "words word_length distinct_words distinct_lines line_words capitals symbols digits stops"
    " commas exclamations bars".split()
)


def with_statistics(docs: DataFrame, *more: str) -> DataFrame:
    """``(*more, s_words, ..)``: the statistics of every row's whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*more, *[c.alias(f"s_{name}") for name, c in statistics(text).items()])


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, NAMES.index(self.name)]
        return column > self.bound if self.above else column <= self.bound

    def column(self) -> Column:
        value = F.col(f"s_{self.name}")
        return value > self.bound if self.above else value <= self.bound


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    """score = 1 / (1 + exp(-(intercept + the weights of the rules that hold)))."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            holds = rule[0].column()
            for condition in rule[1:]:
                holds = holds & condition.column()
            total = total + F.when(holds, float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), float(self.intercept))
        for rule, weight in self.rules:
            total += weight * np.all([condition.holds(x) for condition in rule], axis=0)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, residual: np.ndarray, rows: np.ndarray, path: Rule, depth: int, leaf: int):
    """Yield (path, rows) of every node below the root of a least-squares tree."""
    if path:
        yield path, rows
    if len(path) == depth or len(rows) < 2 * leaf:
        return
    best = (1e-9, None)
    target = residual[rows]
    mean = target.mean()
    for place, name in enumerate(NAMES):
        values = x[rows, place]
        order = np.argsort(values, kind="stable")
        ordered, sums = values[order], np.cumsum(target[order] - mean)
        cuts = np.unique(np.linspace(leaf, len(rows) - leaf, BOUNDS).astype(int))
        cuts = cuts[ordered[cuts - 1] < ordered[np.minimum(cuts, len(rows) - 1)]]
        if not len(cuts):
            continue
        gain = sums[cuts - 1] ** 2 * (1 / cuts + 1 / (len(rows) - cuts))
        at = int(gain.argmax())
        if gain[at] > best[0]:
            cut = cuts[at]
            best = (gain[at], (name, float(ordered[cut - 1] + ordered[cut]) / 2))
    if best[1] is None:
        return
    name, bound = best[1]
    for above in (False, True):
        condition = Condition(name, above, bound)
        inside = rows[condition.holds(x[rows])]
        if len(inside):
            yield from grow(x, residual, inside, (*path, condition), depth, leaf)


def tree_rules(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF
) -> list[Rule]:
    """The distinct rules of boosted trees, in the order found."""
    total = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        step = np.zeros(len(y))
        # Deeper nodes come after their parents and overwrite them.
        for path, rows in grow(x, y - p, np.arange(len(y)), (), depth, leaf):
            found[path] = None
            weight = (p[rows] * (1 - p[rows])).sum()
            step[rows] = np.clip((y[rows] - p[rows]).sum() / max(weight, 1e-6), -4, 4)
        total = total + RATE * step
    return list(found)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS):
    """(intercept, weights) by accelerated proximal gradient steps; the intercept is free.

    ``z`` tells per row and rule whether it holds. Rows for which the same rules hold are one with a count, so the
    matrix of numbers has as many rows as there are such patterns.
    """
    z = z.astype(bool)
    n, rules = z.shape
    packed = np.packbits(z, axis=1)
    _, first, of_row = np.unique(
        packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True
    )
    count = np.bincount(of_row).astype(float)
    good = np.bincount(of_row, weights=y)
    centred = z[first].astype(float)
    mean = count @ centred / n
    centred -= mean
    p0 = y.mean()
    least_all_zero = np.abs(centred.T @ (good - p0 * count)).max() / n
    strength = penalty * least_all_zero
    # The largest eigenvalue of the rules' small product matrix bounds the curvature.
    product = centred.T @ (centred * count[:, None])
    size = float(np.linalg.eigvalsh(product)[-1]) / (4 * n) + 0.25
    weights = ahead = np.zeros(rules)
    intercept = ahead_intercept = float(np.log(p0 / (1 - p0)))
    momentum = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(ahead_intercept + centred @ ahead)))
        surplus = count * p - good
        moved = ahead - centred.T @ surplus / n / size
        new = np.sign(moved) * np.maximum(np.abs(moved) - strength / size, 0)
        new_intercept = ahead_intercept - surplus.sum() / n / size
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        onward = (momentum - 1) / next_momentum
        ahead = new + onward * (new - weights)
        ahead_intercept = new_intercept + onward * (new_intercept - intercept)
        weights, intercept, momentum = new, new_intercept, next_momentum
    return intercept - float(mean @ weights), weights


def fit(x: np.ndarray, y: np.ndarray, **growth) -> RuleModel:
    """Rules and weights from a matrix of statistics (in the order of ``NAMES``) and labels 0/1."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(p / (1 - p))), ())
    rules = tree_rules(x, y, **growth)
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    # Rules that hold for the same rows are one, the first found.
    distinct: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for rule in rules:
        holds = np.all([c.holds(x) for c in rule], axis=0)
        distinct.setdefault(np.packbits(holds).tobytes(), (rule, holds))
    rules = [rule for rule, _ in distinct.values()]
    z = np.stack([holds for _, holds in distinct.values()], axis=1)
    distinct.clear()
    intercept, weights = lasso_logistic(z, y)
    kept = [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6]
    return RuleModel(float(intercept), tuple(kept))


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """The model from the labelled rows outside the held-out fold, ``sample`` of them at most."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(fold() != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # At most ``sample`` rows of two numbers.
    labelled = with_statistics(texts.join(F.broadcast(known), "doc_id"), "doc_id", "quality")
    values = [F.col(f"s_{name}") for name in NAMES]
    rows = (
        labelled.groupBy("doc_id")
        .agg(F.min(F.struct("quality", *values)).alias("row"))
        .select("doc_id", "row.*")
        .toArrow()
        .sort_by("doc_id")
    )
    x = np.stack([rows[f"s_{name}"].to_numpy() for name in NAMES], axis=1)
    return fit(x, (rows["quality"].to_numpy() > 0).astype(float))


def scored(docs: DataFrame, model: RuleModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(*keep, score)`` for every row."""
    return with_statistics(docs, *keep).select(*keep, model.column().alias("score"))


def accepted(docs: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, in one pass over them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # The row as a struct: its columns may have the names of statistics.
    counted = docs.select(
        F.struct("*").alias("row"), *[c.alias(f"s_{name}") for name, c in statistics(text).items()]
    )
    # A place of its own keeps Spark from moving the condition below the statistics, where it would
    # compute each of them anew for every rule that asks for it.
    scores = counted.select(
        "row", model.column().alias("score"), F.monotonically_increasing_id().alias("place")
    )
    return scores.where((F.col("score") >= threshold) & (F.col("place") >= 0)).select("row.*")


def classified(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, a row per row of ``docs``."""
    return scored(docs, trained(docs, labels, sample)).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
