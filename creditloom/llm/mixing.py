"""Mixing sources to target weights by a low-discrepancy schedule.

1. Targets. The sources share ``scale`` times all words by weight. No target exceeds ``most`` times
   its source's size; the excess is shared by weight among the others. Sorted by cap over weight
   the capped sources come first, so running sums over the sources give the shares in one pass.
2. Schedule. A van der Corput sequence of 2**bits points is mapped through the cumulative targets:
   point i names the source of slot i. The first 2**k points lie evenly for each k, so every source
   is taken at its rate from the beginning on. Slots are ranked per source.
3. Blocks. A source's documents lie in a line in hashed order, repeated up to ``most`` times; the line
   up to the target is cut into blocks of equally many words. Slot r of a source takes its block r.
   A block the points left over (at most one or two per source) follows after the last slot.

The rows are the pieces of documents that each slot takes. A source takes exactly its target, rounded
to words, and a document at most ``most`` times its size. Order depends on doc_id and source only, so
reruns agree.

Running sums over a source are taken in two levels of 256 parts by hash, so that no task holds a
whole source; the per-source and per-part tables come from aggregates. Windows over all sources
hold a row per source.

What a source gives in all follows from its target; the schedule says when. ``mixed_documents``, which
returns whole documents, has no use for the slots within one.

Documents of no words take part with nothing; a null text is empty; a null source is a source and
comes last; rows that repeat a doc_id are documents of their own, and null ids too. A very long text is
cut into as many pieces as it fills slots. An empty table gives an empty result. Columns other than
doc_id, source and text, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.sources.shared import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
# The smallest number of slots, as a power of two, and the words a slot holds at most.
LEAST_BITS, BLOCK_WORDS = 12, 512
# Cells of the cumulative targets, for finding the source of a point without comparing all.
CELLS = 4096
# Slots that are ranked in one go.
RUN = 4096


def size_of(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, scale: float = 1.5, most: int = 2
) -> DataFrame:
    """``(source, source_size, target)`` from a row per source.

    Sources without words get no target; as all caps sum to more than ``scale`` times the words
    (``most`` > ``scale``), the shares always fit.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(everything) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place)
    weighted = sources.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * float(most)
    )
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(whole) * scale - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = weighted.withColumn("level", left / open_weight)
    # The first source that stays below its cap sets the level for all after it.
    open_level = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    final = F.first(open_level, ignorenulls=True).over(whole)
    reached = level.withColumn("final", final)
    share = F.col("weight") * F.coalesce("final", F.lit(float("inf")))
    return reached.select("source", "source_size", F.least("cap", share).alias("target"))


def line_position(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``rows`` with ``line``, the sum of ``value`` over the earlier rows per ``keys``.

    The order is that of ``spread``, a number of 60 bits, and then ``order``.
    """
    bits = F.lit(255).cast("bigint")
    parted = rows.withColumn("_one", F.shiftright("spread", 52)).withColumn(
        "_two", F.shiftright("spread", 44).bitwiseAND(bits)
    )
    one, two = [*keys, "_one"], [*keys, "_one", "_two"]
    sums = parted.groupBy(*two).agg(F.sum(value).alias("_sum"))
    firsts = sums.groupBy(*one).agg(F.sum("_sum").alias("_sum"))
    firsts = firsts.select(*one, _sum_before("_sum", keys, ["_one"]).alias("_base"))
    seconds = sums.select(*two, _sum_before("_sum", one, ["_two"]).alias("_more"))
    within = parted.withColumn("_own", _sum_before(value, two, ["spread", *order]))
    placed = _same(within, _same(seconds, firsts, one), two)
    line = F.col("_base") + F.col("_more") + F.col("_own")
    return placed.withColumn("line", line).select(*rows.columns, "line")


def _sum_before(value: str, keys: list[str], order: list[str]) -> Column:
    window = Window.partitionBy(*keys).orderBy(*order)
    before = F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0).cast("bigint"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys``, nulls equal: the columns of ``left`` and the other ones of ``right``."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    on = [left[key].eqNullSafe(renamed[f"_r_{key}"]) for key in keys]
    condition = on[0]
    for one in on[1:]:
        condition = condition & one
    return left.join(renamed, condition, "left").drop(*[f"_r_{key}" for key in keys])


DOCUMENT = ("doc_id", "source", "size", "spread")


def document_line(
    docs: DataFrame, more: Sequence[Column] = (), **options
) -> tuple[DataFrame, DataFrame, int]:
    """The documents in their sources' lines, a row per source, and the words of the mixture.

    Documents: ``(doc_id, source, size, spread, *more, source_size, target, words, line)``, where
    ``words`` is what the source gives and ``line`` where the document begins in its source's line.
    """
    text_id = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    spread = F.conv(F.substring(text_id, 1, 15), 16, 10).cast("bigint")
    size = size_of("text")
    rows = checkpointed(
        docs.select("doc_id", "source", size.alias("size"), spread.alias("spread"), *more)
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    words = F.floor(F.col("target") + 1e-6).cast("bigint")
    shares = checkpointed(targets(sources, **options).withColumn("words", words))
    total = shares.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    order = ["doc_id", "size", *[c for c in rows.columns if c not in DOCUMENT]]
    return _same(line_position(rows, ["source"], "size", order), shares, ["source"]), shares, total


def _block_words(total: int) -> int:
    return max(1, -(-total // (1 << _bits(total))))


def _bits(total: int) -> int:
    return max(LEAST_BITS, (max(total, 1) // BLOCK_WORDS).bit_length())


def pieces(line: DataFrame, total: int, most: int = 2) -> DataFrame:
    """``line`` with a row per document, pass and block: ``(pass, block, start, taken)``.

    ``start`` is the first word within the document. A pass in which nothing is taken of a document
    has one row with nulls.
    """
    block = _block_words(total)
    turns = F.sequence(F.lit(0), F.lit(most - 1))
    begin = F.col("pass") * F.col("source_size") + F.col("line")
    turned = line.withColumn("pass", F.explode(turns)).withColumn("_from", begin)
    turned = turned.withColumn("_to", F.least(F.col("_from") + F.col("size"), "words"))
    first, last = F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block)
    blocks = F.when(F.col("_from") < F.col("_to"), F.sequence(first, last))
    cut = turned.withColumn("block", F.explode_outer(blocks))
    at = F.greatest(F.col("_from"), F.col("block") * block)
    until = F.least(F.col("_to"), (F.col("block") + 1) * block)
    missing = F.col("block").isNull()
    return cut.withColumns(
        {
            "start": F.when(~missing, at - F.col("_from")),
            "taken": F.when(~missing, until - at),
        }
    ).drop("_from", "_to")


def schedule(shares: DataFrame, total: int) -> DataFrame:
    """``(slot, source, block)``: the block that each slot takes."""
    spark = shares.sparkSession
    bits, block = _bits(total), _block_words(total)
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    high = F.sum("words").over(everything.rowsBetween(Window.unboundedPreceding, 0))
    spans = shares.select("source", "words").withColumn("high", high)
    spans = spans.withColumn("low", F.col("high") - F.col("words"))
    spans = spans.where("words > 0").withColumn("blocks", F.ceil(F.col("words") / block))
    cell = max(total, 1) / CELLS
    covered = F.sequence(F.floor(F.col("low") / cell), F.floor(F.col("high") / cell))
    by_cell = spans.withColumn("cell", F.explode(covered))

    backwards = F.reverse(F.lpad(F.bin("slot"), bits, "0"))
    point = F.conv(backwards, 2, 10).cast("double") / float(1 << bits) * float(total)
    points = spark.range(1 << bits).toDF("slot").withColumn("point", point)
    points = points.withColumn("cell", F.floor(F.col("point") / cell))
    named = points.join(by_cell, "cell").where("point >= low AND point < high")
    slots = named.select("slot", "source", F.floor(F.col("slot") / RUN).alias("run"))

    runs = slots.groupBy("source", "run").agg(F.count("*").alias("n"))
    earlier = runs.select("source", "run", _sum_before("n", ["source"], ["run"]).alias("earlier"))
    in_run = Window.partitionBy("source", "run").orderBy("slot")
    ranked = _same(
        slots.withColumn("place", F.row_number().over(in_run) - 1), earlier, ["source", "run"]
    ).select("slot", "source", (F.col("earlier") + F.col("place")).alias("block"))
    used = _same(ranked, spans.select("source", "blocks"), ["source"]).where("block < blocks")

    counts = runs.groupBy("source").agg(F.sum("n").alias("n"))
    given = _same(spans.select("source", "blocks"), counts, ["source"])
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    left = F.when(n < F.col("blocks"), F.sequence(n, F.col("blocks") - 1))
    rest = given.select("source", n.alias("n"), F.explode(left).alias("block"))
    late = (F.col("block") - F.col("n") + (1 << bits)).alias("slot")
    return used.select("slot", "source", "block").unionAll(rest.select(late, "source", "block"))


def mix(docs: DataFrame, more: Sequence[Column] = (), **options) -> DataFrame:
    """The mixture: a row for each piece of a document that a slot takes.

    ``(slot, doc_id, source, size, source_size, target, line, pass, start, taken, *more)``; a pass
    in which nothing is taken of a document has one row with a null slot. ``line`` tells rows of
    one doc_id apart.
    """
    line, shares, total = document_line(docs, more, **options)
    cut = pieces(line, total, options.get("most", 2))
    given = schedule(shares, total)
    placed = _same(cut.where("block IS NOT NULL"), given, ["source", "block"])
    whole = placed.unionByName(cut.where("block IS NULL").withColumn("slot", F.lit(None)))
    return whole.drop("block", "spread", "words")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_slot)``, a row per document.

    ``first_slot`` is the slot of the schedule that takes the document's first word, null if none does.
    """
    row = ["doc_id", "source", "size", "source_size", "target", "line"]
    # Equal documents without words share a place in the line; each is counted once per pass.
    first = (F.col("pass") == 0) & (F.coalesce("start", F.lit(0)) == 0)
    taken = F.sum(F.when(F.col("slot").isNotNull(), F.col("taken")))
    begins = F.min(F.when(first, F.col("slot"))).alias("first_slot")
    summed = mix(docs, **options).groupBy(*row).agg(
        F.coalesce(taken, F.lit(0)).alias("taken"), F.count_if(first).alias("rows"), begins
    )
    each = summed.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mixture repeats and cuts them, with the columns of ``docs``.

    A row per document and pass; of the last document of a source only the first words are taken,
    then joined by single spaces, and ``n_chars`` is counted anew. Rows that are equal in doc_id,
    source and text are told apart by nothing, so one of them stands for all.
    """
    mark, row = F.xxhash64("text").alias("mark"), ["doc_id", "source", "mark"]
    takes = mix(docs, [mark], **options).where("slot IS NOT NULL")
    takes = takes.groupBy(*row, "line", "pass", "size").agg(F.sum("taken").alias("taken"))
    # The row as a struct: its columns may have the names of those added here.
    once = docs.select("doc_id", "source", mark, F.struct("*").alias("row")).dropDuplicates(row)
    met = _same(once, takes.select(*row, "size", "taken"), row).where("taken > 0")
    all_words = F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0))
    words = F.slice(all_words, 1, F.col("taken").cast("int"))
    cut = F.col("taken") < F.col("size")
    text = F.when(cut, F.array_join(words, " ")).otherwise(F.col("row.text"))
    changed = met.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in docs.columns:
        chars = F.when(cut, F.length("row.text").cast("bigint")).otherwise(F.col("row.n_chars"))
        changed = changed.withColumn("row", F.col("row").withField("n_chars", chars))
    return changed.select("row.*")
