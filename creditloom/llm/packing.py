"""Packing documents into sequences, each window of them mixed to the target proportions.

Tokens. A document is the ids of its text and one closing id. It is cut where it is read: into full
sequences, and its rest into pieces whose sizes are powers of two. So a piece and its checksum are
known before it is known where it goes, and ids are computed once and never stored or shuffled.

Windows. Each source is a queue, its documents in hashed order. In every window the sources that still
have pieces earn its tokens in proportion to their weights; a source gives pieces as long as its credit
lasts, the last one may overdraw it, and what is overdrawn or left is carried into the next window
(deficit round robin). When a queue runs out, even within a window, what it would have earned goes to the
others by weight, so every window is filled and the last source ends with the last token. Without weights
a source's weight is its stock, and all queues run out together.

What a source has earned when it has given x tokens, x / weight, is a clock that all sources share: at
clock v, source s has given min(stock, weight * v). So the tokens that all have given when a piece's first
token is earned, and by them its window, follow from the tokens before it in its own queue and the stocks
and weights alone. That needs running sums per source, in two levels of hashed parts, and no state that is
handed from window to window or partition to partition. A source's row holds the clock times at which
sources ran out before it, so the sources, not the rows, have to be few.

Sequences. A window's pieces are laid in a line by falling size. Their sizes being powers of two, no
piece crosses a multiple of the sequence length. What is left after the last full sequence is cut
into sequences whose lengths are powers of two, which fit as exactly: nothing is padded at all.

Null texts are empty, and an empty document is its closing id alone. A null source is a source. Null
and repeated doc_ids are documents of their own; pieces equal in all columns may change places. A very
long text is cut into many pieces and encoded as one value of its task. An empty table gives no pieces.
Columns other than doc_id, source and text, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import sys
import zlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.mixing import line_position
from creditloom.sources.shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 1024
# Sequences per window.
WINDOW = 128
# Rows that leave Python at once.
BATCH_PIECES = 20_000


def load_vocabulary(ranks_path: str, pattern: str, tokenizer_path: str):
    """An encoder over a file of byte-pair ranks; it gives the ids of the matching tokenizer file.

    Added tokens of the tokenizer file, ``<|endoftext|>`` say, are found in texts as it finds them.
    """
    import json

    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    with open(tokenizer_path, encoding="utf-8") as file:
        listed = json.load(file).get("added_tokens") or []
    for token in listed:
        if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
            raise ValueError(f"added token {token['content']!r} takes more than its own text")
    added = {token["content"]: token["id"] for token in listed}
    return tiktoken.Encoding(
        "vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added
    )


def token_ids(encoder, text: str) -> np.ndarray:
    return encoder.encode_to_numpy(text, allowed_special="all")


def cuts(tokens: int, length: int) -> Iterator[tuple[int, int]]:
    """(start, size) of the pieces of a document: full sequences, then falling powers of two."""
    start = 0
    while tokens - start >= length:
        yield start, length
        start += length
    while start < tokens:
        size = 1 << ((tokens - start).bit_length() - 1)
        yield start, size
        start += size


PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids_crc32 bigint,"
    " doc_tokens bigint"
)


def token_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    tokenizer_path: str,
    end_id: int = 0,
    length: int = LENGTH,
) -> DataFrame:
    """Columns ``PIECES``, a row per piece; checksums are over little-endian 32-bit ids."""
    names = [field.split()[0] for field in PIECES.split(", ")]

    def batch_of(columns: list[list]) -> pa.RecordBatch:
        kinds = [pa.string() if name == "source" else pa.int64() for name in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
        )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_vocabulary(ranks_path, pattern, tokenizer_path)
        columns: list[list] = [[] for _ in names]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for doc_id, source, text in rows:
                found = token_ids(encoder, text.as_py() or "")
                ids = np.append(found, end_id).astype("<u4")
                data = memoryview(ids.tobytes())
                for start, size in cuts(len(ids), length):
                    crc = zlib.crc32(data[4 * start : 4 * (start + size)])
                    row = (doc_id, source, start, size, crc, len(ids))
                    for column, value in zip(columns, row):
                        column.append(value)
                if len(columns[0]) >= BATCH_PIECES:
                    yield batch_of(columns)
                    columns = [[] for _ in names]
        yield batch_of(columns)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text").mapInArrow(
        read, PIECES
    )


def clocks(stock: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """``(_source, stock, weight, phases)`` per source: what all have given at a clock time.

    ``phases`` are ``(until, base, rate)`` in order: up to clock ``until`` the sources have given
    ``base + rate * clock`` tokens. They end when the source itself runs out. A source that ``weights``
    does not name has weight 1.
    """
    weight = F.col("stock").cast("double")
    if weights is not None:
        if not all(0 < value < float("inf") for value in weights.values()):
            raise ValueError("weights are positive numbers")
        weight = F.lit(1.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    timed = stock.withColumn("weight", weight).withColumn("until", F.col("stock") / F.col("weight"))
    by_end = Window.orderBy("until", F.asc_nulls_last("source"))
    before = F.sum("stock").over(by_end.rowsBetween(Window.unboundedPreceding, -1))
    phase = timed.withColumns(
        {
            "base": F.coalesce(before, F.lit(0)).cast("double"),
            "rate": F.sum("weight").over(by_end.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    own = F.collect_list(F.struct("until", "base", "rate")).over(
        by_end.rowsBetween(Window.unboundedPreceding, 0)
    )
    return phase.select(F.col("source").alias("_source"), "stock", "weight", own.alias("phases"))


def packed(
    pieces: DataFrame,
    length: int = LENGTH,
    window: int = WINDOW,
    weights: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """``pieces`` with ``(window, sequence_id, offset)``; ``length`` is a power of two.

    ``sequence_id`` tells the window in its upper half and the sequence within it in the lower.
    ``weights`` are the sources' target proportions, see above; by default those of their stocks.
    """
    text_id = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    spread = F.conv(F.substring(text_id, 1, 15), 16, 10).cast("bigint")
    rows = written(pieces.withColumn("spread", spread), "pieces")
    order = ["doc_id", "doc_tokens", "start"]
    placed = line_position(rows, ["source"], "length", order)
    stock = rows.groupBy("source").agg(F.sum("length").alias("stock"))
    total = stock.agg(F.coalesce(F.sum("stock"), F.lit(0))).first()[0]
    windows = max(1, -(-total // (window * length)))
    queue = placed.join(
        clocks(stock, weights), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    clock = F.col("line") / F.col("weight")
    now = F.get(F.filter("phases", lambda phase: phase["until"] >= F.col("clock")), 0)
    given = F.col("now.base") + F.col("now.rate") * F.col("clock")
    queue = queue.withColumn("clock", clock).withColumn("now", now)
    # All windows hold equally many tokens.
    filled = F.floor(given * (windows / max(total, 1))).cast("bigint")
    if weights is None:
        # So does each source's share of them, in whole numbers: no rounding at a window's end.
        whole = "decimal(18,0)"
        filled = F.call_function(
            "div", F.col("line").cast(whole) * F.lit(windows).cast(whole), F.col("stock").cast(whole)
        )
    queue = queue.withColumn("window", F.least(filled, F.lit(windows - 1))).drop(
        "clock", "now", "phases", "weight", "stock"
    )

    line = Window.partitionBy("window").orderBy(F.desc("length"), "spread", *order)
    before = F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, -1))
    laid = queue.withColumns(
        {
            "at": F.coalesce(before, F.lit(0).cast("bigint")),
            "size": F.sum("length").over(Window.partitionBy("window")),
        }
    )
    index, offset = _sequence(F.col("at"), F.col("size"), length)
    number = F.shiftleft(F.col("window"), 32) + index
    names = [c for c in pieces.columns]
    return laid.select(*names, "window", number.alias("sequence_id"), offset.alias("offset"))


def _sequence(at: Column, size: Column, length: int) -> tuple[Column, Column]:
    """Which sequence of a window of ``size`` tokens holds place ``at``, and where in it."""
    bits = length.bit_length() - 1
    full = F.shiftright(size, bits)
    index, offset = F.shiftright(at, bits), at.bitwiseAND(F.lit(length - 1).cast("bigint"))
    # The rest holds a sequence per set bit of its size, the largest first.
    rest = size.bitwiseAND(F.lit(length - 1).cast("bigint"))
    place = at - F.shiftleft(full, bits)
    for bit in range(bits):
        start = F.shiftleft(F.shiftright(rest, bit + 1), bit + 1)
        end = F.shiftleft(F.shiftright(rest, bit), bit)
        here = (place >= start) & (place < end)
        index = F.when(here, full + F.bit_count(F.shiftright(rest, bit)) - 1).otherwise(index)
        offset = F.when(here, place - start).otherwise(offset)
    return index, offset


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    tokenizer_path: str,
    end_id: int = 0,
    length: int = LENGTH,
    window: int = WINDOW,
    weights: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """All documents, packed: ``PIECES`` and ``(window, sequence_id, offset)``."""
    pieces = token_pieces(docs, ranks_path, pattern, tokenizer_path, end_id, length)
    return packed(pieces, length, window, weights)
