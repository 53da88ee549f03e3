"""Phrase collocations: candidates that are Apriori-safe, counted by broadcast double-array tries.

1. Words are counted exactly. A phrase that occurs ``least`` times has only words, and only shorter
   phrases, that do: so level by level the phrases of two and of three words are hashed where everything
   shorter passed, and the hashes summed over all texts. A hash that reaches ``least`` sets a bit in a
   table of fixed size. Hashes and bits that coincide let a phrase too many through, never one too few.
   A task sends its hashes in blocks, one a bucket of hashes: sorted, as steps from one to the next, whose
   upper bytes are nearly all zero, with counts that stop at ``least``. There are as many buckets as the
   number of words calls for.
2. The phrases whose bit is set are the candidates. They are dealt by hash into tries of about ``TRIE``
   candidates. A trie is a double array: state s goes with digit d to ``base[s] + d`` if ``check`` there
   names s. A word is a number of two digits, so that the children of a state lie close together however
   many words there are. Each trie is built in a task of its own.
3. Up to ``TRIES_AT_ONCE`` tries are broadcast, and every task counts in its texts: the states of all word
   positions advance together, a level of the trie at a time, and the accepting states are counted by
   ``bincount``. The counts of all tasks are summed.
4. With more candidates than that, the phrases go to the tries and not the tries to the texts, so that
   the texts are read once however many candidates there are. A task sends the candidates of each part
   with their counts, a line each, to the bucket that their hash names; there is one for every
   ``DEALT_WORDS`` words of the table. A bucket adds up a table of hashes of its own, finer than the
   bits, builds the trie of what reaches ``least`` in it, and that trie counts the lines.
5. Counts of candidates and of words give the scores in exact decimals, the cut with the lowest score,
   and which candidates lie within a longer one.

Texts never move: shuffled are words, hashes and candidates, summed per part of a task first. A frequent
word or a common phrase is one row, or one line, a part. The bits (``WORD_BITS``, ``PHRASE_BITS``) and
``TRIES_AT_ONCE`` tries are all that goes through the driver.

A null text is empty, a null lang ``und``, and both together count with ``und``. Rows that repeat count
again; ids are not read. Equal scores go by count and then by the phrase, so ranks are the same in every
run. A text longer than ``PART_BYTES`` is a part of its own. Without texts, or without candidates, the
result is empty. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import pickle
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm import words
from creditloom.sources.shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts of about this size are counted together.
PART_BYTES = 8 << 20
# Bits of the tables of hashes that reach the least count: 2 MB and 16 MB.
WORD_BITS, PHRASE_BITS = 24, 27
# Bits of a hash that are summed by, in whole bytes; the tables take the upper ones of these.
SENT_BITS = 40
# Hashes that a task holds before it sends them, and the words of the table for each bucket of hashes.
HELD, BUCKET_WORDS = 1 << 20, 1 << 19
# Candidates of a trie, and the tries that are broadcast at once.
TRIE, TRIES_AT_ONCE = 1 << 18, 4
# Beyond these, the words of the table for each bucket of phrases, and the places of a bucket's own table.
DEALT_WORDS, PLACES = 1 << 20, 1 << 21
# Places tried for the children of a state before they go to the end of the array.
TRIALS, TRIED = 6, 128
# What ends a piece, and what ends a word within one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"


@dataclass
class Words:
    """The words of some texts of one lang: ``codes`` into ``distinct``, in order.

    ``joined[i]`` tells that the words i and i + 1 are in one piece.
    """

    lang: str
    distinct: pa.Array
    codes: np.ndarray
    joined: np.ndarray

    def hashes(self) -> np.ndarray:
        return words.mix(string_hashes(self.distinct) ^ string_hashes(pa.array([self.lang])))


def string_hashes(strings: pa.Array) -> np.ndarray:
    column = strings.cast(pa.large_string())
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(ends).astype(np.uint64)
    size = int(ends[-1] - ends[0]) if len(column) else 0
    if not size:
        return words.mix(lengths)
    raw = np.frombuffer(data, np.uint8)[int(ends[0]) : int(ends[-1])]
    ends = ends - ends[0]
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * words.powers(words.BASE, size), out=sums[1:])
    scale = np.append(words.powers(words.INVERSE, size), np.uint64(0))
    return words.mix((sums[ends[1:]] - sums[ends[:-1]]) * scale[ends[:-1]] + lengths)


def words_of(lang: str, texts: pa.Array) -> Words | None:
    """The words of texts that are not null; None without any."""
    column = texts.cast(pa.large_string())
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(ends[-1] - ends[0])
    if not size:
        return None
    raw = np.frombuffer(data, np.uint8)[int(ends[0]) : int(ends[-1])]
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[list(WORD_ENDS)], kind[list(PIECE_ENDS)] = 1, 2
    kinds = kind[lower]
    inside = kinds == 0
    # A text begins a new piece, and so a new word.
    begins = (ends[:-1] - ends[0])[np.diff(ends) > 0]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[begins] = inside[begins]
    last[begins[1:] - 1] = inside[begins[1:] - 1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return None
    marks = np.sort(np.concatenate([np.flatnonzero(kinds == 2), begins]))
    piece = np.searchsorted(marks, starts, side="right")
    # Without what lies between them words are one string after the other.
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=offsets[1:])
    data = [pa.py_buffer(offsets), pa.py_buffer(lower[inside])]
    del kinds, inside, first, last, lower
    encoded = pa.LargeStringArray.from_buffers(len(starts), *data)
    encoded = encoded.dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    return Words(lang, encoded.dictionary, codes, piece[1:] == piece[:-1])


def read_words(batches: Iterable[pa.RecordBatch]) -> Iterator[Words]:
    """The words of batches of ``(lang, text)``, by parts and lang."""
    for batch in batches:
        for start, end in words.parts(batch.column(1), PART_BYTES):
            langs = pc.dictionary_encode(pc.fill_null(batch.column(0)[start:end], "und"))
            texts = batch.column(1)[start:end]
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pc.equal(langs.indices, code)).drop_null()
                found = words_of(lang, own) if len(own) else None
                if found is not None:
                    yield found


def over_words(
    docs: DataFrame, rows: Callable[[Words], dict[str, pa.Array]], schema: str
) -> DataFrame:
    """The rows that a function makes of the words of each part."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in read_words(batches):
            yield pa.RecordBatch.from_pydict(rows(found))

    return docs.select("lang", "text").mapInArrow(read, schema)


def has_bit(table: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit that the upper bits of each hash name is set in a table of 2**k bits."""
    bytes_of = np.frombuffer(table, np.uint8)
    place = hashes >> np.uint64(64 - (len(bytes_of).bit_length() + 2))
    byte = bytes_of[(place >> np.uint64(3)).astype(np.int64)]
    return (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def upper(hashes: np.ndarray) -> pa.Array:
    """The upper ``SENT_BITS`` bits of hashes, which is what is shuffled of them."""
    return pa.array((hashes >> np.uint64(64 - SENT_BITS)).astype(np.int64))


def bits_of(hashes: DataFrame, bits: int) -> bytes:
    """The table of 2**``bits`` bits of a column ``hash`` made by ``upper``; its size is fixed, whatever the
    rows."""
    place = F.shiftright("hash", SENT_BITS - bits) + 1
    runs = (
        hashes.select(F.bitmap_bucket_number(place).alias("run"), place.alias("place"))
        .groupBy("run")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    table = bytearray(1 << (bits - 3))
    for run, found in runs.collect():
        table[(run - 1) * 4096 : run * 4096] = found
    return bytes(table)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)``."""

    def rows(found: Words) -> dict[str, pa.Array]:
        n = len(found.distinct)
        return {
            "lang": pa.array([found.lang] * n, pa.string()),
            "word": found.distinct.cast(pa.string()),
            "n": pa.array(np.bincount(found.codes, minlength=n).astype(np.int64)),
        }

    counted = over_words(docs, rows, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_hashes(counted: DataFrame) -> DataFrame:
    """``(hash)``: those of ``(lang, word)``, as ``Words.hashes`` has them."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mixed = string_hashes(batch.column(1)) ^ string_hashes(batch.column(0))
            yield pa.RecordBatch.from_pydict({"hash": upper(words.mix(mixed))})

    return counted.select("lang", "word").mapInArrow(read, "hash bigint")


@dataclass
class Phrases:
    """The distinct phrases of a part: codes of their words, hashes, and how often they occur."""

    codes: list[np.ndarray]
    hashes: np.ndarray
    n: np.ndarray


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return words.mix(first * np.uint64(words.BASE) + second, 1)


def triple_hashes(pair: np.ndarray, third: np.ndarray) -> np.ndarray:
    return words.mix(pair * np.uint64(words.BASE) + third, 2)


def phrases_of(found: Words, word_bits: bytes, pair_bits: bytes | None) -> Iterator[Phrases]:
    """Pairs of frequent words, and with ``pair_bits`` triples both of whose pairs have their bit."""
    hashes, codes = found.hashes(), found.codes
    frequent = has_bit(word_bits, hashes)[codes]
    at = np.flatnonzero(found.joined & frequent[:-1] & frequent[1:])
    size = np.int64(len(found.distinct))
    pairs, which, n = np.unique(
        codes[at] * size + codes[at + 1], return_inverse=True, return_counts=True
    )
    first, second = pairs // size, pairs % size
    pair_hash = pair_hashes(hashes[first], hashes[second])
    yield Phrases([first, second], pair_hash, n)
    if pair_bits is None:
        return
    # The pair that begins at a word, if it passed.
    pair_at = np.full(len(codes), -1)
    passed = has_bit(pair_bits, pair_hash)[which]
    pair_at[at[passed]] = which[passed]
    start = np.flatnonzero((pair_at[:-1] >= 0) & (pair_at[1:] >= 0))
    triples, n = np.unique(pair_at[start] * size + codes[start + 2], return_counts=True)
    pair, third = triples // size, triples % size
    value = triple_hashes(pair_hash[pair], hashes[third])
    yield Phrases([first[pair], second[pair], third], value, n)


def summed(hashes: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and the sums of their counts, none of them above ``least``."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return hashes[first], np.minimum(sums, least).astype(np.min_scalar_type(least))


BLOCK = "bucket bigint, steps binary, n binary"


def blocks(hashes: np.ndarray, n: np.ndarray, bits: int) -> pa.RecordBatch:
    """Columns ``BLOCK`` of sorted hashes; the upper ``bits`` of ``SENT_BITS`` name the bucket."""
    buckets, starts = np.unique(hashes >> np.uint64(SENT_BITS - bits), return_index=True)
    steps = np.diff(hashes, prepend=np.uint64(0))
    steps[starts] = hashes[starts]
    places = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : SENT_BITS // 8]
    spans = list(zip(starts, [*starts[1:], len(hashes)]))
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(buckets.astype(np.int64)),
            # All lowest bytes first, the highest last.
            "steps": pa.array([places[i:j].T.tobytes() for i, j in spans], pa.binary()),
            "n": pa.array([n[i:j].tobytes() for i, j in spans], pa.binary()),
        }
    )


def hashes_of(steps: bytes) -> np.ndarray:
    """The hashes of a block."""
    places = np.frombuffer(steps, np.uint8).reshape(SENT_BITS // 8, -1)
    whole = np.zeros((places.shape[1], 8), np.uint8)
    whole[:, : SENT_BITS // 8] = places.T
    return np.cumsum(whole.view("<u8").ravel(), dtype=np.uint64)


def frequent_bits(docs: DataFrame, least: int, n_words: int, word_bits, pair_bits=None) -> bytes:
    """The bits of the hashes of pairs, or with ``pair_bits`` triples, that sum up to ``least``."""
    bits = min((n_words // BUCKET_WORDS).bit_length(), SENT_BITS)
    kind = np.min_scalar_type(least)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n = np.zeros(0, np.uint64), np.zeros(0, kind)
        for found in read_words(batches):
            *_, longest = phrases_of(found, word_bits.value, pair_bits and pair_bits.value)
            sent = longest.hashes >> np.uint64(64 - SENT_BITS)
            counts = np.minimum(longest.n, least).astype(kind)
            del found, longest
            hashes, n = summed(np.append(hashes, sent), np.append(n, counts), least)
            if len(hashes) >= HELD:
                yield blocks(hashes, n, bits)
                hashes, n = hashes[:0], n[:0]
        yield blocks(hashes, n, bits)

    def frequent(group: pa.Table) -> pa.Table:
        hashes = np.concatenate([hashes_of(steps) for steps in group["steps"].to_pylist()])
        n = np.concatenate([np.frombuffer(counts, kind) for counts in group["n"].to_pylist()])
        hashes, n = summed(hashes, n, least)
        return pa.table({"hash": pa.array(hashes[n >= least].astype(np.int64))})

    sent = docs.select("lang", "text").mapInArrow(read, BLOCK)
    return bits_of(sent.groupBy("bucket").applyInArrow(frequent, "hash bigint"), PHRASE_BITS)


CANDIDATE = "lang string, w1 string, w2 string, w3 string"


def candidates(docs: DataFrame, word_bits, pair_bits, triple_bits) -> DataFrame:
    """Columns ``CANDIDATE``: the phrases that may be frequent; ``w3`` is null in pairs."""

    def rows(found: Words) -> dict[str, pa.Array]:
        columns: dict[str, list] = {name: [] for name in ("w1", "w2", "w3")}
        levels = zip(
            phrases_of(found, word_bits.value, pair_bits.value),
            (pair_bits.value, triple_bits.value),
        )
        for phrases, bits in levels:
            keep = has_bit(bits, phrases.hashes)
            for name, codes in zip(columns, phrases.codes):
                columns[name].append(found.distinct.take(pa.array(codes[keep])).cast(pa.string()))
            if len(phrases.codes) == 2:
                columns["w3"].append(pa.nulls(int(keep.sum()), pa.string()))
        chunks = {name: pa.concat_arrays(parts) for name, parts in columns.items()}
        return {"lang": pa.array([found.lang] * len(chunks["w1"]), pa.string())} | chunks

    return over_words(docs, rows, CANDIDATE).distinct()


LINES = "bucket bigint, lang string, phrases string, n binary"


def lines_of(found: Words, kept: list[Phrases], buckets: int) -> pa.RecordBatch:
    """Columns ``LINES`` of phrases of a part: per bucket a line each, and how often it occurs there."""
    # Pairs have no third word.
    thirds = [p.codes[2] if len(p.codes) == 3 else np.full(len(p.n), -1) for p in kept]
    codes = [np.concatenate(part) for part in zip(*[p.codes[:2] for p in kept])] + [np.concatenate(thirds)]
    # Other bits of the hash than those that the tables take.
    lower = np.concatenate([p.hashes for p in kept]) & np.uint64(0xFFFFFFFF)
    bucket = (lower * np.uint64(buckets) >> np.uint64(32)).astype(np.min_scalar_type(buckets))
    order = np.argsort(bucket, kind="stable")
    buckets_of, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts, len(order))
    columns = [found.distinct.take(pa.array(c, mask=c < 0)) for c in (part[order] for part in codes)]
    space, line_feed = (pa.scalar(mark, pa.large_string()) for mark in " \n")
    joined = pc.binary_join_element_wise(*columns, space, null_handling="skip")
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), joined), line_feed)
    n = np.concatenate([p.n for p in kept])[order]
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(buckets_of.astype(np.int64)),
            "lang": pa.array([found.lang] * len(starts), pa.string()),
            "phrases": lines.cast(pa.string()),
            "n": pa.array([planes(n[i:j]) for i, j in zip(ends, ends[1:])], pa.binary()),
        }
    )


def planes(n: np.ndarray) -> bytes:
    """Counts within a part as all lowest bytes first, the highest last."""
    return n.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def counts_of(n: bytes) -> np.ndarray:
    return np.frombuffer(n, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


@dataclass
class Lines:
    """Phrases of one lang, one a line: codes of their words, -1 for a third that is not, and counts."""

    words: Words
    codes: list[np.ndarray]
    n: np.ndarray

    def hashes(self) -> np.ndarray:
        own = self.words.hashes()
        first, second, third = self.codes
        value = pair_hashes(own[first], own[second])
        long = np.flatnonzero(third >= 0)
        value[long] = triple_hashes(value[long], own[third[long]])
        return value

    def only(self, keep: np.ndarray) -> Lines:
        return Lines(self.words, [codes[keep] for codes in self.codes], self.n[keep])


def read_lines(lang: str, group: pa.Table) -> Lines:
    """The lines of rows ``LINES`` of one lang."""
    found = words_of(lang, group["phrases"].combine_chunks())
    n = np.concatenate([counts_of(n) for n in group["n"].to_pylist()]).astype(np.int64)
    first = np.flatnonzero(np.append(True, ~found.joined))
    size = np.diff(np.append(first, len(found.codes)))
    third = np.full(len(first), -1)
    third[size == 3] = found.codes[first[size == 3] + 2]
    return Lines(found, [found.codes[first], found.codes[first + 1], third], n)


class DoubleArray:
    """Transitions of a trie: from ``state`` with ``symbol`` to ``base[state] + symbol``.

    A state gets all its transitions at once. ``symbols`` is how many different ones there are.
    """

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.base = np.zeros(0, np.int64)
        self.check = np.zeros(0, np.int32)
        self.free = np.zeros(0, bool)
        self.end = 1
        self._grow(4 * symbols + 1024)
        # The root is state 0.
        self.free[0] = False

    def _grow(self, size: int) -> None:
        more = size - len(self.free)
        self.base = np.append(self.base, np.zeros(more, np.int64))
        self.check = np.append(self.check, np.full(more, -1, np.int32))
        self.free = np.append(self.free, np.ones(more, bool))

    def add(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Transitions, sorted by state and symbol, of states without any so far; the new states."""
        reached = np.zeros(len(states), np.int64)
        if not len(states):
            return reached
        starts = np.flatnonzero(np.concatenate([[True], states[1:] != states[:-1]]))
        sizes = np.diff(np.append(starts, len(states)))
        low = 0
        # The widest first; an only child fits anywhere.
        for group in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            start, size = starts[group], sizes[group]
            own = symbols[start : start + size]
            while low < self.end and not self.free[low]:
                low += 1
            base = self._place(own, low)
            self._take(base + own, states[start], base)
            reached[start : start + size] = base + own
        single = starts[sizes == 1]
        if len(single):
            if len(self.free) < self.end + len(single):
                self._grow(2 * (self.end + len(single)))
            slots = np.flatnonzero(self.free[: self.end + len(single)])[: len(single)]
            self.base[states[single]] = slots - symbols[single]
            self.check[slots], self.free[slots] = states[single], False
            self.end = max(self.end, int(slots[-1]) + 1)
            reached[single] = slots
        return reached

    def _place(self, own: np.ndarray, low: int) -> int:
        span = int(own[-1] - own[0]) + 1
        if len(self.free) < self.end + span:
            self._grow(2 * (self.end + span))
        for _ in range(TRIALS):
            slots = np.flatnonzero(self.free[low : min(low + 64 * TRIED, self.end)])[:TRIED] + low
            if not len(slots):
                break
            fits = self.free[(slots - own[0])[:, None] + own].all(axis=1)
            if fits.any():
                return int(slots[fits.argmax()] - own[0])
            low = int(slots[-1]) + 1
        return int(self.end - own[0])

    def _take(self, slots: np.ndarray, state: int, base: int) -> None:
        self.base[state] = base
        self.check[slots], self.free[slots] = state, False
        self.end = max(self.end, int(slots[-1]) + 1)


@dataclass
class Trie:
    """A double array over the numbers of ``keys`` (word, lang, line feed), written in two digits of base
    ``radix``; ``accepts`` numbers phrases."""

    keys: pa.Array
    base: np.ndarray
    check: np.ndarray
    accepts: np.ndarray
    size: int
    radix: int

    def move(self, states: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none; states and digits below 0 have none."""
        to = self.base[states] + digits
        ok = (states >= 0) & (digits >= 0) & (to >= 0) & (to < len(self.check))
        to = np.where(ok, to, 0)
        return np.where(ok & (self.check[to] == states), to, -1)

    def step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The states after a whole word; numbers below 0 are words that no phrase has."""
        high, low = words // self.radix, words % self.radix
        return self.move(self.move(states, high), np.where(words < 0, -1, low))

    def numbers(self, found: Words) -> np.ndarray:
        """The numbers of the distinct words."""
        keys = pc.binary_join_element_wise(
            pa.scalar(found.lang, pa.large_string()), found.distinct, pa.scalar("\n", pa.large_string())
        )
        return pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy().astype(np.int64)

    def firsts(self) -> np.ndarray:
        """The state after each word at the root, which is the same for every place of a word; last, -1."""
        numbers = np.arange(len(self.keys))
        return np.append(self.step(np.zeros(len(numbers), np.int64), numbers), -1)

    def counts(self, found: Words) -> np.ndarray:
        """How often each phrase occurs."""
        symbols = self.numbers(found)[found.codes]
        total = np.zeros(self.size, np.int64)
        states = self.firsts()[symbols]
        # Places whose next word is in the same piece and in some phrase.
        on = found.joined & (symbols[1:] >= 0)
        at = np.flatnonzero(on & (states[:-1] >= 0))
        states = states[at]
        for level in range(2):
            states = self.step(states, symbols[at + 1])
            reached = states >= 0
            accepted = self.accepts[states[reached]]
            total += np.bincount(accepted[accepted >= 0], minlength=self.size)
            if level == 0:
                at, states = at[reached] + 1, states[reached]
                more = (at < len(on)) & on[np.minimum(at, len(on) - 1)]
                at, states = at[more], states[more]
        return total

    def line_counts(self, lines: Lines) -> np.ndarray:
        """How often each phrase occurs in lines that are one phrase each, by the counts of the lines."""
        total = np.zeros(self.size, np.int64)
        w1, w2, w3 = (np.append(self.numbers(lines.words), -1)[codes] for codes in lines.codes)
        states = self.step(self.firsts()[w1], w2)
        # Lines of two words end here.
        long = np.flatnonzero(lines.codes[2] >= 0)
        states[long] = self.step(states[long], w3[long])
        accepted = np.where(states >= 0, self.accepts[states], -1)
        np.add.at(total, accepted[accepted >= 0], lines.n[accepted >= 0])
        return total


def build_trie(columns: list[pa.Array], lang: pa.Array) -> Trie:
    """The trie of phrases, which its accepting states number in the order given."""
    keyed = [
        pc.binary_join_element_wise(
            lang.cast(pa.large_string()), c.cast(pa.large_string()), pa.scalar("\n", pa.large_string())
        )
        for c in columns
    ]
    # Frequent words get small numbers, so that children lie close together.
    counted = pc.value_counts(pa.concat_arrays(keyed).drop_null())
    order = np.argsort(-counted.field("counts").to_numpy(), kind="stable")
    keys = counted.field("values").take(pa.array(order))
    w1, w2, w3 = (
        pc.fill_null(pc.index_in(c, value_set=keys), -1).to_numpy().astype(np.int64) for c in keyed
    )
    radix = math.isqrt(len(keys)) + 1
    array = DoubleArray(radix)

    def add_words(states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The state after each word, which may come any number of times after a state."""
        for digits in (words // radix, words % radix):
            edges, of_edge = np.unique(states * radix + digits, return_inverse=True)
            states = array.add(edges // radix, edges % radix)[of_edge]
        return states

    pair_states = add_words(add_words(np.zeros(len(w1), np.int64), w1), w2)
    long, short = np.flatnonzero(w3 >= 0), np.flatnonzero(w3 < 0)
    triple_states = add_words(pair_states[long], w3[long])
    accepts = np.full(array.end, -1, np.int32)
    accepts[pair_states[short]], accepts[triple_states] = short, long
    base, check = array.base[: array.end].astype(np.int32), array.check[: array.end]
    return Trie(keys, base, check, accepts, len(w1), radix)


def line_trie(lines: list[Lines]) -> tuple[Trie, pa.Table]:
    """The trie of the distinct phrases of lines, and these as columns ``CANDIDATE``."""
    tables = []
    for own in lines:
        first, second, third = own.codes
        pairs, of_line = np.unique(first * len(own.words.distinct) + second, return_inverse=True)
        # A pair goes before the triples that begin with it.
        size = len(own.words.distinct) + 1
        found = np.unique(of_line * size + third + 1)
        pair, third = pairs[found // size], found % size - 1
        codes = [pair // len(own.words.distinct), pair % len(own.words.distinct), third]
        columns = [own.words.distinct.take(pa.array(c, mask=c < 0)).cast(pa.string()) for c in codes]
        lang = pa.array([own.words.lang] * len(found), pa.string())
        tables.append(pa.table([lang, *columns], names=["lang", "w1", "w2", "w3"]))
    phrases = pa.concat_tables(tables).combine_chunks()
    columns = [phrases[name].combine_chunks() for name in ("w1", "w2", "w3")]
    return build_trie(columns, phrases["lang"].combine_chunks()), phrases


def packed(trie: Trie) -> bytes:
    """The trie as compressed bytes, of its parts: tasks know this module by value, so that its classes
    have no name to be found by."""
    return zlib.compress(pickle.dumps(tuple(vars(trie).values())), 1)


def unpacked(data: bytes) -> Trie:
    return Trie(*pickle.loads(zlib.decompress(data)))


def tries(found: DataFrame, n: int) -> DataFrame:
    """``(shard, place, CANDIDATE, trie)``: a row per phrase, and one per shard with its trie."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by([(name, "ascending") for name in ("w1", "w2", "w3", "lang")])
        columns = [group[name].combine_chunks() for name in ("w1", "w2", "w3")]
        trie = packed(build_trie(columns, group["lang"].combine_chunks()))
        rows = group.append_column("place", pa.array(range(group.num_rows), pa.int32()))
        rows = rows.append_column("trie", pa.nulls(group.num_rows, pa.binary()))
        whole = {name: None for name in rows.column_names}
        whole |= {"shard": group["shard"][0].as_py(), "place": -1, "trie": trie}
        return pa.concat_tables([rows, pa.Table.from_pylist([whole], rows.schema)])

    # A pair and the triples that begin with it share a shard.
    shard = F.pmod(F.xxhash64("lang", "w1", "w2"), F.lit(n)).cast("int").alias("shard")
    dealt = found.select(shard, *[field.split()[0] for field in CANDIDATE.split(", ")])
    return dealt.groupBy("shard").applyInArrow(
        build, f"shard int, {CANDIDATE}, place int, trie binary"
    )


def counted_phrases(docs: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """``(CANDIDATE, n)`` with the exact count of each of the candidates, by ``n`` tries."""
    spark = docs.sparkSession
    if not n:
        return spark.createDataFrame([], f"{CANDIDATE}, n bigint")
    built = written(tries(found, n), "tries")
    rows = built.where("place = -1").select("shard", "trie").collect()
    shipped = spark.sparkContext.broadcast([(row["shard"], bytes(row["trie"])) for row in rows])
    del rows
    counts = written(_sums(docs, shipped), "counts")
    shipped.destroy()
    phrases = built.where("place >= 0").drop("trie")
    return phrases.join(counts, ["shard", "place"]).select(
        *[field.split()[0] for field in CANDIDATE.split(", ")], "n"
    )


def _sums(docs: DataFrame, shipped) -> DataFrame:
    """``(shard, place, n)``: what the tries of a broadcast count in all texts."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(shard, unpacked(trie)) for shard, trie in shipped.value]
        totals = [np.zeros(trie.size, np.int64) for _, trie in held]
        for found in read_words(batches):
            for total, (_, trie) in zip(totals, held):
                total += trie.counts(found)
        for total, (shard, _) in zip(totals, held):
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(np.full(len(place), shard), pa.int32()),
                    "place": pa.array(place, pa.int32()),
                    "n": pa.array(total[place]),
                }
            )

    counted = docs.select("lang", "text").mapInArrow(read, "shard int, place int, n bigint")
    return counted.groupBy("shard", "place").agg(F.sum("n").alias("n"))


def dealt_phrases(
    docs: DataFrame, least: int, n_words: int, word_bits, pair_bits, triple_bits
) -> DataFrame:
    """``(CANDIDATE, n)`` with the exact count of each phrase that occurs ``least`` times."""
    buckets = min(n_words // DEALT_WORDS + 1, 1 << 31)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in read_words(batches):
            kept = []
            levels = zip(
                phrases_of(found, word_bits.value, pair_bits.value),
                (pair_bits.value, triple_bits.value),
            )
            for phrases, bits in levels:
                keep = np.flatnonzero(has_bit(bits, phrases.hashes))
                codes = [codes[keep] for codes in phrases.codes]
                kept.append(Phrases(codes, phrases.hashes[keep], phrases.n[keep]))
            if any(len(phrases.n) for phrases in kept):
                yield lines_of(found, kept, buckets)

    def counted(group: pa.Table) -> pa.Table:
        lines = [
            read_lines(lang, group.filter(pc.equal(group["lang"], lang)))
            for lang in group["lang"].unique().to_pylist()
        ]
        # Hashes that coincide let a phrase too many through, never one too few.
        places = [(words.mix(own.hashes(), 3) % np.uint64(PLACES)).astype(np.int64) for own in lines]
        sums = np.zeros(PLACES, np.int64)
        for own, place in zip(lines, places):
            np.add.at(sums, place, own.n)
        lines = [own.only(np.flatnonzero(sums[at] >= least)) for own, at in zip(lines, places)]
        trie, phrases = line_trie(lines)
        n = np.zeros(trie.size, np.int64)
        for own in lines:
            n += trie.line_counts(own)
        enough = np.flatnonzero(n >= least)
        return phrases.take(pa.array(enough)).append_column("n", pa.array(n[enough]))

    sent = docs.select("lang", "text").mapInArrow(read, LINES)
    return sent.groupBy("bucket").applyInArrow(counted, f"{CANDIDATE}, n bigint")


def score_of(a: Column, first: Column, rest: Column) -> Column:
    """floor(1000000 * a * a / (first * rest)), in decimals that hold the products."""
    whole = "decimal(15,0)"
    squared = F.lit(1_000_000).cast("decimal(7,0)") * (a.cast(whole) * a.cast(whole))
    parts = first.cast(whole) * rest.cast(whole)
    return F.call_function("div", squared, parts)


def scored(phrases: DataFrame, singles: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score, w1, w2, w3)``: each phrase with the cut of the lowest score."""
    named = phrases.select(
        "lang", "w1", "w2", "w3", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        F.col("n").alias("a"),
    )
    parts = singles.select("lang", F.col("word").alias("part"), "n").unionAll(
        named.where("w3 IS NULL").select("lang", F.col("phrase").alias("part"), F.col("a").alias("n"))
    )
    cut = lambda k, first, rest: F.struct(
        F.lit(k).alias("k"), first.alias("first"), rest.alias("rest")
    )
    pair = lambda a, b: F.concat_ws(" ", a, b)
    cuts = F.when(
        F.col("w3").isNull(), F.array(cut(1, F.col("w1"), F.col("w2")))
    ).otherwise(
        F.array(cut(1, F.col("w1"), pair("w2", "w3")), cut(2, pair("w1", "w2"), F.col("w3")))
    )
    rows = named.withColumn("cut", F.explode(cuts)).select(*named.columns, "cut.*")
    firsts = parts.select("lang", F.col("part").alias("first"), F.col("n").alias("l"))
    rests = parts.select("lang", F.col("part").alias("rest"), F.col("n").alias("r"))
    met = rows.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    lowest = F.min(F.struct(score_of(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    return (
        met.groupBy("lang", "phrase", "a", "w1", "w2", "w3")
        .agg(lowest.alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "w1", "w2", "w3")
    )


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each lang.

    Phrases have two or three words and occur ``least`` times. One that lies within a longer such phrase
    with at least ``share`` percent of its count is left out.
    """
    context = docs.sparkSession.sparkContext
    every = written(word_counts(docs), "words")
    single = every.where(F.col("n") >= least)
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    n_words = totals.agg(F.sum("total")).first()[0] or 0
    word_bits = context.broadcast(bits_of(word_hashes(single), WORD_BITS))
    pair_bits = context.broadcast(frequent_bits(docs, least, n_words, word_bits))
    triple_bits = context.broadcast(frequent_bits(docs, least, n_words, word_bits, pair_bits))
    tables = (word_bits, pair_bits, triple_bits)
    set_bits = sum(int.from_bytes(bits.value, "little").bit_count() for bits in tables[1:])
    found, n_tries = None, math.inf
    # Hashes that coincide set one bit, so the candidates themselves are counted as well.
    if set_bits <= TRIES_AT_ONCE * TRIE:
        found = written(candidates(docs, *tables), "candidates")
        n_tries = -(-found.count() // TRIE)
    phrases = None
    if n_tries > TRIES_AT_ONCE:
        phrases = written(dealt_phrases(docs, least, n_words, *tables), "phrases")
    for shipped in tables:
        shipped.destroy()
    del word_bits, pair_bits, triple_bits, tables, shipped
    if phrases is None:
        phrases = written(counted_phrases(docs, found, n_tries).where(F.col("n") >= least), "phrases")

    longer = phrases.where("w3 IS NOT NULL")
    within = longer.select("lang", F.col("w1").alias("w1"), F.col("w2").alias("w2"), "n").unionAll(
        longer.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n")
    )
    widest = within.groupBy("lang", "w1", "w2").agg(F.max("n").alias("longest"))
    ranked = scored(phrases, single)
    covered = ranked.where("w3 IS NULL").join(widest, ["lang", "w1", "w2"], "left")
    free = covered.where(
        F.coalesce(100 * F.col("longest") < share * F.col("a"), F.lit(True))
    ).unionByName(ranked.where("w3 IS NOT NULL"), allowMissingColumns=True)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    listed = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return listed.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score",
    )
