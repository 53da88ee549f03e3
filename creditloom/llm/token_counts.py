"""Token counts of texts by rank-synchronous merging of byte pairs.

1. A text is cut at the added tokens of the tokenizer file, which count one each, and the rest into
   pre-tokens by the byte-level splitting pattern.
2. The distinct pre-tokens of about ``PART_BYTES`` of text are laid end to end as one array of symbols,
   a symbol per byte, with the sequence each belongs to. The ranks of all neighbouring pairs lie beside
   it.
3. In every round each sequence finds its lowest rank, and all pairs of that rank merge at once, from the
   left where they overlap. Only pairs next to a merge get a new rank; a sequence without a ranked
   pair leaves the arrays. What survives of a sequence is its number of tokens.
4. A text has the tokens of its pre-tokens and its added tokens.

All of a rank may merge at once because no merge makes a pair of the same or a lower rank; a table in which
a merge comes before the merges of its parts is refused, and so is a file with a normaliser, dropout,
unknown or affixed symbols, or another way of splitting.

The work is one narrow pass: no shuffle, nothing is collected, and a task holds one part of texts at a
time and the table of merges, whose size is the file's.

Null and empty texts have no tokens and no bytes. A text that is longer than a part is a part of its own;
one pre-token of n symbols takes as many rounds as it has distinct ranks to merge. Rows that repeat come
back each, null ids stay null, an empty table gives an empty result, and other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts are read in parts of about this size.
PART_BYTES = 4 << 20
# The rank of a pair that never merges.
NEVER = np.iinfo(np.int32).max
# Letters and digits that this module's Unicode tables have and the tokenizer library's
# do not. A test compares all code points.
NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD"
    r"\uA7E2\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7"
    r"\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1"
    r"\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8"
    r"\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2"
    r"\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81"
    r"\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2"
    r"\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479"
    r"\U0003D000-\U0003FC3F"
)
LETTER, DIGIT = rf"[\p{{L}}--[{NEWER}]]", rf"[\p{{N}}--[{NEWER}]]"
# How byte-level tokenizers split a text.
PATTERN = (
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{LETTER}+| ?{DIGIT}+"
    rf"| ?[[^\s\p{{L}}\p{{N}}]||[{NEWER}]]+|\s+(?!\S)|\s+"
)


@dataclass(frozen=True)
class Merges:
    """A table of merges: ``keys`` are the sorted pairs, ``made`` the symbol a rank makes."""

    first: np.ndarray  # the symbol of each byte
    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    added: tuple[str, ...]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << np.int64(32)) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER).astype(np.int32)


def byte_symbols() -> list[str]:
    """The sign that stands for each byte in the file: itself if printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


def read_merges(path: str) -> Merges:
    """The merges and added tokens of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, split = found["model"], found.get("pre_tokenizer") or {}
    odd = [
        name
        for name in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
            "byte_fallback", "ignore_merges",
        )
        if model.get(name)
    ]
    plain = {"type": "ByteLevel", "add_prefix_space": False}
    if (
        odd
        or model.get("type") != "BPE"
        or found.get("normalizer")
        or any(split.get(name) != value for name, value in plain.items())
        or not split.get("use_regex", True)
    ):
        raise ValueError(f"{path} is no plain byte-level table of merges {odd}")
    symbols = model["vocab"]
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    left = np.array([symbols[a] for a, _ in pairs], np.int64)
    right = np.array([symbols[b] for _, b in pairs], np.int64)
    made = np.array([symbols[a + b] for a, b in pairs], np.int64)
    ranks = np.arange(len(pairs))
    first = np.array([symbols[sign] for sign in byte_symbols()], np.int64)
    # A symbol is ready once the first merge that makes it is done.
    ready = np.full(max(symbols.values()) + 1, -1)
    np.maximum.at(ready, made, ranks)
    ready[first] = -1
    if len(np.unique(made)) < len(made) or (np.maximum(ready[left], ready[right]) >= ranks).any():
        raise ValueError(f"{path} has merges that come before those of their parts")
    key = (left << 32) | right
    order = np.argsort(key)
    added = []
    for token in found.get("added_tokens") or []:
        if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
            raise ValueError(f"added token {token['content']!r} takes more than its own text")
        added.append(token["content"])
    # Of tokens that begin at the same place the longest counts.
    longest_first = tuple(sorted(added, key=len, reverse=True))
    return Merges(first, key[order], order.astype(np.int32), made, longest_first)


def surviving_symbols(sequences: pa.Array, merges: Merges) -> np.ndarray:
    """The number of symbols left of each sequence (a text that is not null) after all merges."""
    column = sequences.cast(pa.large_string())
    _, at, data = column.buffers()
    n = len(column)
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    lengths = np.diff(ends)
    result = lengths.copy()
    if not n or ends[0] == ends[-1]:
        return result
    raw = np.frombuffer(data, np.uint8)[int(ends[0]) : int(ends[-1])]
    symbol = merges.first[raw]
    owner = np.repeat(np.arange(n), lengths)
    rank = np.full(len(symbol), NEVER, np.int32)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner] = merges.rank_of(symbol[inner], symbol[inner + 1])
    while len(symbol):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        done = lowest == NEVER
        if done.any():
            result[owner[starts[done]]] = sizes[done]
            keep = np.repeat(~done, sizes)
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(symbol):
                break
        chosen = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # Pairs that overlap are a run of one symbol: from the left, every other one merges.
        new_run = np.concatenate([[True], np.diff(chosen) > 1])
        place = np.arange(len(chosen))
        since = place - np.maximum.accumulate(np.where(new_run, place, 0))
        chosen = chosen[since % 2 == 0]
        symbol[chosen] = merges.made[rank[chosen]]
        stays = np.ones(len(symbol), bool)
        stays[chosen + 1] = False
        moved = np.cumsum(stays) - 1
        symbol, owner, rank = symbol[stays], owner[stays], rank[stays]
        here = moved[chosen]
        touched = np.zeros(len(symbol), bool)
        touched[here] = touched[here[here > 0] - 1] = True
        asked = np.flatnonzero(touched)
        rank[asked] = NEVER
        asked = asked[asked + 1 < len(symbol)]
        asked = asked[owner[asked] == owner[asked + 1]]
        rank[asked] = merges.rank_of(symbol[asked], symbol[asked + 1])
    return result


def counts_of(texts: pa.Array, merges: Merges, pattern: regex.Pattern) -> np.ndarray:
    """The number of tokens of each text; null texts have none."""
    marks = regex.compile("|".join(map(regex.escape, merges.added))) if merges.added else None
    found: list[str] = []
    ends, whole = np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts.to_pylist()):
        if text:
            if marks is None or not marks.search(text):
                found.extend(pattern.findall(text))
            else:
                for part in marks.split(text):
                    found.extend(pattern.findall(part))
                whole[at] = len(marks.findall(text))
        ends[at + 1] = len(found)
    if not found:
        return whole
    encoded = pa.array(found, pa.large_string()).dictionary_encode()
    sizes = surviving_symbols(encoded.dictionary, merges)
    sums = np.zeros(len(found) + 1, np.int64)
    np.cumsum(sizes[encoded.indices.to_numpy()], out=sums[1:])
    return whole + sums[ends[1:]] - sums[ends[:-1]]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, a row per row of ``docs``.

    ``tokenizer_path`` is a file that every executor has; ``over_limit`` tells more than ``limit`` tokens.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, pattern = read_merges(tokenizer_path), regex.compile(PATTERN)
        for batch in batches:
            texts = batch.column(1)
            for start, end in words.parts(texts, PART_BYTES):
                part = texts[start:end]
                counts = counts_of(part, merges, pattern)
                sizes = pa.compute.fill_null(pa.compute.binary_length(part), 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:end],
                        sizes.cast(pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(counts > limit),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        read, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
