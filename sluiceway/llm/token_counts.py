"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a block of texts lie in one flat array of symbols. In each
round every pre-token finds its own lowest-ranked pair, and all of them merge all
occurrences of theirs at once; pre-tokens without a mergeable pair leave. A count is the
number of symbols that survive. Merging all occurrences at once equals merging the
leftmost first, because a pair that contains a new symbol always ranks after the pair
that made it.

Defined results: null and empty texts have 0 bytes and 0 tokens. A special string inside
a text is one token, as in the library's default. Texts of any length are counted whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import free_name

#: Text is handled in blocks of about so many characters, and a task remembers the counts
#: of so many pre-tokens at most. Neither changes a result.
BLOCK_CHARS = 4_000_000
REMEMBERED = 400_000
NEVER = np.int32(2**31 - 1)


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


@dataclass(frozen=True)
class Merges:
    """A byte-level vocabulary: first symbols, sorted pair keys, their ranks and results."""

    pattern: str
    special: tuple[str, ...]
    first: np.ndarray  # symbol of each byte
    keys: np.ndarray  # left * base + right, sorted
    ranks: np.ndarray
    results: np.ndarray  # by rank
    base: int

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Merges:
        """Read a ``.json`` vocabulary. Tens of thousands of entries, fixed by the file."""
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        kind = found["pre_tokenizer"]
        if found["model"]["type"] != "BPE" or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or found["normalizer"]:
            raise ValueError("only byte-level pair vocabularies without a prefix space or normalizer")
        if not kind.get("use_regex", True):
            raise ValueError("only vocabularies that split words by their own pattern")
        model = found["model"]
        if told := [name for name in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(name)]:
            raise ValueError(f"vocabularies with {told} would be counted wrongly")
        marks = ("single_word", "lstrip", "rstrip", "normalized")
        if told := [token["content"] for token in found["added_tokens"] if any(token.get(mark) for mark in marks)]:
            raise ValueError(f"added tokens {told} are matched by rules of their own")
        number, merges = found["model"]["vocab"], found["model"]["merges"]
        base = max(number.values()) + 1
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in merges]
        keys = np.array([number[a] * base + number[b] for a, b in pairs], np.int64)
        results = np.array([number[a + b] for a, b in pairs], np.int32)
        # Merging the lowest rank everywhere at once needs parts that are made before they are used.
        made = {number[a + b]: rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        if any(made.get(number[part], -1) >= rank for rank, pair in enumerate(pairs) for part in pair):
            raise ValueError("a pair ranks before the one that makes its part")
        first = np.zeros(256, np.int32)
        for character, byte in byte_symbols().items():
            first[byte] = number[character]
        order = np.argsort(keys)
        special = tuple(token["content"] for token in found["added_tokens"])
        return cls(pattern, special, first, keys[order], order.astype(np.int32), results, base)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)


def merge(words: Sequence[bytes], merges: Merges, ended: list | None = None, early: set | None = None) -> np.ndarray:
    """How many symbols each non-empty word ends with.

    ``ended`` receives the symbols, as arrays of owners and symbols. ``early`` receives the
    words in which a merge made a pair of lower rank than its own, for which merging all
    occurrences at once may differ from merging the leftmost first.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.empty(len(words), np.int64)
    symbols = merges.first[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.zeros(len(symbols), bool)
    ends[np.cumsum(lengths) - 1] = True
    rank = np.full(len(symbols), NEVER, np.int32)
    inner = np.flatnonzero(~ends)
    rank[inner] = merges.rank_of(symbols[inner], symbols[inner + 1])
    while len(symbols):
        starts = np.flatnonzero(np.concatenate(([True], ends[:-1])))
        sizes = np.diff(np.append(starts, len(symbols)))
        lowest = np.minimum.reduceat(rank, starts)
        active = lowest != NEVER
        if not active.all():
            counts[owner[starts[~active]]] = sizes[~active]
            stay = np.repeat(active, sizes)
            if ended is not None:
                ended.append((owner[~stay], symbols[~stay]))
            symbols, owner, ends, rank = symbols[stay], owner[stay], ends[stay], rank[stay]
            lowest, sizes = lowest[active], sizes[active]
            if not len(symbols):
                break
        own_lowest = np.repeat(lowest, sizes)
        hits = np.flatnonzero(rank == own_lowest)
        # Of hits side by side (the same symbol three times or more), every second one counts.
        fresh = np.concatenate(([True], np.diff(hits) != 1))
        if not fresh.all():
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
        symbols[hits] = merges.results[rank[hits]]
        ends[hits] = ends[hits + 1]
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        at = hits - np.arange(len(hits))
        symbols, owner, ends, rank = symbols[keep], owner[keep], ends[keep], rank[keep]
        rank[at] = NEVER
        again = np.concatenate((at[~ends[at]], at[at > 0] - 1))
        again = again[~ends[again]]
        rank[again] = merges.rank_of(symbols[again], symbols[again + 1])
        if early is not None:
            early.update(owner[again[rank[again] < own_lowest[keep][again]]].tolist())
    return counts


def count_block(texts: Sequence[str], merges: Merges, known: dict[str, int]) -> list[int]:
    """Tokens of each text; ``known`` remembers counts of pre-tokens."""
    if len(known) > REMEMBERED:
        known.clear()
    split = regex.compile(merges.pattern).findall
    cut = regex.compile("|".join(map(regex.escape, merges.special)) or r"(?!)")
    counts, found = [], []
    for text in texts:
        parts = cut.split(text)
        counts.append(len(parts) - 1)
        found.append([word for part in parts for word in split(part)] if len(parts) > 1 else split(text))
    new = list(set().union(*found).difference(known))
    if new:
        known.update(zip(new, merge([word.encode() for word in new], merges).tolist(), strict=True))
    return [count + sum(map(known.__getitem__, words)) for count, words in zip(counts, found, strict=True)]


def blocks(texts: Sequence[str], chars: int = BLOCK_CHARS) -> Iterator[Sequence[str]]:
    """Consecutive runs of texts of about so many characters; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


def token_counts(
    docs: DataFrame, merges: Merges, *, text: str = "text", limit: int = 512, into: str = "tokens",
) -> DataFrame:
    """``docs`` with a struct column ``into`` of ``n_bytes``, ``n_tokens``, ``over_limit``.

    The name gets underscores until it is free. Texts are counted where they are read.
    """

    @F.pandas_udf("n_bytes long, n_tokens long, over_limit boolean")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            texts = [one or "" for one in batch]
            found = np.array([n for block in blocks(texts) for n in count_block(block, merges, known)], np.int64)
            sizes = np.array([len(one.encode()) for one in texts], np.int64)
            yield pd.DataFrame({"n_bytes": sizes, "n_tokens": found, "over_limit": found > limit})

    return docs.withColumn(free_name(docs.columns, into), counted.asNondeterministic()(F.col(text).cast("string")))
