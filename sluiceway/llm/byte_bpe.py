"""Byte-level pair encoding and decoding.

``encode_folded`` encodes with Spark's higher-order functions alone. The rank map is a
literal: an array of small maps, addressed by a checksum of a piece, so that a lookup
passes over a handful of entries. The distinct words of a document are taken apart into
bytes, written in hexadecimal, and a fold merges the lowest-ranked pair of neighbours,
once per step, until no pair has a rank. Ids are put back in the order of the words.

``encode`` gives the same ids for large inputs, as the fold costs some 70 microseconds a
word (figures in the README): the distinct words of a block of texts are merged as flat
arrays, all at once, by the same ranks.

``decode`` looks every id up in a literal array and concatenates the binary pieces, with
higher-order functions.

Defined results: null and empty texts have no tokens and decode to no bytes. Special
strings are ordinary text. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import free_name, text_of
from sluiceway.llm.token_counts import Merges, merge

NO_RANK = 2**31 - 1
BUCKETS = 16384
#: Characters that are encoded at once; changes no result.
BLOCK_CHARS = 500_000

# Fixed value: characters with the Unicode property White_Space, as a Java character class.
SPACES = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 piece and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def java_pattern(pattern: str) -> str:
    r"""``pattern`` with ``\s`` and ``\S`` spelled out, as Java's know ASCII only."""
    inside = pattern.replace("[^\\s", f"[^{SPACES}")
    return inside.replace("\\s", f"[{SPACES}]").replace("\\S", f"[^{SPACES}]")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """Array of maps from hexadecimal pieces to ranks; a constant after optimisation."""
    held: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        word = piece.hex()
        held[zlib.crc32(word.encode()) % BUCKETS][word] = rank
    return F.from_json(F.lit(json.dumps(held)), "array<map<string,int>>")


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """Hexadecimal pieces by id; a constant after optimisation."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    return F.split(F.lit(",".join(pieces)), ",")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of one non-empty word."""

    def rank(piece: Column) -> Column:
        held = F.get(table, F.pmod(F.crc32(piece.cast("binary")), F.lit(BUCKETS)).cast("int"))
        return F.coalesce(F.try_element_at(held, piece), F.lit(NO_RANK))

    def step(state: Column, _: Column) -> Column:
        pieces, ranks = state["pieces"], state["ranks"]

        def merged(at: Column) -> Column:
            def updated(new: Column) -> Column:
                left = F.when(at > 0, F.concat(
                    F.slice(ranks, F.lit(1), at - 1), F.array(rank(F.concat(F.get(pieces, at - 1), new)))
                )).otherwise(F.slice(ranks, 1, 0))
                right = F.when(at + 2 < F.size(pieces), rank(F.concat(new, F.get(pieces, at + 2)))).otherwise(F.lit(NO_RANK))
                return F.struct(
                    F.concat(F.slice(pieces, F.lit(1), at), F.array(new), F.slice(pieces, at + 3, F.size(pieces))).alias("pieces"),
                    F.concat(left, F.array(right), F.slice(ranks, at + 3, F.size(ranks))).alias("ranks"))

            return let(F.concat(F.get(pieces, at), F.get(pieces, at + 1)), updated)

        return let(F.array_min(ranks), lambda low: F.when(
            low < NO_RANK, let((F.array_position(ranks, low) - 1).cast("int"), merged)).otherwise(state))

    def folded(code: Column) -> Column:
        n = (F.length(code) / 2).cast("int")
        pieces = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(code, 2 * i - 1, F.lit(2)))
        ranks = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
            i < n, rank(F.substring(code, 2 * i - 1, F.lit(4)))).otherwise(F.lit(NO_RANK)))
        start = F.struct(pieces.alias("pieces"), ranks.alias("ranks"))
        return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda state: F.transform(state["pieces"], rank))

    # A word that is a piece itself needs no merge.
    return let(F.lower(F.hex(word.cast("binary"))), lambda code: let(rank(code), lambda whole: F.when(
        whole < NO_RANK, F.array(whole)).otherwise(folded(code))))


def encode_folded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text; the name gets underscores until it is free."""
    table = rank_literal(ranks)
    words = F.regexp_extract_all(text_of(text), F.lit(java_pattern(pattern)), F.lit(0))
    ids = let(words, lambda all_words: let(F.array_distinct(all_words), lambda distinct: let(
        F.map_from_arrays(distinct, F.transform(distinct, lambda word: fold_merges(word, table))),
        lambda coded: F.flatten(F.transform(all_words, lambda word: F.element_at(coded, word))))))
    return docs.withColumn(free_name(docs.columns, into), ids)


def merges_of(ranks: dict[bytes, int], pattern: str) -> Merges:
    """Every pair of pieces whose concatenation is a piece, ranked as that piece."""
    found = [
        (ranks[piece[:cut]], ranks[piece[cut:]], rank)
        for piece, rank in ranks.items() for cut in range(1, len(piece))
        if piece[:cut] in ranks and piece[cut:] in ranks
    ]
    left, right, result = np.array(found, np.int64).T
    base = max(ranks.values()) + 1
    keys = left * base + right
    order = np.argsort(keys)
    first = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
    return Merges(pattern, (), first, keys[order], result[order].astype(np.int32), np.arange(base, dtype=np.int32), base)


def leftmost_first(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word, one merge at a time."""
    pieces = [word[i : i + 1] for i in range(len(word))]
    while len(pieces) > 1:
        low, at = min((ranks.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:])))
        if low == NO_RANK:
            break
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
    return [ranks[piece] for piece in pieces]


@dataclass
class Encoder:
    """Ids of texts, block by block. Remembers the ids of a bounded number of words."""

    ranks: dict[bytes, int]
    merges: Merges
    remembered: int = 200_000
    places: dict[str, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def learn(self, words: list[str]) -> None:
        coded = [word.encode() for word in words]
        whole = np.array([self.ranks.get(word, -1) for word in coded], np.int64)
        parts = [(np.flatnonzero(whole >= 0), whole[whole >= 0].astype(np.int32))]
        rest = np.flatnonzero(whole < 0)
        if len(rest):
            ended: list = []
            early: set[int] = set()
            merge([coded[i] for i in rest], self.merges, ended, early)
            plain = np.ones(len(rest), bool)
            for i in early:
                plain[i] = False
                own = leftmost_first(coded[rest[i]], self.ranks)
                parts.append((np.full(len(own), rest[i]), np.array(own, np.int32)))
            for owners, symbols in ended:
                parts.append((rest[owners[plain[owners]]], symbols[plain[owners]]))
        owners = np.concatenate([part[0] for part in parts])
        order = np.argsort(owners, kind="stable")
        self.ids = np.concatenate((self.ids, np.concatenate([part[1] for part in parts])[order]))
        self.sizes = np.concatenate((self.sizes, np.bincount(owners, minlength=len(words))))
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words))))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self.places) > self.remembered:
            self.places, self.ids, self.sizes = {}, self.ids[:0], self.sizes[:0]
        split = regex.compile(self.merges.pattern).findall
        found = [split(text) for text in texts]
        new = list(set().union(*found).difference(self.places))
        if new:
            self.learn(new)
        starts = np.cumsum(self.sizes) - self.sizes
        out = []
        for words in found:
            at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.repeat(starts[at] - (ends - sizes), sizes) + np.arange(total)])
        return out


def text_blocks(batch: pa.Array, chars: int) -> Iterator[list[str]]:
    """Texts of a batch, about so many characters at once; only those become Python strings. Null counts as empty."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(batch):
        room = chars + (int(ends[start - 1]) if start else 0)
        end = max(start + 1, int(np.searchsorted(ends, room, side="right")))
        yield [one or "" for one in batch.slice(start, end - start).to_pylist()]
        start = end


def id_lists(found: list[np.ndarray]) -> pa.Array:
    """A list of ids for each text."""
    starts = np.concatenate(([0], np.cumsum([len(one) for one in found])))
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(found), pa.int32()))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text; the name gets underscores until it is free."""
    merges = merges_of(ranks, pattern)

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(ranks, merges)
        for batch in batches:
            for block in text_blocks(batch, BLOCK_CHARS):  # ids leave block by block, so few are held
                yield id_lists(encoder.encode(block))

    return docs.withColumn(free_name(docs.columns, into), encoded.asNondeterministic()(F.col(text).cast("string")))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that token ids stand for."""
    pieces = piece_literal(ranks)
    return F.unhex(F.array_join(F.transform(ids, lambda one: F.get(pieces, one)), ""))
