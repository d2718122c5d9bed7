"""Periodic runs of words, found by common extensions in suffix trees.

A run is a stretch of words that repeats with smallest period q at least three times over,
has at least 24 words, and can't be extended by a neighbouring word.

1. Words become numbers, and stretches that can hold a run are cut out of each text: every
   word of a run of at least ``least`` words lies in an ``ANCHOR``-word window that occurs
   again in the run, no further away than a third of the stretch. Words outside such
   windows are in no run, so nothing is lost and prose costs no tree.
2. Ukkonen's construction makes the suffix trees of a stretch and of its reversal. An Euler
   tour of each, kept at its leaves and at the shallowest node between two of them, with
   minima over powers of two, answers lowest common ancestors in constant time: the longest
   common extension of two places to the right and to the left.
3. Every run has a Lyndon root under the order of words or under its inverse, and that root
   is the longest Lyndon word at its place: it ends before the next smaller (next greater)
   suffix. So each place gives two candidates, which are extended both ways.

Defined results: null texts have no words. Words are runs without ASCII blanks, numbered
from 0, compared byte by byte. Each row is judged by itself, so repeated rows, ties of ids
and copies get equal results; a null id never repeats words (``planted``). Empty tables
give empty results. Other columns are kept; the added one gets a free name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.ngram_join import mixed_bits, odd_numbers, text_blocks
from sluiceway.llm.shared import free_name, text_of

#: Words of the windows by which stretches are cut out. Any run of 24 words or more, three
#: periods long, has each of its windows of up to nine words twice.
ANCHOR = 8

Run = tuple[int, int, int]
Rewrite = Callable[[object, list[bytes]], list[bytes]]


@dataclass(frozen=True)
class Periodicity:
    """What counts as a run: ``least`` words and ``times`` periods. ``least`` is at least 24, ``times`` at least 3."""

    least: int = 24
    times: int = 3

    def __post_init__(self) -> None:
        if self.least < 24 or self.times < 3:
            raise ValueError("shorter runs may hold windows that occur once")


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats, for ids whose checksum ends in 0."""
    n = len(words)
    if doc_id is None or pd.isna(doc_id) or not n:
        return words
    drawn = zlib.crc32(str(int(doc_id)).encode())
    if drawn % 10:
        return words
    rest = drawn // 10
    start = rest % n
    period = 1 + (n - start) // (3 + rest % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * ((n - start) // period + 1))[: n - start]


# -- suffix trees -----------------------------------------------------------------


class Extensions:
    """Longest common prefixes of suffixes of a sequence, by a suffix tree and its Euler tour."""

    def __init__(self, symbols: Sequence[int]) -> None:
        """``symbols`` are numbers from 1; an end mark that is smaller than all is added."""
        text = [*symbols, 0]
        leaves, shared = leaf_tour(*suffix_tree(text))
        self.rank = np.empty(len(text), np.int64)
        self.rank[leaves] = np.arange(len(text))
        self.minima = [np.asarray(shared, np.int32)]
        width = 1
        while 2 * width <= len(shared):
            below = self.minima[-1]
            self.minima.append(np.minimum(below[: len(below) - width], below[width:]))
            width *= 2

    def common(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at pairs of different places."""
        a, b = self.rank[first], self.rank[second]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for one in np.unique(level):
            at = level == one
            table = self.minima[one]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(one))])
        return out


def suffix_tree(text: list[int]) -> tuple[dict[int, int], list[int], list[int], list[int], int]:
    """Ukkonen's tree of ``text``, whose last symbol occurs once.

    Returns the children by ``node * width + first symbol``, starts and stops of the edges
    into nodes, the suffix of each leaf (-1 for inner nodes), and ``width``.
    """
    n, width = len(text), max(text) + 1
    child: dict[int, int] = {}
    start, stop, link, suffix = [0], [0], [0], [-1]
    node = edge = length = waiting = 0
    for i, symbol in enumerate(text):
        waiting += 1
        fresh = 0
        while waiting:
            if not length:
                edge = i
            key = node * width + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                suffix.append(i - waiting + 1)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                begin = start[below]
                span = stop[below] - begin
                if length >= span:
                    node, edge, length = below, edge + span, length - span
                    continue
                middle = text[begin + length]
                if middle == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                child[key] = inner
                start += (begin, i)
                stop += (begin + length, n)
                link += (0, 0)
                suffix += (-1, i - waiting + 1)
                child[inner * width + symbol] = inner + 1
                start[below] = begin + length
                child[inner * width + middle] = below
                if fresh:
                    link[fresh] = inner
                fresh = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return child, start, stop, suffix, width


def leaf_tour(
    child: dict[int, int], start: list[int], stop: list[int], suffix: list[int], width: int,
) -> tuple[list[int], list[int]]:
    """The suffixes in the order of an Euler tour that takes children by symbol, and for each
    the depth of the shallowest node that the tour passes since the leaf before."""
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    order = np.argsort(keys)
    nodes, parents = nodes[order], keys[order] // width
    counts = np.bincount(parents, minlength=len(start))
    first = (np.cumsum(counts) - counts).tolist()
    count, below = counts.tolist(), nodes.tolist()
    leaves, shared = [], []
    # A node comes with the depth of its parent, and the depth the tour last turned at.
    stack = [(0, 0, 0)]
    while stack:
        node, above, turned = stack.pop()
        children = count[node]
        if not children:
            leaves.append(suffix[node])
            shared.append(turned)
            continue
        depth = above + stop[node] - start[node]
        at = first[node]
        for place in range(at + children - 1, at, -1):
            stack.append((below[place], depth, depth))
        stack.append((below[at], depth, turned))
    return leaves, shared


# -- runs -------------------------------------------------------------------------


def next_smaller(ranks: list[int]) -> list[int]:
    """For each place the next one with a smaller value; the length where there is none."""
    n = len(ranks)
    out, open_places = [n] * n, []
    for place, rank in enumerate(ranks):
        while open_places and ranks[open_places[-1]] > rank:
            out[open_places.pop()] = place
        open_places.append(place)
    return out


def runs_of(codes: np.ndarray, how: Periodicity) -> np.ndarray:
    """All runs of a sequence of numbers: rows of start, length and period, in that order."""
    n = len(codes)
    symbols = np.unique(codes, return_inverse=True)[1] + 1
    right, left = Extensions(symbols.tolist()), Extensions(symbols[::-1].tolist())
    ranks = right.rank
    found = []
    for side in (ranks, -ranks):
        after = np.asarray(next_smaller(side.tolist())[:n])
        place = np.flatnonzero((after < n) & (how.times * (after - np.arange(n)) <= n))
        period = after[place] - place
        end = after[place] + right.common(place, after[place])
        begin = place.copy()
        inner = np.flatnonzero(place > 0)
        # A place p of the text is place n - 1 - p of its reversal.
        begin[inner] -= left.common(n - place[inner], n - after[place[inner]])
        length = end - begin
        run = (length >= how.least) & (length >= how.times * period)
        found.append(np.stack([begin[run], length[run], period[run]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def stretches(codes: np.ndarray, doc: np.ndarray, how: Periodicity) -> list[tuple[int, int]]:
    """Stretches within documents that hold all runs, as starts and ends in ``codes``."""
    n = len(codes) - ANCHOR + 1
    if n < 1:
        return []
    bits = mixed_bits(codes.astype(np.uint64) + np.uint64(1))
    factors = odd_numbers(ANCHOR + 1, 5)
    gram = doc[:n].astype(np.uint64) * factors[ANCHOR]
    for i in range(ANCHOR):
        gram += bits[i : i + n] * factors[i]
    whole = doc[:n] == doc[ANCHOR - 1 :]
    places = np.flatnonzero(whole)
    order = places[np.argsort(gram[places], kind="stable")]
    same = gram[order[1:]] == gram[order[:-1]]
    steps = np.where(same, np.diff(order), len(codes))
    near = np.full(n, len(codes))
    near[order[1:]] = steps
    near[order[:-1]] = np.minimum(near[order[:-1]], steps)
    useful = near < len(codes)
    while True:
        edge = np.zeros(len(codes) + 1, np.int32)
        hits = np.flatnonzero(useful)
        edge[hits] += 1
        edge[hits + ANCHOR] -= 1  # places differ, so no entry is hit twice
        covered = np.cumsum(edge[:-1]) > 0
        border = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
        inside = border[(border > 0) & (border < len(codes))]
        # Covered words of neighbouring documents may touch.
        turn = np.flatnonzero(doc[1:] != doc[:-1]) + 1
        cuts = np.unique(np.concatenate([[0], inside, turn, [len(codes)]]))
        begins, ends = cuts[:-1], cuts[1:]
        kept = covered[begins] & (ends - begins >= how.least)
        begins, ends = begins[kept], ends[kept]
        reach = np.zeros(n, np.int64)
        sizes = np.minimum(ends - begins, n - begins)
        flat = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(begins) else []
        if len(begins):
            reach[flat] = np.repeat((ends - begins) // how.times, sizes)
        narrower = useful & (near <= reach)
        if (narrower == useful).all():
            return list(zip(begins.tolist(), ends.tolist(), strict=True))
        useful = narrower


def found_runs(texts: Sequence[list[bytes]], how: Periodicity) -> list[list[Run]]:
    """The runs of each list of words, by start, then period."""
    place = {word: i for i, word in enumerate(set().union(*texts))}
    sizes = np.array([len(own) for own in texts], np.int64)
    codes = np.concatenate([np.fromiter(map(place.__getitem__, own), np.int64, len(own)) for own in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    found: list[list[Run]] = [[] for _ in texts]
    for begin, end in stretches(codes, doc, how):
        own = int(doc[begin])
        shift = begin - int(offsets[own])
        found[own] += [(start + shift, length, period) for start, length, period in runs_of(codes[begin:end], how).tolist()]
    return [sorted(one, key=lambda run: (run[0], run[2])) for one in found]


def collapsed(words: list[bytes], runs: Sequence[Run]) -> bytes:
    """The words joined by blanks, without those after the first period of a run."""
    if not runs:
        return b" ".join(words)
    depth = [0] * (len(words) + 1)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept, level = [], 0
    for word, step in zip(words, depth, strict=False):
        level += step
        if not level:
            kept.append(word)
    return b" ".join(kept)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact quotient of length and period, then the first, then the shortest period."""
    def better(best: Column, one: Column) -> Column:
        gain = one["length"] * best["period"] - best["length"] * one["period"]
        first = (one["start"] < best["start"]) | ((one["start"] == best["start"]) & (one["period"] < best["period"]))
        return F.when(best.isNull() | (gain > 0) | ((gain == 0) & first), one).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def find_runs(
    docs: DataFrame, *, how: Periodicity = Periodicity(), doc_id: str = "doc_id", text: str = "text",
    with_text: bool = True, rewrite: Rewrite | None = None,
) -> DataFrame:
    """``docs`` with a struct ``periodic`` of ``runs`` (start, length, period), the ``collapsed``
    text (null unless ``with_text``) and its digest ``collapsed_sha256``.

    ``rewrite`` maps an id and its words to the words that are judged. Texts are handled
    in blocks of bounded length within a task; nothing is shuffled.
    """
    @F.pandas_udf(
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string, collapsed_sha256 string")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            out, at, own_ids = [], 0, ids.tolist()
            for block in text_blocks(texts.tolist()):
                split = [one.encode().split() for one in block]
                if rewrite is not None:
                    split = [rewrite(own_ids[at + i], own) for i, own in enumerate(split)]
                at += len(block)
                for words, runs in zip(split, found_runs(split, how), strict=True):
                    left = collapsed(words, runs)
                    out.append(([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs],
                                left.decode() if with_text else None, hashlib.sha256(left).hexdigest()))
            yield pd.DataFrame(out, columns=["runs", "collapsed", "collapsed_sha256"])

    name = free_name(docs.columns, "periodic")
    return docs.withColumn(name, judged.asNondeterministic()(F.col(doc_id), text_of(text)))
