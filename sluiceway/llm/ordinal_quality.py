"""Ordinal quality: a cumulative-link regression on graded ratings.

A text is the mean of hashed features of its words (form, ending, shape) and a few hashed
statistics of the whole. One weight per feature is shared by all grades; ordered
thresholds cut the weighted sum, so that P(grade <= k) = s(threshold_k - sum) with the
logistic function s. Selection uses the expected grade or a tail probability.

Training uses a bounded sample of rated rows on the driver (``Recipe``), in which a very long
text is a fixed number of random pieces; every word of every text is scored where it is read.

Defined results: null, blank and empty texts have the statistics of an empty text only.
Without ratings of two grades every document has the grade that was seen, or grade 0.
Several ratings of a document count as the lowest. Repeated rows score equally.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import drawn_weights, excerpt, free_name, held_out, text_of

BLOCK_CHARS = 4_000_000
SCALE = 10.0  # of the means, so that weights stay small


@dataclass(frozen=True)
class Recipe:
    """Grades, size of the model and bounds of the training sample."""

    grades: int = 3
    bits: int = 16
    rows: int = 1500  # rated rows of each grade that training sees at most
    longest: int = 65_536  # bytes of a training text at most; of longer ones so many random pieces are taken
    pieces: int = 16
    steps: int = 150
    rate: float = 0.05
    shrink: float = 1e-4
    seed: int = 23


def shapes() -> bytes:
    """A table that maps each byte to its class: upper, lower, digit, other script or itself."""
    found = bytearray(range(256))
    for byte in range(256):
        if byte >= 128 or 97 <= byte <= 122:
            found[byte] = ord("a")
        elif 65 <= byte <= 90:
            found[byte] = ord("A")
        elif 48 <= byte <= 57:
            found[byte] = ord("0")
    return bytes(found)


SHAPES = shapes()
RUN = re.compile(rb"(.)\1+", re.DOTALL)


def word_features(word: bytes, mask: int) -> tuple[int, int, int]:
    """Buckets of a word's form, its ending and its shape."""
    shape = RUN.sub(rb"\1\1", word.translate(SHAPES))
    return (
        xxhash.xxh3_64_intdigest(word.lower(), 1) & mask,
        xxhash.xxh3_64_intdigest(word[-3:], 2) & mask,
        xxhash.xxh3_64_intdigest(shape, 3) & mask,
    )


def text_features(n_words: int, n_distinct: int, n_pairs: int, n_chars: int, n_lines: int, mask: int) -> list[int]:
    """Buckets of statistics: length, distinct words and pairs, mean word and line length, on coarse scales."""
    told = (
        ("words", int(np.log2(n_words + 1))),
        ("distinct", 10 * n_distinct // max(n_words, 1)),
        ("pairs", 20 * n_pairs // max(n_words, 1)),
        ("word", int(2 * np.log2(n_chars / max(n_words, 1) + 1))),
        ("line", int(np.log2(n_words / max(n_lines, 1) + 1))),
    )
    return [xxhash.xxh3_64_intdigest(f"{name}={value}", 4) & mask for name, value in told]


def blocks(texts: Sequence[str]) -> Iterator[Sequence[str]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


@dataclass
class Coded:
    """Texts as word numbers, the features of each distinct word, and those of each text."""

    owners: np.ndarray
    words: np.ndarray
    by_word: np.ndarray
    by_text: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: Sequence[str], recipe: Recipe) -> Coded:
        mask = (1 << recipe.bits) - 1
        split = [text.encode().split() for text in texts]
        place = {word: i for i, word in enumerate(dict.fromkeys(word for own in split for word in own))}
        by_word = np.array([word_features(word, mask) for word in place], np.int64).reshape(-1, 3)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter((place[word] for own in split for word in own), np.int64, int(sizes.sum()))
        by_text = np.array([
            text_features(len(own), len(set(own)), len(set(zip(own, own[1:]))), len(text), text.count("\n") + 1, mask)
            for own, text in zip(split, texts, strict=True)], np.int64).reshape(-1, 5)
        return cls(np.repeat(np.arange(len(texts)), sizes), words, by_word, by_text, sizes)


@dataclass
class Model:
    recipe: Recipe
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    constant: int | None = None

    def sums(self, coded: Coded) -> np.ndarray:
        """The weighted sum of each text."""
        each = self.weights[coded.by_word].sum(axis=1) if len(coded.by_word) else np.zeros(0)
        total = np.bincount(coded.owners, weights=each[coded.words], minlength=len(coded.sizes))
        return SCALE * total / np.maximum(coded.sizes, 1) + self.weights[coded.by_text].sum(axis=1)

    def tails(self, texts: Sequence[str]) -> np.ndarray:
        """P(grade >= k) for k from 1, one row per text."""
        if self.constant is not None:
            return np.tile((np.arange(1, self.recipe.grades) <= self.constant).astype(float), (len(texts), 1))
        parts = [self.sums(Coded.of(block, self.recipe)) for block in blocks(texts)]
        sums = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -50, 50)))


def loss_slopes(
    sums: np.ndarray, thresholds: np.ndarray, grades: np.ndarray, weights: np.ndarray | None = None,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood; its slopes by each sum and by each threshold."""
    n = len(sums)
    if weights is None:
        weights = np.ones(n)
    below = 1 / (1 + np.exp(np.clip(sums[:, None] - thresholds[None, :], -50, 50)))  # P(grade <= k)
    edge = np.concatenate((np.zeros((n, 1)), below, np.ones((n, 1))), axis=1)
    slope = edge * (1 - edge)
    rows = np.arange(n)
    high, low = edge[rows, grades + 1], edge[rows, grades]
    chance = np.maximum(high - low, 1e-9)
    by_high, by_low = weights * slope[rows, grades + 1] / chance, weights * slope[rows, grades] / chance
    by_threshold = np.array([
        (by_low[grades == k + 1].sum() - by_high[grades == k].sum()) / n for k in range(len(thresholds))])
    return float(-(weights * np.log(chance)).mean()), (by_high - by_low) / n, by_threshold


def fit(
    texts: Sequence[str], grades: Sequence[int], recipe: Recipe = Recipe(), counts: Mapping[int, int] | None = None,
) -> Model:
    """Adam on the whole sample. Thresholds are a first one and positive gaps, so they stay in order.

    ``counts`` are the ratings of each grade that the sample was drawn from: texts weigh by
    their shares, not by those drawn.
    """
    marks = np.clip(np.asarray(grades, np.int64), 0, recipe.grades - 1)
    cuts = recipe.grades - 1
    if len(set(marks.tolist())) < 2:
        return Model(recipe, np.zeros(1 << recipe.bits), np.zeros(cuts), int(marks[0]) if len(marks) else 0)
    weights = drawn_weights(marks, counts)
    coded = Coded.of(texts, recipe)
    # Counts of distinct words in each text, as means.
    pairs, counts = np.unique(coded.owners * len(coded.by_word) + coded.words, return_counts=True)
    owner, word = np.divmod(pairs, len(coded.by_word))
    share = SCALE * counts / coded.sizes[owner]
    flat = np.concatenate((np.zeros(1), np.zeros(cuts - 1), np.zeros(1 << recipe.bits)))
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    model = Model(recipe, flat[cuts:], np.zeros(cuts))
    for step in range(1, recipe.steps + 1):
        model.thresholds = flat[0] + np.concatenate(([0.0], np.cumsum(np.exp(flat[1:cuts]))))
        each = model.weights[coded.by_word].sum(axis=1)
        sums = np.bincount(owner, weights=each[word] * share, minlength=len(texts)) + model.weights[coded.by_text].sum(axis=1)
        _, by_sum, by_cut = loss_slopes(sums, model.thresholds, marks, weights)
        grow = np.zeros_like(flat)
        grow[0] = by_cut.sum()
        for k in range(1, cuts):
            grow[k] = by_cut[k:].sum() * np.exp(flat[k])
        by_word = np.bincount(word, weights=by_sum[owner] * share, minlength=len(coded.by_word))
        for column in coded.by_word.T:
            grow[cuts:] += np.bincount(column, weights=by_word, minlength=1 << recipe.bits)
        for column in coded.by_text.T:
            grow[cuts:] += np.bincount(column, weights=by_sum, minlength=1 << recipe.bits)
        grow[cuts:] += recipe.shrink * flat[cuts:]
        first = 0.9 * first + 0.1 * grow
        second = 0.99 * second + 0.01 * grow * grow
        flat -= recipe.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model.thresholds = flat[0] + np.concatenate(([0.0], np.cumsum(np.exp(flat[1:cuts]))))
    return model


def learnable(ratings: DataFrame, recipe: Recipe, *, doc_id: str = "doc_id", grade: str = "grade") -> DataFrame:
    """One grade per document, without those held out."""
    rated = ratings.where(F.col(grade).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("_id")).agg(F.min(F.col(grade).cast("int")).alias("_grade"))
    return rated.where(~held_out(F.col("_id")) & F.col("_grade").between(0, recipe.grades - 1))


def grade_counts(ratings: DataFrame, recipe: Recipe, *, doc_id: str = "doc_id", grade: str = "grade") -> dict[int, int]:
    """How many learnable documents have each grade, counted over all of them."""
    counted = learnable(ratings, recipe, doc_id=doc_id, grade=grade).groupBy("_grade").agg(F.count("*").alias("_n"))
    return {row["_grade"]: row["_n"] for row in counted.collect()}


def training_sample(
    docs: DataFrame, ratings: DataFrame, recipe: Recipe, *, doc_id: str = "doc_id", text: str = "text", grade: str = "grade",
) -> tuple[list[str], list[int]]:
    """At most ``rows`` rated texts of each grade and of ``longest`` bytes, drawn by a hash of their id."""
    learnt = learnable(ratings, recipe, doc_id=doc_id, grade=grade).withColumn(
        "_draw", F.xxhash64(F.col("_id"), F.lit(recipe.seed)))
    rows = docs.select(F.col(doc_id).alias("_id"), text_of(text).alias("_text"))
    texts: list[str] = []
    grades: list[int] = []
    for kind in range(recipe.grades):
        # Ids are drawn from the ratings first: at most `rows` of them are broadcast.
        ids = learnt.where(F.col("_grade") == kind).orderBy("_draw", "_id").limit(recipe.rows)
        part = rows.join(F.broadcast(ids), "_id").withColumn(
            "_text", excerpt(F.col("_text"), F.col("_id"), recipe.longest, recipe.pieces, recipe.seed))
        found = [row["_text"] for row in part.orderBy("_draw", "_id", "_text").limit(recipe.rows).select("_text").collect()]
        texts += found
        grades += [kind] * len(found)
    return texts, grades


def rate(docs: DataFrame, model: Model, *, text: str = "text", into: str = "rating") -> DataFrame:
    """``docs`` with a struct of ``expected`` grade and ``tails`` (P(grade >= 1), P(grade >= 2), ...).

    The name gets underscores until it is free. The model is a table of weights of fixed
    size that travels with the job.
    """

    @F.pandas_udf("expected double, tails array<double>")
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tails = model.tails([one or "" for one in batch])
            yield pd.DataFrame({"expected": tails.sum(axis=1), "tails": list(tails)})

    return docs.withColumn(free_name(docs.columns, into), rated.asNondeterministic()(F.col(text).cast("string")))
