"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is the vector of its hashed form plus the mean vector of its hashed
character n-grams. Windows of words overlap; in each, one recurrent network reads forward
and one backward, attention weights the states, and a linear layer gives a logit. A
document scores as its most toxic window, so training is on the windows that score highest
now (multiple-instance learning). Everything is numpy.

Training uses a bounded sample of labelled rows on the driver (``Recipe``), in which a very long
text is a fixed number of random pieces; every window of every text is scored where the text
is read. Half of a window is in the next one, so a passage of up to ``window - stride + 1``
words is seen whole.

Defined results: null, blank and empty texts have no window and get the score of an empty
one. Without labels of both kinds every score is the share of toxic labels, or 0 without
any. Several labels of one document count as toxic if one is. Repeated rows score equally.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import drawn_weights, excerpt, free_name, held_out, text_of

#: Not part of a word's form.
EDGES = b".,;:!?\"'()[]{}"
GRAMS = (3, 4, 6)
BLOCK_CHARS = 4_000_000
FORGET = 30.0  # gate input that keeps a state as it is


@dataclass(frozen=True)
class Recipe:
    """Size of the network and bounds of the training sample."""

    window: int = 64
    stride: int = 32
    inputs: int = 16
    hidden: int = 8
    word_bits: int = 14
    gram_bits: int = 15
    toxic_rows: int = 1000  # labelled rows of either kind that training sees at most
    clean_rows: int = 2000
    longest: int = 65_536  # bytes of a training text at most; of longer ones so many random pieces are taken
    pieces: int = 16
    rounds: int = 8
    batch: int = 96
    rate: float = 0.01
    seed: int = 11


def mixed_bits(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


@dataclass
class Words:
    """Distinct words as bucket numbers: of their form, and of their n-grams with owners."""

    forms: np.ndarray
    grams: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, words: Sequence[bytes], recipe: Recipe) -> Words:
        marked = [b"^" + word + b"$" for word in words]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        ends = np.cumsum(lengths)
        flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(marked)), lengths)
        left = ends[owner] - np.arange(len(flat))  # bytes from here to the word's end
        grams, owners = [], []
        base = np.uint64(0x100000001B3)
        for n in GRAMS:
            if len(flat) < n:
                continue
            total = np.zeros(len(flat) - n + 1, np.uint64)
            for i in range(n):
                total = total * base + flat[i : len(flat) - n + 1 + i]
            own = np.flatnonzero(left[: len(total)] >= n)
            grams.append(mixed_bits(total[own] + np.uint64(n << 56)) >> np.uint64(64 - recipe.gram_bits))
            owners.append(owner[own])
        # The form: a polynomial over all bytes of the word.
        power = np.cumprod(np.full(int(lengths.max(initial=1)), base), dtype=np.uint64)
        starts = ends - lengths
        terms = flat * power[np.arange(len(flat)) - starts[owner]]
        forms = np.add.reduceat(terms, starts) if len(starts) else terms
        order = np.argsort(np.concatenate(owners), kind="stable") if owners else np.zeros(0, np.int64)
        return cls(
            (mixed_bits(forms) >> np.uint64(64 - recipe.word_bits)).astype(np.int64),
            np.concatenate(grams)[order].astype(np.int64) if grams else np.zeros(0, np.int64),
            np.concatenate(owners)[order] if owners else np.zeros(0, np.int64))


@dataclass
class Network:
    """The weights. Index 0 of ``into``, ``back`` and ``bias`` is the forward direction."""

    recipe: Recipe
    word: np.ndarray
    gram: np.ndarray
    into: np.ndarray
    back: np.ndarray
    bias: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    level: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None

    NAMES = ("word", "gram", "into", "back", "bias", "attend", "out", "level")

    @classmethod
    def fresh(cls, recipe: Recipe) -> Network:
        r, d, h = np.random.default_rng(recipe.seed), recipe.inputs, recipe.hidden

        def some(*shape: int, size: float) -> np.ndarray:
            return (r.standard_normal(shape) * size).astype(np.float32)

        return cls(
            recipe, some(1 << recipe.word_bits, d, size=0.1), some(1 << recipe.gram_bits, d, size=0.3),
            some(2, d, 3 * h, size=0.4), some(2, h, 3 * h, size=0.3), np.zeros((2, 3 * h), np.float32),
            some(2, h, size=0.5), some(2, h, size=0.5), np.full(1, -1.0, np.float32))

    def vectors(self, words: Words) -> np.ndarray:
        """The input vector of each distinct word."""
        found = self.word[words.forms]
        if len(words.grams):
            heads = np.flatnonzero(np.diff(words.owners, prepend=-1))
            sizes = np.diff(np.append(heads, len(words.owners)))
            for start in range(0, len(heads), 1 << 14):  # bounds the gathered rows
                part = slice(start, start + (1 << 14))
                low = heads[part][0]
                high = heads[part][-1] + sizes[part][-1]
                sums = np.add.reduceat(self.gram[words.grams[low:high]], heads[part] - low)
                found[words.owners[heads[part]]] += sums / sizes[part][:, None].astype(np.float32)
        return found

    def gate_inputs(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each direction the gate inputs of every word; a last row for padding keeps the state."""
        h = self.recipe.hidden
        found = []
        for side in range(2):
            table = np.zeros((len(vectors) + 1, 3 * h), np.float32)
            table[:-1] = vectors @ self.into[side] + self.bias[side]
            table[-1, :h] = FORGET
            found.append(table)
        return found

    def run(self, tables: list[np.ndarray], places: np.ndarray, keep: bool = False):
        """Logits of windows given as word numbers, time along the first axis.

        ``keep`` also returns what the backward pass needs.
        """
        steps, n = places.shape
        h = self.recipe.hidden
        scores, values = np.zeros((steps, n), np.float32), np.zeros((steps, n), np.float32)
        kept = ([], [])
        for side in range(2):
            state = np.zeros((n, h), np.float32)
            heads = np.stack((self.attend[side], self.out[side]), axis=1)
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                x = tables[side][places[t]]
                u = state @ self.back[side]
                gates = np.tanh((x[:, : 2 * h] + u[:, : 2 * h]) * np.float32(0.5))
                gates *= np.float32(0.5)
                gates += np.float32(0.5)
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                following = new + z * (state - new)
                if keep:
                    kept[side].append((t, state, z, r, new, u[:, 2 * h :], following))
                state = following
                both = state @ heads
                scores[t] += both[:, 0]
                values[t] += both[:, 1]
        scores[places == len(tables[0]) - 1] = -1e9
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        logits = (weights * values).sum(axis=0) + self.level[0]
        return (logits, weights, values, kept) if keep else logits

    def gradients(self, words: Words, places: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over windows."""
        h, n = self.recipe.hidden, places.shape[1]
        vectors = self.vectors(words)
        logits, weights, values, kept = self.run(self.gate_inputs(vectors), places, keep=True)
        error = ((1 / (1 + np.exp(-logits)) - labels) / n).astype(np.float32)
        grow = {name: np.zeros_like(getattr(self, name)) for name in self.NAMES}
        grow["level"][0] = error.sum()
        by_value = weights * error
        by_score = weights * (values - (weights * values).sum(axis=0)) * error
        by_vector = np.zeros((len(vectors) + 1, vectors.shape[1]), np.float32)
        for side in range(2):
            after = np.zeros((n, h), np.float32)
            for t, state, z, r, new, un, following in reversed(kept[side]):
                grow["attend"][side] += by_score[t] @ following
                grow["out"][side] += by_value[t] @ following
                d = after + by_score[t][:, None] * self.attend[side] + by_value[t][:, None] * self.out[side]
                dn = d * (1 - z) * (1 - new * new)
                dz = d * (state - new) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                gates = np.concatenate((dz, dr, dn), axis=1)
                through = np.concatenate((dz, dr, dn * r), axis=1)
                after = d * z + through @ self.back[side].T
                grow["back"][side] += state.T @ through
                gates[places[t] == len(vectors)] = 0
                grow["bias"][side] += gates.sum(axis=0)
                known = np.minimum(places[t], len(vectors) - 1)
                grow["into"][side] += vectors[known].T @ gates
                np.add.at(by_vector, places[t], gates @ self.into[side].T)
        by_vector = by_vector[:-1]
        np.add.at(grow["word"], words.forms, by_vector)
        if len(words.grams):
            count = np.bincount(words.owners, minlength=len(by_vector)).astype(np.float32)
            np.add.at(grow["gram"], words.grams, by_vector[words.owners] / count[words.owners][:, None])
        return grow


def coded_texts(texts: Sequence[str], recipe: Recipe) -> tuple[Words, np.ndarray, np.ndarray]:
    """Distinct words, the windows as word numbers (one row each) and the text of each window.

    The last window of a text ends with its last word; shorter texts are padded.
    """
    split = [[word.strip(EDGES) for word in text.lower().encode().split()] for text in texts]
    place = {word: i for i, word in enumerate(dict.fromkeys(word for own in split for word in own))}
    words = Words.of(list(place), recipe)
    rows, owners = [], []
    reach = np.arange(recipe.window)
    for i, own in enumerate(split):
        n = len(own)
        if not n:
            continue
        coded = np.fromiter(map(place.__getitem__, own), np.int32, n)
        if n <= recipe.window:
            one = np.full((1, recipe.window), len(place), np.int32)
            one[0, :n] = coded
        else:
            starts = np.append(np.arange(0, n - recipe.window, recipe.stride), n - recipe.window)
            one = coded[starts[:, None] + reach]
        rows.append(one)
        owners.append(np.full(len(one), i))
    if not rows:
        return words, np.zeros((0, recipe.window), np.int32), np.zeros(0, np.int64)
    return words, np.concatenate(rows), np.concatenate(owners)


def window_logits(network: Network, words: Words, windows: np.ndarray, chunk: int = 2048) -> np.ndarray:
    tables = network.gate_inputs(network.vectors(words))
    parts = [network.run(tables, np.ascontiguousarray(windows[i : i + chunk].T)) for i in range(0, len(windows), chunk)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def text_logits(network: Network, texts: Sequence[str]) -> np.ndarray:
    """The highest window logit of each text; that of an empty window where it has no word."""
    found = np.full(len(texts), -np.inf)
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= BLOCK_CHARS):
            size += len(texts[end])
            end += 1
        words, windows, owners = coded_texts(texts[start:end], network.recipe)
        np.maximum.at(found, owners + start, window_logits(network, words, windows))
        start = end
    found[np.isinf(found)] = network.level[0]
    return found


def scores(network: Network, texts: Sequence[str]) -> np.ndarray:
    if network.constant is not None:
        return np.full(len(texts), network.constant)
    a, b = network.scale
    return 1 / (1 + np.exp(-np.clip(a * text_logits(network, texts) + b, -50, 50)))


def some_windows(windows: np.ndarray, chosen: np.ndarray, words: Words) -> tuple[Words, np.ndarray]:
    """The chosen windows with the words they hold only."""
    empty = len(words.forms)
    used, places = np.unique(windows[chosen], return_inverse=True)
    places = places.reshape(len(chosen), -1)
    used = used[used < empty]
    lows, highs = np.searchsorted(words.owners, used), np.searchsorted(words.owners, used, "right")
    sizes = highs - lows
    at = np.repeat(lows - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    return Words(words.forms[used], words.grams[at], np.repeat(np.arange(len(used)), sizes)), places.T


def calibrated(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and level of a logistic fit, by Newton steps with a little shrinkage."""
    if weights is None:
        weights = np.ones(len(labels))
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w = weights * p * (1 - p) + 1e-6
        off = weights * (p - labels)
        g = np.array([(off * logits).sum() + 1e-2 * (a - 1), off.sum() + 1e-2 * b])
        m = np.array([[(w * logits * logits).sum() + 1e-2, (w * logits).sum()], [(w * logits).sum(), w.sum() + 1e-2]])
        a, b = np.array([a, b]) - np.linalg.solve(m, g)
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(
    texts: Sequence[str], labels: Sequence[int], recipe: Recipe = Recipe(), counts: Mapping[int, int] | None = None,
) -> Network:
    """Train on labelled texts: Adam over the windows that score highest in their text.

    ``counts`` are the labels of either kind that the sample was drawn from: the score is
    calibrated to their shares, not to those drawn.

    Of a clean text a second window, drawn at random, is taken too. The first round takes
    random windows of all texts. Seeds are fixed, so equal samples give equal networks.
    """
    network = Network.fresh(recipe)
    marks = np.asarray(labels, np.float32)
    if not len(marks) or marks.min() == marks.max():
        network.constant = float(marks.mean()) if len(marks) else 0.0
        return network
    weights = drawn_weights(marks, counts)
    words, windows, owners = coded_texts(texts, recipe)
    heads = np.flatnonzero(np.diff(owners, prepend=-1))
    sizes = np.diff(np.append(heads, len(owners)))
    kinds = marks[owners[heads]]
    random = np.random.default_rng(recipe.seed)
    first = {name: np.zeros_like(getattr(network, name)) for name in network.NAMES}
    second = {name: np.zeros_like(getattr(network, name)) for name in network.NAMES}
    step = 0
    per_round = max(1, 4000 // max(len(heads), 1))  # small samples are gone through more often
    for turn in range(recipe.rounds):
        drawn = heads + (random.random(len(heads)) * sizes).astype(np.int64)
        if turn:
            logits = window_logits(network, words, windows)
            best = np.array([low + np.argmax(logits[low : low + size]) for low, size in zip(heads, sizes, strict=True)])
            chosen = np.concatenate((best, drawn[kinds == 0]))
            wanted = np.concatenate((kinds, np.zeros(int((kinds == 0).sum()), np.float32)))
        else:
            chosen, wanted = drawn, kinds
        for _ in range(per_round):
            order = random.permutation(len(chosen))
            for low in range(0, len(order), recipe.batch):
                part = order[low : low + recipe.batch]
                own, places = some_windows(windows, chosen[part], words)
                grow = network.gradients(own, np.ascontiguousarray(places), wanted[part])
                step += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grow.values()))
                rate = recipe.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * (1 - 0.7 * turn / recipe.rounds)
                for name, g in grow.items():
                    if size > 1:
                        g /= np.float32(size)
                    first[name] *= np.float32(0.9)
                    first[name] += np.float32(0.1) * g
                    second[name] *= np.float32(0.99)
                    second[name] += np.float32(0.01) * g * g
                    getattr(network, name)[...] -= np.float32(rate) * first[name] / (np.sqrt(second[name]) + np.float32(1e-6))
    network.scale = calibrated(text_logits(network, texts), marks, weights)
    return network


def learnable(labels: DataFrame, *, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One label per document, without those held out."""
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    return marks.where(~held_out(F.col("_id"))).withColumn("_label", (F.col("_label") > 0).cast("int"))


def class_counts(labels: DataFrame, *, doc_id: str = "doc_id", label: str = "toxic") -> dict[int, int]:
    """How many learnable documents are clean and how many toxic, counted over all of them."""
    counted = learnable(labels, doc_id=doc_id, label=label).groupBy("_label").agg(F.count("*").alias("_n"))
    return {row["_label"]: row["_n"] for row in counted.collect() if row["_label"] is not None}


def training_sample(
    docs: DataFrame, labels: DataFrame, recipe: Recipe, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> tuple[list[str], list[int]]:
    """At most ``toxic_rows`` and ``clean_rows`` labelled texts of ``longest`` bytes, drawn by a hash of their id."""
    learnt = learnable(labels, doc_id=doc_id, label=label).withColumn("_draw", F.xxhash64(F.col("_id"), F.lit(recipe.seed)))
    rows = docs.select(F.col(doc_id).alias("_id"), text_of(text).alias("_text"))
    texts: list[str] = []
    kinds: list[int] = []
    for kind, most in ((1, recipe.toxic_rows), (0, recipe.clean_rows)):
        # Ids are drawn from the labels first: at most `most` of them are broadcast.
        ids = learnt.where(F.col("_label") == kind).orderBy("_draw", "_id").limit(most)
        part = rows.join(F.broadcast(ids), "_id").withColumn(
            "_text", excerpt(F.col("_text"), F.col("_id"), recipe.longest, recipe.pieces, recipe.seed))
        found = [row["_text"] for row in part.orderBy("_draw", "_id", "_text").limit(most).select("_text").collect()]
        texts += found
        kinds += [kind] * len(found)
    return texts, kinds


def toxicity(docs: DataFrame, network: Network, *, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each text; the name gets underscores until it is free.

    The network is a few MB, fixed by its recipe, and travels with the job.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(scores(network, [one or "" for one in batch]), dtype="float64")

    return docs.withColumn(free_name(docs.columns, into), scored.asNondeterministic()(F.col(text).cast("string")))
