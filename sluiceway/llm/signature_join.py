"""Near-duplicate classes by an inverted join of MinHash signatures.

1. One pass over the texts makes the shingle set of each document and a signature of
   ``hashes`` coordinates; documents with equal sets are one class from there on.
2. A pair at the threshold agrees in at least ``matches`` coordinates but for a stated
   chance. Classes are posted under each coordinate-value pair, rarest pairs first: two
   classes that agree in so many coordinates share one of their ``hashes - matches + 1``
   rarest, so only that prefix is posted, and a class whose prefix is unique is done.
3. Every posting list links its members to its first one. Such pairs are kept if they agree
   in enough coordinates, and then verified on full sets; components of these links come next.
   A group of m near copies is done here with m pairs for each list.
4. Lists whose members all lie in one component are skipped. The others are merged in blocks,
   members outside a list's largest component with all: pairs within a component, of sizes that can't reach the threshold, or met already in the
   list of a rarer pair that both share are skipped; coordinates of the rest are counted. What
   agrees often enough is verified on full sets, block by block.
5. Components of all links are the classes of near duplicates.

Links are exact whatever the signatures; no list, block or class is cut, and no pair is a row
once it has been verified. A hot list or first member is spread over blocks of bounded size.

Defined results: A-Z are lowered; words are runs without ASCII blanks. A text with fewer
words than a shingle has its whole word sequence as its only one. Null and blank texts have no
shingles, no links and a class of their own. Repeated rows have equal sets. Classes are named
by the smallest id that is not null, or null if there is none; an id equal to the name is kept,
so repeated rows of that id are. Other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import components
from sluiceway.llm.ngram_join import linked, local_roots, mixed_bits, odd_numbers, text_blocks
from sluiceway.llm.shared import per_unit, text_of, written

ALL_ONES = (1 << 64) - 1
UNIT = ["unit", "first", "second"]


@dataclass(frozen=True)
class Signatures:
    """Parameters of the join. A block has ``block`` classes or ``block_shingles`` shingles on average, whichever is fewer."""

    words: int = 2
    threshold: float = 0.8
    hashes: int = 64
    recall: float = 0.9995
    seed: int = 11
    block: int = 256
    block_shingles: int = 1 << 19

    @property
    def share(self) -> Fraction:
        return Fraction(self.threshold).limit_denominator(10_000)

    @property
    def matches(self) -> int:
        """Coordinates in which a pair at the threshold agrees with a chance of ``recall``."""
        chance, total = float(self.share), 0.0
        for agree in range(self.hashes, 0, -1):
            total += math.comb(self.hashes, agree) * chance**agree * (1 - chance) ** (self.hashes - agree)
            if total >= self.recall:
                return agree
        raise ValueError("no number of matches reaches that recall")

    @property
    def least_size(self) -> int:
        """Sets of fewer shingles reach the threshold with equal sets only."""
        return math.ceil(self.share / (1 - self.share)) if self.share < 1 else 1 << 62


def shingle_sets(texts: Sequence[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    split = [text.encode().lower().split() for text in texts]
    place = {word: i for i, word in enumerate(set().union(*split))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
    factors = odd_numbers(words + 1, 21)
    found = []
    for own in split:
        coded = hashes[np.fromiter(map(place.__getitem__, own), np.int64, len(own))]
        if 0 < len(coded) < words:
            coded = mixed_bits(np.sum(coded * factors[: len(coded)], keepdims=True) + factors[words] * np.uint64(len(coded)))
        elif len(coded):
            n = len(coded) - words + 1
            total = coded[:n] * factors[0]
            for i in range(1, words):
                total += coded[i : i + n] * factors[i]
            total = np.sort(mixed_bits(total))
            coded = total[np.concatenate([[True], total[1:] != total[:-1]])]
        found.append(coded)
    return found


def signature(grams: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, as 32 mixed bits."""
    lowest = np.full(len(scale), ALL_ONES, np.uint64)
    for start in range(0, len(grams), 1024):
        part = grams[start : start + 1024, None] * scale[None, :] + shift[None, :]
        np.minimum(lowest, part.min(axis=0), out=lowest)
    return (mixed_bits(lowest) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, how: Signatures, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``node`` (digest of the shingle set), ``size`` and ``sig`` of every document."""
    scale, shift = odd_numbers(how.hashes, how.seed), odd_numbers(how.hashes, how.seed + 1)

    @F.pandas_udf("node binary, size long, sig array<int>")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for texts in text_blocks(batch.tolist()):
                for grams in shingle_sets(texts, how.words):
                    out.append((xxhash.xxh3_128_digest(grams.tobytes()), len(grams), signature(grams, scale, shift))
                               if len(grams) else (None, 0, []))
            yield pd.DataFrame(out, columns=["node", "size", "sig"])

    whole = text_of(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), signed.asNondeterministic()(whole).alias("s"),
    ).select("doc_id", "text_hash", "s.*")


def prefixes(classes: DataFrame, how: Signatures) -> DataFrame:
    """``node``, ``size`` and ``prefix``: the coordinate-value pairs that are posted, rarest first.

    Pairs that no other class has come first in that order but need no posting.
    """
    postings = classes.where(F.col("size") >= how.least_size).select("node", "size", F.posexplode("sig").alias("coord", "value"))
    # Written, so that the join shuffles both sides and a pair of most classes can be split.
    common = written(postings.groupBy("coord", "value").agg(F.count("*").alias("n")).where("n > 1"), "pair-counts")
    shared = postings.join(common, ["coord", "value"]).groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "coord", "value"))).alias("pairs"))
    posted = how.hashes - how.matches + 1 - (F.lit(how.hashes) - F.size("pairs"))
    return shared.where(posted > 0).select("node", "size", F.slice("pairs", 1, posted).alias("prefix"))


def sizes_fit(left: Column, right: Column, share: Fraction) -> Column:
    return F.least(left, right) * share.denominator >= F.greatest(left, right) * share.numerator


def agreeing(left: pd.Series, right: pd.Series) -> pd.Series:
    """In how many coordinates signatures agree."""
    if not len(left):
        return pd.Series([], dtype="int32")
    return pd.Series((np.stack(left.tolist()) == np.stack(right.tolist())).sum(axis=1).astype(np.int32))


def first_pairs(lists: DataFrame, classes: DataFrame, how: Signatures) -> DataFrame:
    """Pairs ``a``, ``b`` of a list's member and its first one that agree in enough coordinates; each pair once."""
    heads = written(lists.groupBy("coord", "value").agg(
        F.min(F.struct("node", "size")).alias("head"), F.count("*").alias("n")).where("n > 1"), "list-heads")
    pairs = lists.join(heads, ["coord", "value"]).where("node != head.node").where(
        sizes_fit(F.col("size"), F.col("head.size"), how.share)).select(
        F.col("node").alias("a"), F.col("head.node").alias("b"), F.col("size").alias("size")).distinct()
    signs = classes.select("node", "sig")
    pairs = pairs.join(signs.toDF("a", "sig_a"), "a").join(signs.toDF("b", "sig_b"), "b")
    matches = F.pandas_udf(agreeing, "int")("sig_a", "sig_b")
    return pairs.where(matches >= how.matches).select("a", "b", "size")


def blocks_of(members: Column, shingles: Column, how: Signatures) -> Column:
    """How many blocks a group is dealt into."""
    return F.ceil(F.greatest(members / how.block, shingles / how.block_shingles, F.lit(1.0))).cast("int")


def head_units(pairs: DataFrame, how: Signatures) -> DataFrame:
    """Units of work for pairs of members with heads: each block of a head's members, with the head."""
    sizes = written(pairs.groupBy("b").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")), "head-sizes")
    blocks = blocks_of(F.col("n"), F.col("shingles"), how)
    dealt = pairs.join(sizes, "b").select(
        F.col("b").alias("unit"), F.lit(0).alias("first"),
        (F.pmod(F.xxhash64("a"), blocks) + 1).cast("int").alias("second"), F.col("a").alias("node"))
    heads = dealt.select("unit", "first", "second").distinct().select("*", F.col("unit").alias("node"), F.lit(0).alias("own"))
    return dealt.withColumn("own", F.col("second")).unionByName(heads)


def list_units(lists: DataFrame, roots: DataFrame, how: Signatures) -> DataFrame:
    """Units of work for lists with several components, by pairs of blocks.

    A list's largest component makes blocks of its own, which are never paired with each other:
    where most members are one component, they are dealt out once for each block of the rest.
    """
    rooted = written(lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-lists")
    parts = rooted.groupBy("coord", "value", "root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    main = F.max(F.struct("n", "shingles", "root"))
    mixed = parts.groupBy("coord", "value").agg(
        main.alias("main"), F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles")).where("roots > 1")
    mixed = written(mixed.select(
        "coord", "value", F.col("main.root").alias("main"),
        blocks_of(F.col("main.n"), F.col("main.shingles"), how).alias("main_blocks"),
        blocks_of(F.col("n") - F.col("main.n"), F.col("shingles") - F.col("main.shingles"), how).alias("blocks")), "mixed-lists")
    is_main = F.col("root") == F.col("main")
    spread = F.xxhash64("node")
    own = F.when(is_main, F.col("blocks") + F.pmod(spread, F.col("main_blocks"))).otherwise(F.pmod(spread, F.col("blocks")))
    last = F.when(is_main, F.col("blocks")).otherwise(F.col("blocks") + F.col("main_blocks")) - 1
    return (
        rooted.join(mixed, ["coord", "value"]).withColumn("own", own.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(F.concat(F.col("coord").cast("string"), F.lit(":"), F.col("value").cast("string")).cast("binary").alias("unit"),
                F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "node", "root", "size"))


def agree_in_units(rows: pd.DataFrame, how: Signatures) -> pd.DataFrame:
    """Members of units that agree often enough with one of another component whom no earlier list has.

    ``rows`` are whole units, one after the other; places a fixed step apart are compared at once.
    """
    first, second, own = (rows[name].to_numpy() for name in ("first", "second", "own"))
    unit = np.cumsum(np.concatenate([[True], (rows[UNIT].to_numpy()[1:] != rows[UNIT].to_numpy()[:-1]).any(axis=1)]))
    coordinate = np.array([int(one.split(b":")[0]) for one in rows["unit"]])
    size = rows["size"].to_numpy() * how.share.denominator
    least = rows["size"].to_numpy() * how.share.numerator
    root = np.unique(np.array(rows["root"].tolist(), object), return_inverse=True)[1]
    signs = np.stack(rows["sig"].tolist())
    # Posted coordinates in the order of the lists; the last entries of shorter prefixes are repeats.
    orders = np.stack([np.resize(one, how.hashes - how.matches + 1) if len(one) > how.hashes - how.matches
                       else np.concatenate([one, np.full(how.hashes - how.matches + 1 - len(one), one[-1])]) for one in rows["coords"]])
    posted = np.zeros(signs.shape, bool)
    np.put_along_axis(posted, orders, True, axis=1)
    hit = np.zeros(len(rows), bool)
    for step in range(1, len(rows)):
        a = np.flatnonzero(unit[step:] == unit[:-step])
        if not len(a):
            break
        b = a + step
        near = (root[a] != root[b]) & ((own[a] != own[b]) | (first[a] == second[a]))
        near &= (np.minimum(size[a], size[b]) >= np.maximum(least[a], least[b]))
        a, b = a[near], b[near]
        equal = signs[a] == signs[b]
        near = equal.sum(axis=1) >= how.matches
        a, b, equal = a[near], b[near], equal[near]
        if not len(a):
            continue
        # The first pair of a's prefix that b has posted too is the list that counts.
        met = np.take_along_axis(equal & posted[b], orders[a], axis=1)
        here = orders[a, met.argmax(axis=1)] == coordinate[a]
        hit[a[here]] = hit[b[here]] = True
    return rows.loc[hit, [*UNIT, "own", "node"]]


def link_in_unit(rows: pd.DataFrame, share: Fraction) -> pd.DataFrame:
    """Links of a unit, verified on full sets: each member with a smaller one that it is linked to, directly or not."""
    rows = rows.sort_values("node", kind="stable")
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    sets = [np.asarray(one, np.int64) for one in rows["set"]]
    nodes, own = rows["node"].to_numpy(), rows["own"].to_numpy()
    pairs = np.zeros((len(rows), len(rows)), bool)
    a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
    if len(a) and len(b):
        pairs[np.ix_(a, b)] = linked([sets[i] for i in a], [sets[i] for i in b], share)
        pairs |= pairs.T
    roots = local_roots(pairs)
    moved = np.flatnonzero(roots != np.arange(len(rows)))
    return pd.DataFrame({"a": nodes[moved], "b": nodes[roots[moved]]})


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT)


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, how: Signatures, *, doc_id: str, text: str) -> DataFrame:
    """``node`` and ``set`` of the distinct ``nodes``, made anew from the text of each one's first document."""
    wanted = nodes.select("node").distinct().join(classes.select("node", "first"), "node").select(
        "node", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    whole = text_of(text)
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))

    @F.pandas_udf("array<long>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([one.view(np.int64) for part in text_blocks(batch.tolist()) for one in shingle_sets(part, how.words)],
                            dtype=object)

    matched = texts.join(wanted, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return written(matched.dropDuplicates(["node"]).select("node", sets.asNondeterministic()("text").alias("set")), "shingle-sets")


def verified(units: DataFrame, sets: DataFrame, how: Signatures) -> DataFrame:
    """Links ``a``, ``b`` of the units."""
    share = how.share
    rows = by_unit(units.select(*UNIT, "own", "node").join(sets, "node"))
    return written(rows.mapInPandas(per_unit(UNIT, lambda one: link_in_unit(one, share)), "a binary, b binary"), "set-links")


def near_classes(
    docs: DataFrame, *, how: Signatures = Signatures(), doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    signed = written(signatures(docs, how, doc_id=doc_id, text=text), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    classes = written(signed.where("size > 0").groupBy("node").agg(
        F.min(first).alias("first"), F.any_value("size").alias("size"), F.any_value("sig").alias("sig")), "set-classes")
    heads = written(prefixes(classes, how), "prefixes")
    lists = heads.select("node", "size", F.explode("prefix").alias("pair")).select("node", "size", "pair.coord", "pair.value")

    pairs = written(first_pairs(lists, classes, how), "head-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = full_sets(docs, classes, nodes, how, doc_id=doc_id, text=text)
    links = verified(head_units(pairs, how), sets, how)
    roots = written(components(links), "head-components")

    units = list_units(lists, roots, how).join(
        heads.select("node", F.transform("prefix", lambda pair: pair["coord"]).alias("coords")), "node").join(
        classes.select("node", "sig"), "node")
    found = written(by_unit(units).mapInPandas(
        per_unit(UNIT, lambda some: agree_in_units(some, how), rows=4096), "unit binary, first int, second int, own int, node binary"), "unit-members")
    more = verified(found, full_sets(docs, classes, found, how, doc_id=doc_id, text=text), how)

    edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    rooted = written(components(edges), "near-components")
    named = written(rooted.join(classes.select("node", "first"), "node").groupBy("root").agg(
        F.min("first").alias("name")), "component-names")
    known = written(classes.select("node", "first").join(rooted, "node", "left").join(named, "root", "left").select(
        "node", F.coalesce("name.doc_id", "first.doc_id").alias("component_id")), "class-components")
    joined = signed.select("doc_id", "size", "node").join(known, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
