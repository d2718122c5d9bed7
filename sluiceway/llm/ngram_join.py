"""Self-join of documents by the Jaccard similarity of their word n-grams.

1. One pass over the texts makes a MinHash signature of each n-gram set, cut into bands,
   and a digest of the whole set. Documents with equal sets form one class of copies.
2. Classes are shuffled on band hashes. Buckets with the same members are one. Each links its
   members to its smallest one only; components of these links are the candidate groups.
3. Pairs are verified on full n-gram sets, in units of work of bounded size. A group with no
   more pairs than its buckets hold together is dealt into blocks, and each pair of blocks is a
   unit. Any other group, such as a chain of buckets, is verified bucket by bucket, a large
   bucket by pairs of blocks, and a pair counts in the first bucket that holds both. So no more
   pairs are compared than buckets hold, however far groups chain. A unit counts intersections
   as a matrix product and returns one row per document, never a row per pair.
4. Components of the verified links are the classes of near copies.

Bands and rows per band follow from the recall wanted at the threshold. Verified links are
exact, whatever the bands.

Defined results: words are runs without ASCII blanks, compared as they are. A text with
fewer words than an n-gram has its whole word sequence as its only one. Null and blank
texts have no n-grams, no links, and a class of their own. Repeated rows are copies of one
another. Ids may be null or repeated: texts are matched by id and checksum together.
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
from sluiceway.llm.shared import free_name, per_unit, text_of, written

MASK = (1 << 64) - 1
UNIT = ["unit", "first", "second"]


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows per band for a pair at the threshold to share a band with ``recall``.

    The most rows that fit ``hashes`` are taken, as they let fewer dissimilar pairs through.
    """
    for rows in range(hashes, 0, -1):
        hit = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("no banding reaches that recall with so many hashes")


@dataclass(frozen=True)
class Similarity:
    """Parameters of the join.

    A block has ``block`` documents or ``block_grams`` n-grams on average, whichever is fewer; a
    unit of work has two blocks.
    """

    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    hashes: int = 128
    seed: int = 7
    block: int = 512
    block_grams: int = 1 << 20

    @property
    def share(self) -> Fraction:
        return Fraction(self.threshold).limit_denominator(10_000)


def mixed_bits(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a published generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def odd_numbers(count: int, seed: int) -> np.ndarray:
    return mixed_bits(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def ngram_sets(texts: Sequence[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit n-gram hashes of each text."""
    split = [text.encode().split() for text in texts]
    place = {word: i for i, word in enumerate(set().union(*split))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
    factors = odd_numbers(words, 1)
    found = []
    for own in split:
        coded = hashes[np.fromiter(map(place.__getitem__, own), np.int64, len(own))]
        if not len(coded):
            found.append(coded)
        elif len(coded) < words:
            found.append(mixed_bits(np.sum(coded * factors[: len(coded)], keepdims=True) + np.uint64(len(coded))))
        else:
            n = len(coded) - words + 1
            total = np.zeros(n, np.uint64)
            for i in range(words):
                total += coded[i : i + n] * factors[i]
            found.append(np.unique(mixed_bits(total)))
    return found


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int) -> list[int]:
    """One signed 64-bit hash per band of the MinHash signature of a set."""
    scale, shift = odd_numbers(bands * rows, seed + 2), odd_numbers(bands * rows, seed + 3)
    lowest = np.full(bands * rows, MASK, np.uint64)
    for start in range(0, len(grams), 1024):
        part = grams[start : start + 1024, None] * scale[None, :] + shift[None, :]
        np.minimum(lowest, part.min(axis=0), out=lowest)
    parts = mixed_bits(lowest.reshape(bands, rows) * odd_numbers(rows, seed + 4)[None, :]).sum(axis=1, dtype=np.uint64)
    return mixed_bits(parts + np.arange(bands, dtype=np.uint64)).view(np.int64).tolist()


def text_blocks(texts: Sequence[str], chars: int = 4_000_000) -> Iterator[Sequence[str]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


def signatures(docs: DataFrame, how: Similarity, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``node`` (digest of the n-gram set), ``grams`` and ``bands`` of every document."""
    bands, rows = choose_bands(how.threshold, how.recall, how.hashes)

    @F.pandas_udf("node string, grams long, bands array<long>")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for texts in text_blocks(batch.tolist()):
                for grams in ngram_sets(texts, how.words):
                    out.append((xxhash.xxh3_128_hexdigest(grams.tobytes()), len(grams),
                                band_hashes(grams, bands, rows, how.seed)) if len(grams) else (None, 0, []))
            yield pd.DataFrame(out, columns=["node", "grams", "bands"])

    whole = text_of(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), signed.asNondeterministic()(whole).alias("s"),
    ).select("doc_id", "text_hash", "s.*")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], np.int64)
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    total = np.zeros((len(left), len(right)), np.float64)
    width = 4096

    def coded(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(common, flat), max(len(common) - 1, 0))
        hit = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    (rows_l, at_l), (rows_r, at_r) = coded(left), coded(right)
    for start in range(0, len(common), width):
        parts = []
        for rows, at, n in ((rows_l, at_l, len(left)), (rows_r, at_r, len(right))):
            a, b = np.searchsorted(at, (start, start + width))
            part = np.zeros((n, min(width, len(common) - start)), np.float32)
            part[rows[a:b], at[a:b] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return np.rint(total).astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], share: Fraction) -> np.ndarray:
    """Which pairs reach the similarity: whole numbers only, so no rounding."""
    sizes = np.array([len(a) for a in left])[:, None] + np.array([len(b) for b in right])[None, :]
    p, q = share.numerator, share.denominator
    return (p + q) * shared_counts(left, right) >= p * sizes


def local_roots(pairs: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component in a symmetric table of links."""
    n = len(pairs)
    root = np.arange(n)
    reach = pairs | np.eye(n, dtype=bool)
    while True:
        low = np.where(reach, root[None, :], n).min(axis=1)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def verify_unit(rows: pd.DataFrame, share: Fraction) -> pd.DataFrame:
    """Links of one pair of blocks: for each document how many, and a root that it is linked to.

    Pairs that share one of their ``earlier`` buckets are counted there and left out.
    """
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    rows = rows.sort_values("node", kind="stable")
    copies, nodes, own = (rows[name].to_numpy() for name in ("copies", "node", "own"))
    a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
    pairs = np.zeros((len(rows), len(rows)), bool)
    if len(a) and len(b) and len(rows) > 1:
        earlier = [np.asarray(one, np.int64) for one in rows["earlier"]]
        due = np.ones((len(a), len(b)), bool)
        if any(map(len, earlier)):
            due = shared_counts([earlier[i] for i in a], [earlier[i] for i in b]) == 0
        due &= a[:, None] != b[None, :]
        some, other = a[due.any(axis=1)], b[due.any(axis=0)]
        if len(some):
            sets = [np.asarray(one, np.int64) for one in rows["set"]]
            met = linked([sets[i] for i in some], [sets[i] for i in other], share)
            pairs[np.ix_(some, other)] = met & due[np.ix_(due.any(axis=1), due.any(axis=0))]
            pairs |= pairs.T
    return pd.DataFrame({
        "node": nodes, "root": nodes[local_roots(pairs)], "whole": rows["whole"].to_numpy(),
        "links": pairs.sum(axis=1), "linked_docs": pairs @ copies,
    })


def blocks_of(members: Column, grams: Column, how: Similarity) -> Column:
    """How many blocks a group or bucket is dealt into."""
    return F.ceil(F.greatest(members / how.block, grams / how.block_grams, F.lit(1.0))).cast("int")


def dealt(units: DataFrame, blocks: Column, whole: Column) -> DataFrame:
    """Members of ``units`` once for each pair of blocks that their own one is in."""
    return (
        units.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("unit", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                "own", whole.alias("whole"), "node", "earlier")
    )


def units_of_work(classes: DataFrame, memberships: DataFrame, groups: DataFrame, how: Similarity) -> DataFrame:
    """``unit, first, second, own, whole, node, earlier``: the documents of each pair of blocks.

    ``whole`` marks groups that are a single unit. Counts of groups and buckets are written, so
    that joins with them shuffle both sides and one that most documents share can be split.
    """
    sizes = classes.select("node", F.col("grams").cast("long").alias("grams"))
    placed = written(memberships.join(groups, "node").join(sizes, "node"), "placed")
    # Long counts would overflow when squared.
    buckets = written(placed.groupBy("root", "bucket").agg(
        F.count("*").alias("members"), F.sum("grams").alias("bucket_grams")), "bucket-sizes")
    held = buckets.groupBy("root").agg(F.sum(F.col("members") * (F.col("members") - 1.0)).alias("held"))
    known = placed.select("root", "node", "grams").distinct().groupBy("root").agg(
        F.count("*").alias("n"), F.sum("grams").alias("group_grams")).join(held, "root")
    known = written(known.withColumn("dense", F.col("n") * (F.col("n") - 1.0) <= F.col("held")), "group-sizes")

    blocks = blocks_of(F.col("n"), F.col("group_grams"), how)
    by_group = dealt(
        groups.join(known.where("dense"), "root").withColumn("unit", F.col("root")).withColumn(
            "earlier", F.array().cast("array<long>")), blocks, F.col("blocks") == 1)

    sparse = placed.select("root", "node", "bucket").join(known.where("not dense").select("root"), "root")
    listed = sparse.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))  # one a band at most
    each = listed.select("node", "buckets", F.posexplode("buckets").alias("place", "bucket")).select(
        "node", "bucket", F.expr("slice(buckets, 1, place)").alias("earlier"))
    by_bucket = dealt(
        each.join(buckets, "bucket").withColumn("unit", F.col("bucket").cast("string")),
        blocks_of(F.col("members"), F.col("bucket_grams"), how), F.lit(False))
    return by_group.unionByName(by_bucket)


def verified(units: DataFrame, sets: DataFrame, how: Similarity) -> DataFrame:
    """Verified links by unit: ``node, root, whole, links, linked_docs``, from ``sets`` with ``node, copies, set``."""
    share = how.share
    rows = units.join(sets, "node").repartition(*UNIT).sortWithinPartitions(*UNIT)
    return rows.mapInPandas(
        per_unit(UNIT, lambda one: verify_unit(one, share)),
        "node string, root string, whole boolean, links long, linked_docs long")


def bucket_members(classes: DataFrame) -> DataFrame:
    """``node``, ``bucket`` and the bucket's smallest node ``low``, for buckets of several classes.

    Of buckets with the same members, told apart by their number, smallest one and two
    checksums, only one is left. Counted before the shuffle, so a common band is a row per task.
    """
    keyed = classes.select("node", F.explode("bands").alias("band"))
    counted = keyed.groupBy("band").agg(
        F.min("node").alias("low"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
    # Written, so that the join shuffles both sides and a band of most classes can be split.
    distinct = written(counted.groupBy("low", "n", "x", "y").agg(F.min("band").alias("band")).select("band", "low"), "buckets")
    return keyed.join(distinct, "band").select("node", F.col("band").alias("bucket"), "low")


def similarity_classes(
    docs: DataFrame, *, how: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``copy_id``, ``n_links``, ``n_grams``, ``text_hash``, ``stays``.

    ``class_id`` is the smallest id of the documents that are linked to it, directly or
    through others; ``copy_id`` that of the documents with an equal n-gram set. ``n_links``
    counts all other documents at or above the threshold, copies included. ``stays`` marks
    the first document of each class.
    """
    signed = written(signatures(docs, how, doc_id=doc_id, text=text), "signatures")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    classes = written(
        signed.where("grams > 0").groupBy("node").agg(
            F.min(key).alias("first"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"),
            F.any_value("grams").alias("grams")), "copy-classes")
    memberships = written(bucket_members(classes), "bucket-members")
    groups = written(components(memberships.select(F.col("node").alias("a"), F.col("low").alias("b"))), "candidate-groups")
    wanted = groups.join(classes.select("node", "first", "copies"), "node").select(
        "node", "copies", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    whole = text_of(text)
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))

    @F.pandas_udf("array<long>")
    def gram_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([s.view(np.int64) for part in text_blocks(batch.tolist()) for s in ngram_sets(part, how.words)],
                            dtype=object)

    matched = texts.join(wanted, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = written(
        matched.dropDuplicates(["node"]).select(
            "node", "copies", gram_set.asNondeterministic()("text").alias("set")), "gram-sets")
    links = written(verified(units_of_work(classes, memberships, groups, how), sets, how), "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    joint = components(links.where("not whole").select(F.col("node").alias("a"), F.col("root").alias("b")))
    single = links.where("whole").select("node", "root")
    rooted = written(counted.join(single.unionByName(joint), "node", "left").select(
        "node", "linked_docs", F.coalesce("root", "node").alias("root")), "rooted")
    # Written for the same reason as the sizes of groups.
    firsts = written(rooted.join(classes.select("node", "first"), "node").groupBy("root").agg(
        F.min("first").alias("class_first")), "class-firsts")
    known = written(
        classes.select("node", "first", "copies").join(rooted, "node", "left").join(firsts, "root", "left").select(
            "node", "first", F.coalesce("class_first", "first").alias("class_first"),
            (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links")), "classes")
    joined = signed.select("doc_id", "text_hash", "node", "grams").join(known, "node", "left")
    alone = F.col("class_first").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_first.doc_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("grams").alias("n_grams"), "text_hash",
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_first.doc_id"))
                  & (F.col("text_hash") == F.col("class_first.text_hash")))).alias("stays"),
    )


def keep_one(docs: DataFrame, *, how: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of every class, and all without n-grams; the columns of ``docs``."""
    mark, stay_hash, stay_id = (free_name(docs.columns, name) for name in ("_text_hash", "_stay_hash", "_stay_id"))
    stay = similarity_classes(docs, how=how, doc_id=doc_id, text=text).where("stays").select(
        F.col("doc_id").alias(stay_id), F.col("text_hash").alias(stay_hash)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(text_of(text)))
    same = (F.col(mark) == F.col(stay_hash)) & F.col(doc_id).eqNullSafe(F.col(stay_id))
    return marked.join(stay, same, "left_semi").dropDuplicates([doc_id, mark]).select(*docs.columns)
