"""Mixing sources to target weights by systematic sampling.

Sizes are summed per source, a budget is shared among sources by weight, and a target
never exceeds a multiple of its source's size. Within a source every document has the
same expected number of copies, target / size. The expected copies are prefix-summed in
the order of size and id, one offset is added, and a document is emitted once for each
whole number that its interval crosses. Ordering by size spreads the choice evenly over
sizes, so the words taken stay near the target.

Defined results: a null text has size 0; a null source is a source of its own, after all
others. A source of size 0 has target 0 and takes nothing. Ties in size are ordered by id;
rows that agree in both are interchangeable, so the rows taken are the same multiset on
every run. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import WORD, free_name, with_rank, written


@dataclass(frozen=True)
class Mix:
    """How sources are weighted: ``weights`` repeat over the sources in order."""

    weights: Sequence[float] = (3.0, 1.0, 2.0)
    budget: float = 1.5  # of the size of all documents
    most: float = 2.0  # copies of a source at most
    offset: float = 0.618033988749895  # where the first whole number lies, 0 to 1

    def __post_init__(self) -> None:
        if not self.weights or min(self.weights) <= 0 or not 0 <= self.offset < 1 or self.budget > self.most:
            raise ValueError("weights must be positive, offset in [0, 1), budget at most `most`")


def source_key(source: str) -> F.Column:
    """A non-null key that orders by code point, null last."""
    value = F.col(source).cast("string")
    return F.when(value.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), value))


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source_key`` and ``source_size`` with each source's ``target``.

    Sharing what capped sources leave, again and again, ends where every uncapped source
    gets the same multiple of its weight. In the order of the multiple at which a source
    reaches its cap, that multiple follows from running sums: it is the first one that the
    source itself does not reach. One row per source goes through these windows.
    """
    weight = F.expr("element_at(array({}), cast((place - 1) % {} + 1 as int))".format(
        ", ".join(f"{float(w)!r}D" for w in mix.weights), len(mix.weights)))
    by_name, everything = Window.orderBy("source_key"), Window.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy("full_at", "source_key")
    placed = (
        sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(mix.most)))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(mix.budget)))
        .withColumn("capped_before", F.coalesce(
            F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
    )
    # The first source, in this order, that its level does not fill sets the level of all later ones.
    level = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "source_key", "level")))
    shared = placed.withColumn("set_level", level.over(everything)["level"])
    return shared.select(
        "source_key", "source_size",
        F.when(F.col("set_level").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("set_level") * F.col("weight"))).alias("target"),
    )


def take(
    docs: DataFrame, *, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Texts are read once, for their sizes. A source that holds most documents is numbered
    in many ranges, and joins to the targets only through one row per source and range.
    """
    meta = written(docs.select(
        F.col(doc_id).alias("doc_id"), source_key(source).alias("source_key"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ), "sizes")
    sizes = meta.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    ranked = with_rank(meta, ["size", "doc_id"], group="source_key")
    joined = ranked.join(targets(sizes, mix), "source_key")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.lit(mix.offset)
    crossed = F.floor((F.col("rank") + 1) * F.col("each") + start) - F.floor(F.col("rank") * F.col("each") + start)
    return (
        joined.withColumn("each", each)
        .withColumn("copies", F.least(crossed, F.ceil("each")).cast("long"))
        .select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "copies",
                (F.col("copies") * F.col("size")).alias("taken"), "source_key")
    )


def mixed(
    docs: DataFrame, *, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The documents of the mix with the columns of ``docs``, repeats as repeated rows.

    Rows that share id, source and size share their copies evenly: their total is dealt
    out one by one.
    """
    names = docs.columns
    key, size, copies, equal, extra, copy = (
        free_name(names, name) for name in ("_source_key", "_size", "_copies", "_rows", "_extra", "_copy"))
    chosen = take(docs, mix=mix, doc_id=doc_id, text=text, source=source)
    chosen = chosen.groupBy("doc_id", "source_key", "size").agg(
        F.sum("copies").alias(copies), F.count("*").alias(equal))
    keyed = docs.withColumn(key, source_key(source)).withColumn(
        size, F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long"))
    same = (keyed[doc_id].eqNullSafe(chosen["doc_id"]) & (F.col(key) == chosen["source_key"])
            & (F.col(size) == chosen["size"]))
    chosen = chosen.where(F.col(copies) > 0)
    joined = keyed.join(chosen, same).select(*[keyed[name] for name in [*names, key, size]], copies, equal)
    # Equal rows get the whole part of their copies each, the first of them one of the remainder.
    remainder = F.col(copies) % F.col(equal)
    whole = ((F.col(copies) - remainder) / F.col(equal)).cast("int")
    alone = joined.where(remainder == 0)
    rest = joined.where(remainder != 0)
    part = Window.partitionBy(doc_id, key, size).orderBy(F.xxhash64(text))
    rest = rest.withColumn(extra, (F.row_number().over(part) <= remainder).cast("int"))
    both = alone.withColumn(extra, F.lit(0)).unionByName(rest)
    return both.withColumn(copy, F.explode(F.array_repeat(F.lit(1), whole + F.col(extra)))).select(*names)
