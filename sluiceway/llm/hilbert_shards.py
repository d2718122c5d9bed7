"""Sharding along a Hilbert curve over document metadata.

Several metadata dimensions are quantised to the same number of bits, a document's place
on the Hilbert curve through that grid is computed, documents are ordered by it, and the
order is cut into runs of equal row counts. Levels keep the order of the values and hold about
equal numbers of rows (``with_levels``), so the first bits split every dimension and a shard
is a range of each: minimum and maximum statistics of its files prune on any of them. How
many of the shards a value or range still meets falls with the number of dimensions: one
dimension of n can be told apart in about the n-th root of the shards.

Equal texts with different metadata may lie in different shards.

Law ``rows``: the row counts of shards differ by one at most. Within a grid cell rows are
ordered by the checksum of the text, so equal texts with equal metadata lie together,
then by id.

Defined results: null metadata has a cell of its own at 0; a null text has size 1 (no
bytes, plus 1) and checksum 0. Ties are ordered by id; rows that agree in everything are
interchangeable. With fewer rows than shards the last shards stay empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import free_name, with_rank, written


def hashed_level(value: Column, bits: int) -> Column:
    """A category as a level from 1 to 2**bits - 1; null is 0."""
    level = F.pmod(F.xxhash64(value.cast("string")), F.lit((1 << bits) - 1)) + 1
    return F.when(value.isNull(), F.lit(0)).otherwise(level).cast("long")


def log_level(value: Column, bits: int, steps: int = 8) -> Column:
    """A size as a level on a logarithmic scale with ``steps`` levels to each doubling.

    Null and sizes up to 1 are level 0; the last level takes all that lies beyond.
    """
    level = F.floor(F.log2(F.greatest(value, F.lit(1)).cast("double")) * steps)
    return F.least(F.coalesce(level, F.lit(0)), F.lit((1 << bits) - 1)).cast("long")


def equal_levels(value: Column, bounds: Sequence, first: int = 0) -> Column:
    """How many of the ascending ``bounds`` are at or below a value, by halving, plus ``first``."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(value < F.lit(bounds[middle]), equal_levels(value, bounds[:middle], first)).otherwise(
        equal_levels(value, bounds[middle + 1 :], first + middle + 1))


def category_levels(docs: DataFrame, column: str, bits: int) -> DataFrame:
    """``value`` and ``level`` of each category: its place, by code points, in the running share of rows.

    Categories may be many: they are counted, cut into ranges of their order, and summed within
    a range and over ranges, so that no task sees all of them.
    """
    counts = docs.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    ranged = written(counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "category-ranges")
    by_range = ranged.groupBy("range").agg(F.sum("n").alias("in_range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    offsets = by_range.select(
        "range", (F.sum("in_range").over(before) - F.col("in_range")).alias("before"), F.sum("in_range").over(whole).alias("rows"))
    inner = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("n").over(inner) - F.col("n") / 2
    level = F.floor(middle / F.col("rows") * ((1 << bits) - 1)) + 1
    return written(ranged.join(offsets, "range").select("value", level.cast("long").alias("level")), "category-levels")


def with_levels(
    docs: DataFrame, *, bits: int = 6, text: str = "text", categories: Mapping[str, int] = MappingProxyType({"source": 0, "lang": 2}),
) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with a level for each category and for the size of the text, and these levels by name.

    Levels keep order and hold about equal numbers of rows, whatever the values are; null categories
    are level 0. Sizes are cut at quantiles from a mergeable sketch, ``2**bits - 1`` numbers.

    ``categories`` say how many leading bits a column leaves to the others. A column of few values
    that joins late parts the rows within shards, in files and row groups, while few
    shards are left to the columns that need them more.
    """
    levels: dict[str, Column] = {}
    found = docs
    for column, late in categories.items():
        own, value = free_name(found.columns, f"_level_{column}"), free_name(found.columns, f"_value_{column}")
        known = category_levels(docs, column, bits - late).select(F.col("value").alias(value), F.col("level").alias(own))
        # The levels are written, one row a category: a join that shuffles can split a category of most rows.
        found = found.join(known, F.col(column).cast("string") == F.col(value), "left").drop(value)
        levels[column] = F.coalesce(F.col(own), F.lit(0)).cast("long")
    size = text_size(F.col(text))
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = docs.agg(F.percentile_approx(size, shares, 100 << bits).alias("b")).first()["b"]
    own = free_name(found.columns, "_level_size")
    found = found.withColumn(own, equal_levels(size, list(bounds or ())).cast("long"))
    return found, levels | {"size": F.col(own)}


def hilbert_index(levels: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a point with one level of ``bits`` bits per axis.

    Skilling's transform of axes, as one fold over the steps (bit, axis): where the axis
    has the bit, the lower bits of the first axis are inverted, else they are exchanged
    with those of the axis. A Gray decoding and the interleaving of bits follow.
    """
    n = len(levels)
    if n < 2 or n * bits > 62:
        raise ValueError("a curve needs two or more axes and at most 62 bits in all")
    axes = F.array(*[level.cast("long") for level in levels])
    steps = F.array(*[
        F.struct(F.lit(1 << bit).cast("long").alias("bit"), F.lit(axis).alias("axis"))
        for bit in range(bits - 1, 0, -1) for axis in range(n)
    ])

    def turned(x: Column, step: Column) -> Column:
        low = step["bit"] - 1
        first, own = x[0], F.get(x, step["axis"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        inverted = own.bitwiseAND(step["bit"]) != 0
        return F.transform(x, lambda value, place: F.when(
            place == 0, first.bitwiseXOR(F.when(inverted, low).otherwise(swap))
        ).when((place == step["axis"]) & ~inverted, value.bitwiseXOR(swap)).otherwise(value))

    def gray(x: Column) -> Column:
        """Running exclusive-or over the axes."""
        start = F.slice(x, 1, 1)
        return F.aggregate(F.slice(x, 2, n - 1), start, lambda done, value: F.concat(
            done, F.array(F.element_at(done, -1).bitwiseXOR(value))))

    def finish(x: Column) -> Column:
        last = F.element_at(x, -1)
        flip = F.aggregate(
            F.array(*[F.lit(1 << bit).cast("long") for bit in range(bits - 1, 0, -1)]), F.lit(0).cast("long"),
            lambda done, bit: F.when(last.bitwiseAND(bit) != 0, done.bitwiseXOR(bit - 1)).otherwise(done))
        places = F.array(*[
            F.struct(F.lit(1 << bit).cast("long").alias("bit"), F.lit(axis).alias("axis"))
            for bit in range(bits - 1, -1, -1) for axis in range(n)
        ])
        return F.aggregate(places, F.lit(0).cast("long"), lambda done, place: done * 2 + F.when(
            F.get(x, place["axis"]).bitwiseXOR(flip).bitwiseAND(place["bit"]) != 0, 1).otherwise(0))

    turned_axes = F.aggregate(steps, axes, turned, gray) if bits > 1 else gray(axes)
    # The finish refers to the folded axes many times: bind them once.
    return F.element_at(F.transform(F.array(turned_axes), finish), 1)


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def assign(
    docs: DataFrame, dimensions: Mapping[str, Column], *, shards: int = 16, bits: int = 8,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, its place on the curve, ``shard``, ``slot``.

    ``dimensions`` names the quantised axes. Texts are read once and never shuffled.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    body = F.col(text).cast("string")
    meta = docs.select(
        F.col(doc_id).alias("doc_id"), text_size(body).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        hilbert_index(list(dimensions.values()), bits).alias("curve"),
    )
    meta = written(meta, "curve")
    total = meta.count()
    ranked = with_rank(meta, ["curve", "text_crc32", "doc_id"])
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("rank") - start)
        .drop("rank")
    )


def metadata_dimensions(
    *, bits: int = 8, text: str = "text", categories: Sequence[str] = ("source", "lang"),
) -> dict[str, Column]:
    """Hashed categories and the size of the text, where nothing is known of the table as a whole.

    Hashes keep no order, so files don't prune by category; ``with_levels`` does.
    """
    found = {name: hashed_level(F.col(name), bits) for name in categories}
    return found | {"size": log_level(text_size(F.col(text)), bits)}


def write_shards(docs: DataFrame, path: str, dimensions: Mapping[str, Column] | None = None, *, shards: int = 16, bits: int = 8,
                 doc_id: str = "doc_id", text: str = "text") -> None:
    """Write documents as one folder per shard, in curve order within files.

    Rows are numbered and written first, so that each meets its own shard, whatever ids
    are null or repeated. A shard is cut into several files where adaptive execution finds
    it too large for one task. Without ``dimensions`` they are those of ``with_levels``. The columns ``shard`` and ``slot`` get underscores where
    documents have columns of these names.
    """
    shard, slot, row, key, own_row = (free_name(docs.columns, name) for name in ("shard", "slot", "_row", "_key", "_own_row"))
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    in_order = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    levelled, levels = with_levels(numbered, bits=bits, text=text) if dimensions is None else (numbered, dimensions)
    placed = assign(
        levelled.withColumn(key, in_order), levels, shards=shards, bits=bits, doc_id=key, text=text,
    ).select(F.col("doc_id.row").alias(own_row), F.col("shard").alias(shard), F.col("slot").alias(slot))
    joined = numbered.join(placed, F.col(row) == F.col(own_row)).drop(row, own_row)
    (joined.hint("rebalance", F.col(shard)).sortWithinPartitions(shard, slot)
     .write.partitionBy(shard).parquet(path))
