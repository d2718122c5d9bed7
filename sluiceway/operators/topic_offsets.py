"""Offsets of a topic that were never read, as intervals.

A subscription that goes on when offsets have expired leaves no trace of what it missed.
Offsets that were read become words of 64 bits, put together in partial hash aggregates, so that
messages are not sorted and what is shuffled grows with the range of offsets and not with messages.
Full words are counted like offsets once more, in bitmaps of fixed size; others are taken apart.
Bitmaps become intervals, and intervals of several reads are merged by their ends alone. A topic
partition is cut into stretches of offsets, so that no task gets all intervals of one; what
reaches over the end of a stretch is merged once more, two intervals of each at most.

Messages that are read twice count once. Transactional and compacted topics have offsets
without a message; ``gaps`` shows them like expired ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("topic", "partition")
WORD = 64  # offsets of one word
BITS = 32768  # offsets of one bitmap, as Spark's functions cut them
STRETCH_BITS = 20  # a stretch has 2^20 offsets; changes no result


def offset_words(topic: DataFrame) -> DataFrame:
    """Which offsets were read: ``topic``, ``partition``, ``word`` and its bits as ``mask``."""
    bit = F.expr(f"shiftleft(1L, cast(pmod(offset, {WORD}) AS int))")
    return topic.where("offset IS NOT NULL").groupBy(*KEYS, F.shiftright("offset", 6).alias("word")).agg(
        F.bit_or(bit).alias("mask"))


def word_intervals(words: DataFrame) -> DataFrame:
    """Runs of bits that are set in words, as ``first`` and ``last`` offset of each."""
    starts, ends = "mask & ~shiftleft(mask, 1)", "mask & ~shiftrightunsigned(mask, 1)"

    def places(bits: str) -> Column:
        return F.expr(f"filter(sequence(0, {WORD - 1}), i -> getbit({bits}, i) = 1)")

    base = F.col("word") * WORD
    opened = words.withColumns({"starts": F.expr(starts), "ends": F.expr(ends)})
    return opened.select(*KEYS, base.alias("base"), F.explode(F.arrays_zip(places("starts").alias("a"), places("ends").alias("b"))).alias("run")).select(
        *KEYS, (F.col("base") + F.col("run.a")).alias("first"), (F.col("base") + F.col("run.b")).alias("last"))


def offset_bitmaps(topic: DataFrame) -> DataFrame:
    """Which offsets were read: ``topic``, ``partition``, ``bucket``, ``bitmap``."""
    # Spark numbers places from 1.
    place = F.col("offset") + 1
    return topic.groupBy(*KEYS, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))


def bitmap_intervals(bitmaps: DataFrame) -> DataFrame:
    """Runs of bits that are set, as ``first`` and ``last`` offset of each.

    Bitmaps are taken apart one by one; one without a hole is an interval as it is.
    """
    whole = F.bitmap_count("bitmap") == BITS
    bytes_ = F.expr(f"transform(sequence(1, {BITS // 8}), i -> cast(conv(hex(substring(bitmap, i, 1)), 16, 10) AS int))")
    opened = bitmaps.where(~whole).withColumn("bytes", bytes_)

    # One more place than bits, as a run may end with the last one.
    def is_set(place: str) -> str:
        return f"coalesce(pmod(shiftright(get(bytes, ({place}) div 8), pmod({place}, 8)), 2), 0) = 1"

    here, before = is_set("i"), f"(i > 0 AND {is_set('i - 1')})"
    starts = F.expr(f"filter(sequence(0, {BITS - 1}), i -> {here} AND NOT {before})")
    ends = F.expr(f"filter(sequence(1, {BITS}), i -> {before} AND NOT ({here}))")
    base = (F.col("bucket") - 1) * BITS
    runs = opened.select(*KEYS, base.alias("base"), F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("run")).select(
        *KEYS, (F.col("base") + F.col("run.a")).alias("first"), (F.col("base") + F.col("run.b") - 1).alias("last"))
    full = bitmaps.where(whole).select(*KEYS, base.alias("first"), (base + BITS - 1).alias("last"))
    return full.unionByName(runs)


def in_stretches(intervals: DataFrame) -> DataFrame:
    """Intervals with the stretch that they begin in, those of a stretch in one task."""
    return intervals.withColumn("_stretch", F.shiftright("first", STRETCH_BITS)).repartition(*KEYS, "_stretch")


def with_reach(intervals: DataFrame, placed: DataFrame) -> DataFrame:
    """``intervals`` with the end of their stretch in ``placed`` (``_end``) and that of all earlier ones (``_before``)."""
    earlier = Window.partitionBy(*KEYS).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    # With ``first`` both sides of the join read the same columns, and so one shuffle.
    ends = placed.groupBy(*KEYS, "_stretch").agg(F.max(F.struct("last", "first"))["last"].alias("_end"))
    ends = ends.withColumn("_before", F.max("_end").over(earlier))
    by = (*KEYS, "_stretch")
    ends = ends.withColumnsRenamed({name: f"_of_{name}" for name in by})
    same = [intervals[name].eqNullSafe(ends[f"_of_{name}"]) for name in by]
    return intervals.join(ends, same).select(*intervals.columns, "_end", "_before")


def islands(intervals: DataFrame, *by: str) -> DataFrame:
    """Intervals that touch or overlap as one, within each value of ``by``."""
    by_start = Window.partitionBy(*by).orderBy("first", "last")
    reach = F.max("last").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.when(F.col("first") <= reach + 1, 0).otherwise(1)).withColumn(
        "_island", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def merged(intervals: DataFrame) -> DataFrame:
    """Intervals of several reads as few as possible: those that touch or overlap become one.

    Each stretch is merged by itself. Of what is left, an interval that an earlier stretch covers
    goes, and only the last of a stretch and one that an earlier stretch reaches can still meet others.
    """
    placed = in_stretches(intervals.select(*KEYS, "first", "last"))
    near = with_reach(islands(placed, *KEYS, "_stretch"), placed)
    near = near.where(F.col("_before").isNull() | (F.col("last") > F.col("_before")))
    meets = F.coalesce((F.col("last") == F.col("_end")) | (F.col("first") <= F.col("_before") + 1), F.lit(True))
    names = (*KEYS, "first", "last")
    return near.where(~meets).select(*names).unionByName(islands(near.where(meets).select(*names), *KEYS))


def read_intervals(topic: DataFrame) -> DataFrame:
    """Intervals of the offsets in a batch of topic rows: ``topic``, ``partition``, ``first``, ``last``."""
    words = offset_words(topic)
    full = bitmap_intervals(offset_bitmaps(words.where("mask = -1").select(*KEYS, F.col("word").alias("offset"))))
    full = full.select(*KEYS, (F.col("first") * WORD).alias("first"), (F.col("last") * WORD + WORD - 1).alias("last"))
    return merged(full.unionByName(word_intervals(words.where("mask != -1"))))


def gaps(intervals: DataFrame, earliest: int | None = None) -> DataFrame:
    """Offsets missing between merged intervals; with ``earliest`` also those from there to the first read."""
    placed = in_stretches(intervals)
    by_start = Window.partitionBy(*KEYS, "_stretch").orderBy("first")
    expected = F.coalesce(F.lag("last").over(by_start), F.col("_before")) + 1
    if earliest is not None:
        expected = F.coalesce(expected, F.lit(earliest).cast("long"))
    missing = with_reach(placed, placed).withColumn("_expected", expected).where(F.col("_expected") < F.col("first"))
    return missing.select(
        *KEYS, F.col("_expected").alias("first_missing"), (F.col("first") - 1).alias("last_missing"),
        (F.col("first") - F.col("_expected")).alias("missing"))
