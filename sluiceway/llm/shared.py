"""Helpers that several operators use: shared folders, global ranks, units of work, free column names, weights."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see.

    It lies under ``spark.checkpoint.dir``. A session without that setting gets one
    under the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in a shared folder: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name (in any case)."""
    taken = {column.lower() for column in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_of(column: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def excerpt(text: Column, key: Column, longest: int, pieces: int, seed: int) -> Column:
    """A text of at most ``longest`` bytes: the text itself, or as many random ``pieces`` of a longer one.

    Pieces begin at places drawn by a hash of ``key``, have equal numbers of characters and lose
    words that they cut; each is a line of the result.
    """
    size = longest // (4 * pieces) - 1  # a character takes up to four bytes
    room = F.greatest(F.length(text) - size, F.lit(1))
    cut = F.array_join(F.array(*(
        F.regexp_replace(
            F.substring(text, F.pmod(F.xxhash64(key, F.lit(seed), F.lit(piece)), room).cast("int") + 1, F.lit(size)),
            rf"^{WORD}|{WORD}$", "")
        for piece in range(pieces))), "\n")
    return F.when(F.octet_length(text) <= longest, text).otherwise(cut)


def with_rank(
    df: DataFrame, keys: Sequence[str], group: str | None = None, rank: str = "rank", weight: str | None = None,
) -> DataFrame:
    """Number rows from 0 by ``keys``, within each value of the non-null column ``group``.

    With a ``weight`` the sum of the weights before a row takes the place of their number.

    No group is ever sorted in one task: rows are range-partitioned by the group and the
    keys together, so a group that holds most rows is cut into many ranges. The ranges are
    written once (their bounds come from a sample and would differ if computed anew), rows
    are numbered within a range, and the number of rows in the ranges before it is added.
    Only rows that agree in the group and in every key must share a range; their numbers
    are interchangeable.
    """
    by = [group] if group else []
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in [*by, *keys]])
    ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range") if group is None else Window.partitionBy(group).orderBy("_range")
    counts = ranged.groupBy(*by, "_range").agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    offsets = counts.select(
        *by, "_range",
        (F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
    )
    within = Window.partitionBy(*by, "_range").orderBy(*[F.col(c).asc_nulls_last() for c in keys])
    summed = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.sum(weight).over(summed) - F.col(weight) if weight else F.row_number().over(within) - 1
    numbered = ranged.withColumn("_place", place)
    return (
        numbered.join(offsets, [*by, "_range"])
        .withColumn(rank, F.col("_before") + F.col("_place"))
        .drop("_range", "_before", "_place")
    )


def per_unit(
    keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 1,
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``work`` for whole units in partitions that are sorted by the unit's ``keys``.

    It gets the next units that have ``rows`` rows together, by default one unit, whatever
    Arrow batches they are cut into. Nothing else is held.
    """
    keys = list(keys)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            names = held[keys].to_numpy()
            starts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            begin = 0
            for start in starts.tolist():  # the last unit may go on in the next batch
                if start - begin >= rows:
                    yield work(held.iloc[begin:start].reset_index(drop=True))
                    begin = start
            held = held.iloc[begin:]
        if held is not None and len(held):
            yield work(held.reset_index(drop=True))

    return each


def drawn_weights(kinds: np.ndarray, counts: Mapping[int, int] | None) -> np.ndarray:
    """Weights, one on average, that give each kind of a sample its share of ``counts``."""
    weights = np.ones(len(kinds))
    if counts is None:
        return weights
    for kind in np.unique(kinds):
        own = kinds == kind
        weights[own] = counts[int(kind)] / own.sum()
    return weights / weights.mean()
