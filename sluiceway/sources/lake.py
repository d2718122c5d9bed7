"""The lake table: partitioned files at a location, Delta or Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.schemas import LAKE_ROW, PARTITION_COLUMN


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of a partition value (by default of the lake table's column) together, so that writing it takes few files.

    The hint leaves the sizes to adaptive execution: a value that holds much of the
    data, identical rows and nulls included, is split over several tasks, and
    values with little data share one.
    """
    return df.hint("rebalance", *(columns or (PARTITION_COLUMN,)))


def write_lake(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "append",
    partition_by: str | Sequence[str] = PARTITION_COLUMN,
    gather: bool = True,
) -> None:
    """Write a batch to the table's location."""
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = gathered(df, *by) if gather else df
    rows.write.format(format).mode(mode).partitionBy(*by).save(path)


def read_lake(
    spark: SparkSession, path: str, format: str = "parquet", schema: StructType = LAKE_ROW
) -> DataFrame:
    """Read the table's location.

    File formats get the schema, since partition values are otherwise inferred from
    directory names (a brand ``007`` would become the number 7); Delta keeps its own.
    """
    if format == "delta":
        return spark.read.format("delta").load(path).select(*schema.names)
    return spark.read.format(format).schema(schema).load(path).select(*schema.names)


def partition_digests(df: DataFrame, partition_by: str = PARTITION_COLUMN) -> DataFrame:
    """A digest of the multiset of rows in each partition: ``partition_by``, ``row_count``, ``digest``.

    Two tables hold the same rows, repeats counted, if their digests agree: a row's two hashes of
    64 bits are added up as whole numbers, which does not depend on order, files or batches. Sums
    are combined before the shuffle, so comparing two sinks moves a row per partition and
    task, where ``exceptAll`` groups whole rows. A lost row and one that came twice cancel
    each other out in neither the count of each partition nor, but for a chance of
    some 2^-128, in the sums.
    """
    columns = sorted(df.columns)
    # Nulls leave a hash as it is, so where they stand is hashed along.
    nulls = F.concat_ws("", *(F.col(f"`{name}`").isNull().cast("int").cast("string") for name in columns))
    row = [*(F.col(f"`{name}`") for name in columns), nulls]
    one, two = F.xxhash64(*row), F.xxhash64(F.lit(1), *reversed(row))
    return df.groupBy(partition_by).agg(
        F.count("*").alias("row_count"),
        F.concat_ws(":", *(F.sum(part.cast("decimal(38,0)")).cast("string") for part in (one, two))).alias("digest"))


def differing_partitions(left: DataFrame, right: DataFrame, partition_by: str = PARTITION_COLUMN) -> DataFrame:
    """Partitions in which two tables of equal columns differ, with the rows of each side."""
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError(f"columns differ: {sorted(set(left.dtypes) ^ set(right.dtypes))}")
    a, b = partition_digests(left, partition_by), partition_digests(right, partition_by)
    both = a.select(partition_by, F.col("row_count").alias("left_rows"), F.col("digest").alias("_left")).join(
        b.select(F.col(partition_by).alias("_by"), F.col("row_count").alias("right_rows"), F.col("digest").alias("_right")),
        F.col(partition_by).eqNullSafe(F.col("_by")), "full")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select(
        F.coalesce(partition_by, "_by").alias(partition_by),
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"))
