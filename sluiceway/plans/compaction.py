"""Few large files in place of the many small ones that a long stream leaves.

Files are packed into bins by prefix sums of their sizes, each bin is written as one file at a
new location, and readers are moved there by replacing a view, which is one change of the
catalog. Files of earlier versions stay, so a query that is reading them is not disturbed;
``drop_versions`` removes versions from the catalog when nobody reads them any longer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.plans import catalog
from sluiceway.schemas import LAKE_ROW, PARTITION_COLUMN
from sluiceway.sources.lake import differing_partitions, read_lake

FILE, SIZE, BIN = "_file", "_size", "_bin"


class Unequal(RuntimeError):
    """A compacted version that does not hold the rows of the one it was made from."""


def file_bins(rows: DataFrame, target_bytes: int, partition_by: str = PARTITION_COLUMN) -> DataFrame:
    """The files of a table with the bin that each belongs to, numbered within a partition.

    Files are summed up from the smallest on, and a bin holds those whose sum ends within the
    same multiple of ``target_bytes``: less than twice the target, unless a single file is larger.
    A row per file is what is summed; no column of the table is read.
    """
    files = rows.select(F.col(partition_by), F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_size").alias(SIZE)).groupBy(
        partition_by, FILE).agg(F.first(SIZE).alias(SIZE))
    by_size = Window.partitionBy(partition_by).orderBy(SIZE, FILE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return files.withColumn(BIN, F.floor((F.sum(SIZE).over(by_size) - 1) / target_bytes).cast("long"))


def compacted(
    spark: SparkSession, source: str, target: str, target_bytes: int = 256 << 20, format: str = "parquet",
) -> DataFrame:
    """Write the rows at ``source`` to ``target`` in bins of files, and read them back.

    Rows are shuffled once, by bin. The digests of the partitions of both sides are compared,
    so a version that lost or doubled a row raises and is never published.
    """
    rows = read_lake(spark, source, format)
    bins = file_bins(rows, target_bytes)
    wanted = bins.select(PARTITION_COLUMN, BIN).distinct().count()
    placed = rows.select("*", F.col("_metadata.file_path").alias(FILE)).join(bins.select(FILE, BIN), FILE)
    (placed.repartition(max(1, wanted), PARTITION_COLUMN, BIN).drop(FILE, BIN)
     .write.format(format).partitionBy(PARTITION_COLUMN).save(target))
    written = read_lake(spark, target, format)
    if different := differing_partitions(rows, written).take(5):
        raise Unequal(f"{target} differs from {source} in {different}")
    return written


def publish_compacted(
    spark: SparkSession, view: str, source: str, folder: str, target_bytes: int = 256 << 20, format: str = "parquet",
) -> str:
    """Compact ``source`` into a new version below ``folder`` and show it as ``view``; returns the version's table.

    A job that dies leaves a version that no view shows; made again, it takes a new one. Rows
    that a stream appends to ``source`` meanwhile are in the next version.
    """
    version = f"{view}_{uuid.uuid4().hex[:12]}"
    target = f"{folder.rstrip('/')}/{version.rpartition('.')[2]}"
    compacted(spark, source, target, target_bytes, format)
    catalog.register_table(spark, version, target, format=format)
    columns = ", ".join(f"`{name}`" for name in LAKE_ROW.names)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {version}")
    return version


def drop_versions(spark: SparkSession, view: str, keep: str) -> list[str]:
    """Take versions other than ``keep`` out of the catalog; their files stay for an expiry rule."""
    database, _, name = view.rpartition(".")
    found = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}_*'").collect()] if database else []
    dropped = [f"{database}.{one}" for one in found if f"{database}.{one}" != keep and len(one) == len(name) + 13]
    for one in dropped:
        spark.sql(f"DROP TABLE {one}")
    return dropped
