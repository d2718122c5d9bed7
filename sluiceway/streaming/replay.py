"""Paced replay of bounded files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluiceway.sources.csv import CHECK_HEADER, DIALECT


def replay(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    format: str = "csv",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Files of ``path`` as a stream, a bounded portion per micro-batch.

    Together with a processing-time trigger this sets the rate of the replay. Give
    either limit, not both. CSV files are read as ``read_csv`` reads them.
    """
    known = {**DIALECT, **CHECK_HEADER} if format == "csv" else {}
    reader = spark.readStream.format(format).schema(schema).options(**{**known, **options})
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)
