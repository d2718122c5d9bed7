"""Cleaning of the raw product file and binding to the product table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.expressions import discount_percent
from sluiceway.schemas import RAW_ONLY_COLUMNS


def drop_raw_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that exist only in the raw file; absent ones are ignored.

    A header cell left empty (an exported row index) is named ``_c0`` by Spark's
    CSV reader and ``Unnamed: 0`` by pandas, so both names go.
    """
    return df.drop(*RAW_ONLY_COLUMNS, "_c0")


def trim_fulfillment(df: DataFrame) -> DataFrame:
    return df.withColumn("fulfillment_type", F.trim("fulfillment_type"))


def with_discount(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "discount", discount_percent(F.col("original_price"), F.col("price"))
    )


def clean_products(df: DataFrame) -> DataFrame:
    """Raw file rows to table-shaped rows: one projection over the scan."""
    return with_discount(trim_fulfillment(drop_raw_columns(df)))


def bind_by_position(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Give the columns of ``df`` the target's names, first to first.

    The number of columns must match: a surplus column would otherwise shift
    values into the wrong place without an error.
    """
    if len(df.columns) != len(target_columns):
        raise ValueError(
            f"{len(df.columns)} source columns cannot be bound to "
            f"{len(target_columns)} target columns"
        )
    return df.toDF(*target_columns)
