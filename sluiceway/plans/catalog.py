"""Schemas, tables and views of the session catalog.

Which catalog that is (in memory, a metastore, a lake catalog) is configuration.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType, StructType

from sluiceway.operators.products import bind_by_position
from sluiceway.schemas import LAKE_ROW, PARTITION_COLUMN, TABLE, columns_ddl, plain

#: Partition column of tables that keep the load that rows came with.
LOAD = "load_id"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {quoted(location)}")


def recreate_table(
    spark: SparkSession,
    name: str,
    schema: StructType = TABLE,
    format: str = "parquet",
    location: str | None = None,
    by_load: bool = False,
) -> None:
    """Drop the table if it is there and create it empty, with declared types.

    Dropping a table at a location leaves its files, so what is there is overwritten
    by nothing, also in partitions that the catalog does not know. ``by_load`` partitions the table by the load that rows came with, which
    ``replace_load`` needs.
    """
    place = f" LOCATION {quoted(location)}" if location else ""
    columns, parts = columns_ddl(schema), ""
    if by_load:
        columns, parts = f"{columns}, `{LOAD}` string", f" PARTITIONED BY ({LOAD})"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {format}{parts}{place}")
    if location:
        _overwrite_by_nothing(spark, name)  # files that another table left, in partitions too


def _overwrite_by_nothing(spark: SparkSession, name: str) -> None:
    """Empty a table and its location. In static mode an overwrite takes whatever lies there."""
    dynamic = spark.conf.get(OVERWRITE, None)
    spark.conf.set(OVERWRITE, "static")
    try:
        spark.createDataFrame([], plain(spark.table(name).schema)).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.unset(OVERWRITE) if dynamic is None else spark.conf.set(OVERWRITE, dynamic)


def table_columns(spark: SparkSession, name: str) -> list[str]:
    """Column names of a table, from the catalog alone."""
    return spark.table(name).columns


def append_rows(df: DataFrame, name: str) -> None:
    """Append rows to a table, its columns bound by position."""
    columns = table_columns(df.sparkSession, name)
    bind_by_position(df, columns).write.insertInto(name)


def replace_load(df: DataFrame, name: str, load_id: str) -> None:
    """Rows of one load to a table partitioned by load, in place of any with that id."""
    spark = df.sparkSession
    columns = [column for column in table_columns(spark, name) if column != LOAD]
    view = f"load_{uuid.uuid4().hex}"
    bind_by_position(df, columns).createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD} = {quoted(load_id)}) SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def load_rows(spark: SparkSession, name: str, load_id: str) -> int:
    """Rows that a table partitioned by load has of one load, counted from file footers."""
    return spark.table(name).where(f"{LOAD} = {quoted(load_id)}").count()


def register_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: StructType = LAKE_ROW,
    format: str = "parquet",
    partition_by: str | None = PARTITION_COLUMN,
) -> None:
    """Make files that exist at ``location`` a table, if it is not one already.

    A catalog that tracks partitions by itself sees none of them yet, so they are
    recovered. Output of a streaming file sink brings its own file listing, and
    Delta its own log; there the catalog tracks nothing. Over the former Spark may
    also guess partition types; a table with other types than ``schema`` is refused.

    A table of that name that is there already is left as it is, and refused if its
    location, format, partitioning or types are others.
    """
    if spark.catalog.tableExists(name):
        _check_same(spark, name, location, schema if format != "delta" else None, format, partition_by)
        refresh_table(spark, name)
        return
    if format == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION {quoted(location)}")
        return
    parts = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    shape = f"({columns_ddl(schema)}) USING {format}{parts} LOCATION {quoted(location)}"
    if changed := _guessed_types(spark, name, shape, schema):
        raise ValueError(
            f"{name}: types of {changed} would be guessed from directory names; set "
            "spark.sql.sources.partitionColumnTypeInference.enabled to false"
        )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {shape}")
    _check_same(spark, name, location, schema, format, partition_by)  # another session may have been first
    refresh_table(spark, name)


def _guessed_types(spark: SparkSession, name: str, shape: str, schema: StructType) -> list[str]:
    """Columns that a table over these files would show with other types, seen on one of a name of its own."""
    trial = f"{name.rstrip('`')}_{uuid.uuid4().hex}" + ("`" if name.endswith("`") else "")
    spark.sql(f"CREATE TABLE {trial} {shape}")
    try:
        return _other_types(spark, trial, schema)
    finally:
        spark.sql(f"DROP TABLE {trial}")  # its files stay


def _other_types(spark: SparkSession, name: str, schema: StructType) -> list[str]:
    found = {f.name: f.dataType for f in spark.table(name).schema}
    return [f.name for f in schema if found.get(f.name) != f.dataType]


def _place(spark: SparkSession, location: str) -> tuple[str, str, str]:
    """File system, authority and path; a path without a file system is one of the default file system."""
    place = urlsplit(location)
    if not place.scheme:
        default = urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))
        place = place._replace(scheme=default.scheme, netloc=default.netloc)
    return place.scheme, place.netloc, "/" + place.path.strip("/")


def _check_same(
    spark: SparkSession, name: str, location: str, schema: StructType | None, format: str, partition_by: str | None
) -> None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    told = {row["col_name"]: row["data_type"] for row in rows}
    parts = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    differences = []
    if _place(spark, told.get("Location", "")) != _place(spark, location):
        differences.append(f"location {told.get('Location')}")
    if told.get("Provider", "").lower() != format.lower():
        differences.append(f"format {told.get('Provider')}")
    if format != "delta" and parts and parts != [partition_by]:
        differences.append(f"partitioning by {parts}")
    if schema is not None and (changed := _other_types(spark, name, schema)):
        differences.append(f"types of {changed}")
    if differences:
        raise ValueError(f"{name} exists with other {', '.join(differences)}; it is left as it is")


def refresh_table(spark: SparkSession, name: str) -> None:
    """Show files and partitions that were written past the catalog."""
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def double_view(spark: SparkSession, view: str, table: str) -> None:
    """View of a table that shows decimals as doubles."""
    columns = ", ".join(
        f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`"
        if isinstance(f.dataType, DecimalType)
        else f"`{f.name}`"
        for f in spark.table(table).schema
    )
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {table}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame, streaming or not, for SQL in its own session; returns the frame
    read back through the view."""
    df.createOrReplaceTempView(name)
    return run_sql(df.sparkSession, f"SELECT * FROM {name}")


def run_sql(spark: SparkSession, statement: str, **values) -> DataFrame:
    """Run one statement; ``:name`` markers take ``values`` as typed literals."""
    return spark.sql(statement, args=values or None)
