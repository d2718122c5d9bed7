"""Relational tables over JDBC.

Connection properties (user, password, driver) come from the caller and are never
kept here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluiceway.operators.products import bind_by_position
from sluiceway.schemas import TABLE, plain


@dataclass(frozen=True)
class JdbcTable:
    url: str
    name: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)


def read_table(
    spark: SparkSession,
    table: JdbcTable,
    split_on: str | None = None,
    partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    small: bool = False,
) -> DataFrame:
    """Rows of a table; filters and column choice are pushed to the database.

    ``split_on`` (a number, date or timestamp) reads ranges in ``partitions`` tasks,
    bounds being asked from the database. ``predicates``, one per task, suit tables
    with uneven values or no such column; see ``block_predicates``. A table is read by
    a single task only if it is declared ``small``.
    """
    if predicates is not None:
        return spark.read.jdbc(
            table.url, table.name, predicates=list(predicates), properties=table.properties
        )
    if small:
        return spark.read.jdbc(table.url, table.name, properties=table.properties)
    if split_on is None or partitions is None:
        raise ValueError(f"{table.name}: give split_on and partitions, or predicates, or small=True")
    bounds = _query(spark, table, f"select min({split_on}) lo, max({split_on}) hi from {table.name}")
    low, high = bounds.first()
    if low is None:
        return spark.read.jdbc(table.url, table.name, properties=table.properties)
    return spark.read.jdbc(
        table.url, table.name, column=split_on, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=table.properties,
    )


def block_predicates(blocks: int, partitions: int) -> list[str]:
    """Predicates over PostgreSQL row addresses, for a table without any key.

    Tasks get equal numbers of disk blocks whatever the values are. The last one is
    open, so that rows added while reading began are not lost. ``blocks`` is
    ``pg_relation_size(table) / current_setting('block_size')::int``.
    """
    step = max(1, -(-blocks // partitions))
    starts = list(range(0, max(blocks, 1), step))
    return [
        f"ctid >= '({low},0)'::tid"
        + (f" and ctid < '({low + step},0)'::tid" if low != starts[-1] else "")
        for low in starts
    ]


def table_columns(spark: SparkSession, table: JdbcTable) -> list[str]:
    """Column names of a table, from an empty result."""
    return _query(spark, table, f"select * from {table.name} where 1=0").columns


def _query(spark: SparkSession, table: JdbcTable, text: str) -> DataFrame:
    return spark.read.jdbc(table.url, f"({text}) q", properties=table.properties)


def recreate_table(spark: SparkSession, table: JdbcTable, schema: StructType = TABLE) -> None:
    """Drop the table if it is there and create it empty, with declared types."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    spark.createDataFrame([], plain(schema)).write.option("createTableColumnTypes", types).jdbc(
        table.url, table.name, mode="overwrite", properties=table.properties
    )


def staging_table(table: JdbcTable, load_id: str) -> JdbcTable:
    """The table that one load's rows go to before the database takes them over, with
    ``insert into t select * from t_load_<id>`` and a drop in one transaction."""
    if not load_id.replace("_", "").isalnum():
        raise ValueError(f"a load id of letters, digits and underscores is needed, not {load_id!r}")
    return JdbcTable(table.url, f"{table.name}_load_{load_id}", table.properties)


def append_rows(
    df: DataFrame,
    table: JdbcTable,
    columns: Sequence[str] | None = None,
    batch_rows: int = 10_000,
    connections: int | None = None,
) -> None:
    """Append rows, bound by position to ``columns`` (by default the table's own).

    Values travel as typed parameters, so quotes and nulls need no care. Spark commits
    each task on its own: a task that is lost after its commit is run again and its
    rows arrive twice. To be safe against it, load into a ``staging_table``, compare
    ``row_count`` with the rows meant, and recreate it on failure.
    """
    bound = bind_by_position(df, columns or table_columns(df.sparkSession, table))
    options = {"batchsize": batch_rows}
    if connections is not None:
        options["numPartitions"] = connections
    bound.write.options(**options).jdbc(
        table.url, table.name, mode="append", properties=table.properties
    )


def row_count(spark: SparkSession, table: JdbcTable) -> int:
    """Rows of a table, counted by the database."""
    return _query(spark, table, f"select count(*) n from {table.name}").first()[0]
