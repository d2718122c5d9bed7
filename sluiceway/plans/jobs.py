"""The jobs that users run, put together from operators, sources and sinks.

A load reads its source once for the table and once more for the rejects: both are
plain scans, where holding the rows between them would need room for all. The rejects
are written first, and both go under the load's id, so that a load that died is
repeated with the same id and replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.operators.constraints import CORRUPT, CORRUPT_REASON, REASON, accepted, check_constraints, rejected
from sluiceway.operators.products import bind_by_position, clean_products
from sluiceway.plans import catalog
from sluiceway.plans.ledger import Ledger, LoadId
from sluiceway.schemas import PRODUCT_COLUMNS
from sluiceway.sources import jdbc
from sluiceway.sources.csv import read_csv_head, read_csv_text, write_csv
from sluiceway.streaming.changes import Sink, append_changes, append_rejects


def clean_product_file(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType | None = None,
    files: int | None = None,
    rejects_path: str | None = None,
    **options,
) -> None:
    """Clean a raw product file and write the table-shaped result as CSV.

    Cells are read and written as text, so that what is no number is still there for the
    load to reject. Rows with too few or too many cells go, with their line, to Parquet at
    ``rejects_path``, by default ``target`` with ``_rejects`` behind its name; a repeated
    run replaces both. ``schema`` names the columns, by default the header does.
    ``options`` say how the source is read.
    """
    columns = None if schema is None else schema.names
    cleaned = clean_products(read_csv_text(spark, source, columns, **options))
    names = [name for name in cleaned.columns if name != CORRUPT]
    broken = cleaned.where(F.col(CORRUPT).isNotNull()).select(*names, CORRUPT, F.lit(CORRUPT_REASON).alias(REASON))
    broken.write.mode("overwrite").parquet(rejects_path or f"{target.rstrip('/')}_rejects")
    write_csv(cleaned.where(F.col(CORRUPT).isNull()).select(*names), target, files=files)


@dataclass(frozen=True)
class CheckedRows:
    """Rows of a load: what the table takes, and the rest with reasons."""

    accepted: DataFrame
    rejected: DataFrame


def checked_products(df: DataFrame) -> CheckedRows:
    """Bind rows to the product table by position and check its constraints.

    Rows that the CSV reader marked as broken are rejected whatever their cells hold.
    """
    if CORRUPT in df.columns:
        names = [name for name in df.columns if name != CORRUPT]
        bound = bind_by_position(df.select(*names, CORRUPT), [*PRODUCT_COLUMNS, CORRUPT])
    else:
        bound = bind_by_position(df, PRODUCT_COLUMNS)
    checked = check_constraints(bound)
    return CheckedRows(accepted(checked), rejected(checked))


def read_products(
    spark: SparkSession,
    source: str,
    schema: StructType,
    rows: int | None = None,
    **options,
) -> DataFrame:
    """Cleaned products from CSV as text, broken rows marked: all, or the first ``rows``
    in file order. ``schema`` names the columns; the constraint check types them."""
    if rows is None:
        return read_csv_text(spark, source, schema.names, **options)
    text = ", ".join(f"`{name}` string" for name in [*schema.names, CORRUPT])
    return read_csv_head(
        spark, source, rows, text, columnNameOfCorruptRecord=CORRUPT, columnPruning=False, **options
    )


def load_catalog_table(
    df: DataFrame,
    table: str,
    rejects_path: str | None = None,
    load_id: str | LoadId | None = None,
    ledger: Ledger | None = None,
) -> CheckedRows:
    """Load the rows that a catalog table accepts; keep the rest as Parquet.

    With ``load_id`` a table that is partitioned by load takes the rows in place of
    those of an earlier attempt with that id. Without it rows are appended.

    With a ``ledger``, which needs a ``LoadId`` and a place for rejects, the load is noted
    there, and it raises unless the rows that came are those that lie in the table and among the
    rejects. The latter two are counted from file footers; counting what came reads ``df`` once more.
    """
    if ledger is not None and (not isinstance(load_id, LoadId) or rejects_path is None):
        raise ValueError("a ledger needs the source and portion of a load, and a place for rejects")
    own = None if load_id is None else str(load_id)
    if ledger is not None:
        ledger.begin(load_id)
    checked = checked_products(df)
    _keep_rejects(checked, rejects_path, own)
    if own is None:
        catalog.append_rows(checked.accepted, table)
    else:
        catalog.replace_load(checked.accepted, table, own)
    if ledger is not None:
        kept = _rejects(df.sparkSession, rejects_path).where(F.col(catalog.LOAD) == own).count()
        ledger.finish(load_id, df.count(), catalog.load_rows(df.sparkSession, table, own), kept)
    return checked


def load_jdbc_table(
    df: DataFrame,
    table: jdbc.JdbcTable,
    rejects_path: str | None = None,
    load_id: str | LoadId | None = None,
    **options,
) -> CheckedRows:
    """Load the rows that a relational table accepts; keep the rest as Parquet.

    With ``load_id`` the rows go to a staging table of that load, which an attempt
    creates anew and the database then takes over; see ``jdbc.staging_table``.
    """
    checked = checked_products(df)
    _keep_rejects(checked, rejects_path, None if load_id is None else str(load_id))
    if load_id is None:
        jdbc.append_rows(checked.accepted, table, **options)
    else:
        staging = jdbc.staging_table(table, str(load_id))
        jdbc.recreate_table(df.sparkSession, staging)
        jdbc.append_rows(checked.accepted, staging, PRODUCT_COLUMNS, **options)
    return checked


def _rejects(spark: SparkSession, path: str) -> DataFrame:
    """What loads kept aside, with the load of each row, null for loads without an id."""
    found = spark.read.parquet(path).schema
    # Given as text: an id such as 0000000001 would be read as a number.
    load = StructField(catalog.LOAD, StringType())
    columns = StructType([*(field for field in found if field.name != catalog.LOAD), load])
    return spark.read.schema(columns).parquet(path)


def reject_counts(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Rejected rows per load and reason, from what was kept."""
    return _rejects(spark, rejects_path).groupBy(catalog.LOAD, "reject_reason").agg(F.count("*").alias("row_count"))


def start_paced_load(
    arriving: DataFrame,
    load: Callable[[DataFrame, LoadId], object],
    checkpoint: str,
    interval: str | None = None,
    source: str | None = None,
) -> StreamingQuery:
    """Load a replayed stream, a portion per ``interval``; all that is there without one.

    ``load`` gets a portion and its id, such as ``lambda rows, id:
    load_catalog_table(rows, "lake.products", "s3a://rejects", id, ledger)``. The id holds the
    stream's own identity and the number of the portion, so that streams into one table don't
    replace each other's rows: ``source``, a name that the caller keeps unique, or else the id that
    the checkpoint gives the stream. A portion that was loaded but not yet recorded when the job
    died is loaded again with the same id.
    """
    def portion(rows: DataFrame, number: int) -> None:
        # Spark sets the property on the thread that runs the batch; it is the checkpoint's id of the query.
        own = source or rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId").replace("-", "_")
        load(rows, LoadId(own, number))

    writer = arriving.writeStream.foreachBatch(portion).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_changes(
    topic: DataFrame, table: Sink, rejects: Sink | None = None
) -> list[StreamingQuery]:
    """Start the lake table's query and, if wanted, that of the rejected messages."""
    started = [append_changes(topic, table)]
    if rejects is not None:
        started.append(append_rejects(topic, rejects))
    return [query for query in started if query is not None]


def _keep_rejects(checked: CheckedRows, path: str | None, load_id: str | None) -> None:
    """Rejects of a load go to its partition; those without an id to the partition of null."""
    if path is None:
        return
    if load_id is None:
        rows = checked.rejected.withColumn(catalog.LOAD, F.lit(None).cast("string"))
        rows.write.mode("append").partitionBy(catalog.LOAD).parquet(path)
    else:
        checked.rejected.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{catalog.LOAD}={load_id}")
