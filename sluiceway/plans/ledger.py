"""A ledger of loads: what came in, what a table took, and what was kept aside.

The ledger is an append-only catalog table. A load notes that it begins before it writes
anything, and that it is done after the counts of what lies in the table and among the
rejects add up to the rows that came. So an entry that only begins tells of a load that
died, and one that is short tells of lost rows. Appending a note commits like any other
append; a note that is made twice changes nothing, as the latest one of a load counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from sluiceway.plans import catalog

BEGUN, DONE, SHORT = "begun", "done", "short"
ENTRY = StructType([
    StructField("load_id", StringType()),
    StructField("source", StringType()),
    StructField("portion", LongType()),
    StructField("state", StringType()),
    StructField("rows_in", LongType()),
    StructField("rows_taken", LongType()),
    StructField("rows_rejected", LongType()),
    StructField("noted_at", TimestampType()),
])


class LostRows(RuntimeError):
    """A load whose rows in the table and among the rejects are not those that came."""


@dataclass(frozen=True)
class LoadId:
    """A portion of a source. The source is a name that no other stream has."""

    source: str
    portion: int = 0

    def __post_init__(self) -> None:
        if not self.source.replace("_", "").isalnum():
            raise ValueError(f"a source of letters, digits and underscores is needed, not {self.source!r}")

    def __str__(self) -> str:
        return f"{self.source}_{self.portion:010d}"


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    table: str

    @classmethod
    def open(cls, spark: SparkSession, table: str, location: str | None = None, format: str = "parquet") -> Ledger:
        """The ledger kept in ``table``, which is created if it is not there."""
        if not spark.catalog.tableExists(table):
            place = f" LOCATION {catalog.quoted(location)}" if location else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({catalog.columns_ddl(ENTRY)}) USING {format}{place}")
        return cls(spark, table)

    def _note(self, load: LoadId, state: str, counts: tuple[int, int, int] | None = None) -> None:
        row = (str(load), load.source, load.portion, state, *(counts or (None, None, None)))
        entry = self.spark.createDataFrame([row], StructType(ENTRY.fields[:-1]))
        catalog.append_rows(entry.withColumn("noted_at", F.current_timestamp()), self.table)

    def begin(self, load: LoadId) -> None:
        self._note(load, BEGUN)

    def finish(self, load: LoadId, rows_in: int, rows_taken: int, rows_rejected: int) -> None:
        """Note the counts; raise if rows are missing or too many."""
        whole = rows_in == rows_taken + rows_rejected
        self._note(load, DONE if whole else SHORT, (rows_in, rows_taken, rows_rejected))
        if not whole:
            raise LostRows(f"{load}: of {rows_in} rows {rows_taken} were taken and {rows_rejected} rejected")

    def loads(self) -> DataFrame:
        """The latest entry of each load. Notes are reduced before the shuffle."""
        self.spark.catalog.refreshTable(self.table)
        late = F.struct("noted_at", F.when(F.col("state") == BEGUN, 0).otherwise(1))
        return self.spark.table(self.table).groupBy("load_id").agg(
            F.max_by(F.struct(*(name for name in ENTRY.names if name != "load_id")), late).alias("entry")
        ).select("load_id", "entry.*")

    def unfinished(self) -> DataFrame:
        """Loads that died or lost rows, to be made again under their ids."""
        return self.loads().where(F.col("state") != DONE)

    def by_source(self) -> DataFrame:
        """Portions and rows of each source."""
        return self.loads().groupBy("source").agg(
            F.count("*").alias("portions"),
            *(F.sum(name).cast("long").alias(name) for name in ("rows_in", "rows_taken", "rows_rejected")),
            F.bool_and(F.col("state") == DONE).alias("balanced"))
