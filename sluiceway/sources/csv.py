"""CSV files with a header row.

Quotes inside a field are doubled, as in RFC 4180, so that Spark and other CSV
readers agree on the text. Blanks around values are kept on writing; Spark's own
default drops them. Fields with line breaks need ``multiLine=True``, which makes a
file unsplittable, so it is off unless asked for; without it such a record is two
broken ones, which ``read_csv_text`` marks.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.operators.constraints import CORRUPT

DIALECT = {"header": True, "quote": '"', "escape": '"'}
CHECK_HEADER = {"enforceSchema": False}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, **options
) -> DataFrame:
    """Rows of ``path``. Without ``schema`` the types are inferred, which reads the
    files once more; ``samplingRatio`` reduces how many values that looks at. A
    ``schema`` must agree with the header: Spark's default is to apply it by position
    whatever the header says. A cell that is not of its type becomes null; where that
    matters, use ``read_csv_text``."""
    reader = spark.read.options(**{**DIALECT, **CHECK_HEADER, **options})
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Rows as text, and in ``_corrupt_record`` the line of a row with too few or too
    many cells. No cell is lost: typing them is left to the constraint check. Without
    ``columns`` the header names them, an empty name as Spark's own reader does."""
    names = columns
    if columns is None:
        plain = spark.read.options(**{**DIALECT, **options})
        names = columns = plain.csv(path).columns
        if str(options.get("header", True)).lower() == "true":  # the check compares with empty names as they are
            columns = [cell or "" for cell in plain.option("header", False).csv(path).head() or ()]
    schema = StructType([StructField(name, StringType()) for name in [*columns, CORRUPT]])
    # Whether a row has all its cells shows only if all of them are read.
    marks = {"columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    reader = spark.read.options(**{**DIALECT, **CHECK_HEADER, **marks, **options})
    return reader.schema(schema).csv(path).toDF(*names, CORRUPT)


def file_place() -> list[Column]:
    """Where a row stands among its files: path, block, row."""
    return [
        F.col("_metadata.file_path").alias("__0"),
        F.col("_metadata.file_block_start").alias("__1"),
        F.monotonically_increasing_id().alias("__2"),
    ]


def first_files(df: DataFrame, rows: int, read: Callable[[list[str]], DataFrame]) -> list[str]:
    """The first files of ``df``, in the order of their paths, that hold ``rows`` rows.

    Files are counted in lots: as many as should hold what is missing, by the rows a file had
    so far, and no more than twice the files before. So small or empty files take few jobs, and
    the files opened for nothing are bounded by those that are needed.
    """
    files = sorted(map(unquote, df.inputFiles()))
    opened, found, lot = 0, 0, 1
    while found < rows and opened < len(files):
        found += read(files[opened : opened + lot]).limit(rows - found).count()
        opened = min(opened + lot, len(files))
        missing = -(-(rows - found) * opened // found) if found else 2 * opened
        lot = max(1, min(missing, 2 * opened))
    return files[:opened]


def read_csv_head(
    spark: SparkSession,
    path: str,
    rows: int,
    schema: StructType | str | None = None,
    order_by: str | None = None,
    **options,
) -> DataFrame:
    """The first ``rows`` rows, by ``order_by`` or else in file order.

    Both are a top-k: every task keeps at most ``rows`` rows, nothing is sorted
    as a whole. In file order only the files that are needed are read.
    """
    df = read_csv(spark, path, schema, **options)
    if order_by is not None:
        return df.orderBy(order_by).limit(rows)

    def read(files: list[str]) -> DataFrame:
        return read_csv(spark, files, df.schema, **options)

    needed = first_files(df, rows, read)
    if not needed:
        return df.limit(0)
    return (
        read(needed).select("*", *file_place())
        .orderBy("__0", "__1", "__2").limit(rows).drop("__0", "__1", "__2")
    )


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, **options
) -> None:
    """Write with a header. ``files=1`` gives a single file through a single task,
    which suits small extracts only; by default every partition writes its own."""
    if files is not None:
        df = df.coalesce(files)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**{**DIALECT, **blanks, **options}).csv(path)
