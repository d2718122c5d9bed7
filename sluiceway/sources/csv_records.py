"""CSV records with quoted line breaks, without a task per file.

Spark's ``multiLine`` reads a whole file in one task. Here files are read as lines, split like
any text, and where a record ends follows from quotes:

1. A line lies inside a quoted cell if an odd number of quotes stands before it in its file.
   Each block of a file counts its quotes; a prefix sum over the blocks of a file, a row each,
   says with which parity a block begins.
2. Within a block, a line that begins outside of quotes begins a record, and lines up to the next
   such line belong to it. Lines before the first one belong to a record of an earlier block. Lines
   are taken in the order in which they are read: nothing is sorted, and a task holds a batch of
   lines and the record that is open.
3. Only the ends of blocks are shuffled: the lines before the first record of a block, and the last
   record of each. Pieces of a record meet by the number of the block and of the record in it.

Blocks with their parities, a row for each some hundred MB, are broadcast, so that lines stay where
they are read.

As in RFC 4180, quotes stand around whole cells and are doubled inside. A file with an odd number
of quotes has an open cell at its end, which would swallow the rest of the file: its lines
are taken one by one instead, so that broken ones are marked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.operators.constraints import CORRUPT

FILE, BLOCK, RECORD = "_file", "_block", "_record"


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files with their places: file and start of the block, each block in its order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("value"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("_quotes"))


def block_parities(lines: DataFrame) -> DataFrame:
    """Per block: whether it begins inside a quoted cell (``_inside``), and whether its file is balanced."""
    blocks = lines.groupBy(FILE, BLOCK).agg((F.sum("_quotes") % 2).alias("_odd"))
    in_file = Window.partitionBy(FILE)
    before = F.sum("_odd").over(in_file.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select(
        FILE, BLOCK, (F.coalesce(before, F.lit(0)) % 2).alias("_inside"), (F.sum("_odd").over(in_file) % 2 == 0).alias("_balanced"))


class OpenRecord:
    """The record of a block that further lines may belong to; number 0 is the rest of one that began earlier."""

    def __init__(self, file: str, block: int, odd: int) -> None:
        self.place, self.odd, self.number, self.lines = (file, block), odd, 0, []

    def rows(self, kind: pa.DataType) -> pa.RecordBatch:
        return record_rows(*self.place, [self.number] if self.lines else [], joined(self.lines, kind))


def joined(lines: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """One text of all lines; none without lines."""
    if not lines:
        return pa.array([], kind)
    flat = pa.concat_arrays(lines)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), "\n")


def record_rows(file: str, block: int, numbers: list[int] | np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(file, texts.type), n), pa.repeat(pa.scalar(block, pa.int64()), n), pa.array(numbers, pa.int64()), texts],
        [FILE, BLOCK, RECORD, "value"])


def block_records(ends: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of lines that come block by block, in their order.

    Either those that are whole, as the block shows the line behind them, or else the ``ends`` of
    blocks: lines before the first record, and the last record, which may go on in the next block.
    """
    def of_run(record: OpenRecord, quotes: np.ndarray, balanced: bool, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        before = (record.odd + np.cumsum(quotes) - quotes) % 2
        record.odd = int(record.odd + quotes.sum()) % 2
        begins = np.flatnonzero(before == 0) if balanced else np.arange(len(lines))
        if not len(begins):
            record.lines.append(lines)
            return
        first, last = int(begins[0]), int(begins[-1])
        if first:
            record.lines.append(lines[:first])
        if ends == (record.number == 0):
            yield record.rows(lines.type)
        if not ends:
            offsets = pa.array(begins - first, pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines[first:last]), "\n")
            yield record_rows(*record.place, record.number + 1 + np.arange(len(texts)), texts)
        record.number, record.lines = record.number + len(begins), [lines[last:]]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block, lines = (batch.column(name) for name in (FILE, BLOCK, "value"))
            quotes = batch.column("_quotes").to_numpy()
            other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
            starts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                place = (file[start].as_py(), block[start].as_py())
                if record is None or record.place != place:
                    if record is not None and ends:
                        yield record.rows(lines.type)
                    record = OpenRecord(*place, batch.column("_inside")[start].as_py())
                yield from of_run(record, quotes[start:end], batch.column("_balanced")[start].as_py(), lines[start:end])
        if record is not None and ends:
            yield record.rows(record.lines[0].type)

    return records


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text of each record, with file, block and number in the block as its place.

    Files are read once for the quotes of their blocks, once for whole records and once for the
    ends of blocks; lines are not shuffled.
    """
    lines = file_lines(spark, path)
    placed = lines.join(F.broadcast(block_parities(lines)), [FILE, BLOCK]).select(
        FILE, BLOCK, F.col("_quotes").cast("long").alias("_quotes"), "_inside", "_balanced", "value")
    shape = f"{FILE} string, {BLOCK} long, {RECORD} long, value string"
    whole = placed.mapInArrow(block_records(ends=False), shape)
    ends = placed.mapInArrow(block_records(ends=True), shape)
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, RECORD).rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col(RECORD) > 0, F.struct(F.col(BLOCK).alias("block"), F.col(RECORD).alias("record"))), True)
    piece = F.struct(BLOCK, RECORD, "value")
    pieces = ends.select(FILE, own.over(in_file).alias("own"), piece.alias("piece"))
    met = pieces.groupBy(FILE, F.col("own.block").alias(BLOCK), F.col("own.record").alias(RECORD)).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda one: one["value"]), "\n").alias("value"))
    return whole.unionByName(met)


def read_csv_records(
    spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True, **options
) -> DataFrame:
    """Rows of CSV files whose quoted cells may hold line breaks, typed by ``schema``.

    Agrees with ``multiLine=True``. Blank lines are no records. With a ``header`` the first record of
    each file is left out; its names must be those of ``schema``, in order. A field
    ``_corrupt_record`` in ``schema`` takes the text of a record with too few or too many cells.
    """
    records = csv_records(spark, path).withColumn("value", F.regexp_replace("value", "\r$", "")).where("value != ''")
    settings = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    names = [name for name in schema.names if name != CORRUPT]
    if header:
        first = (F.col(BLOCK) == 0) & (F.col(RECORD) == 1)
        cells = StructType([StructField(f"_{i}", StringType()) for i in range(len(names))])
        read = F.from_csv("value", cells.simpleString()[7:-1].replace(":", " "), {**settings, "mode": "FAILFAST"})
        found = F.array(*(F.coalesce(read[name], F.lit("")) for name in cells.names))
        wanted = F.array(*map(F.lit, names))
        message = F.concat(F.lit("header does not name the columns of the schema: "), F.col("value"))
        records = records.where(F.when(first, F.when(found == wanted, False).otherwise(
            F.raise_error(message).cast("boolean"))).otherwise(True))
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return records.select(F.from_csv("value", ddl, settings).alias("row")).select("row.*")
