"""Work that is lost half-way is done again, and shows once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.schemas import LAKE_ROW
from sluiceway.sources.lake import read_lake, write_lake
from sluiceway.streaming.changes import Sink, start_append, wait

SMALL = StructType([LAKE_ROW["id"], LAKE_ROW["brand"]])


def rows(df):
    return df.select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("brand"))


def failing(df, marker):
    """The last row fails until a file appears."""
    @F.udf("string")
    def check(value):
        from pathlib import Path

        if value == "999" and not Path(marker).exists():
            raise RuntimeError("lost")
        return value

    return df.withColumn("id", check("id"))


def test_failed_batch_write_leaves_nothing(spark, tmp_path):
    path, marker = str(tmp_path / "lake"), tmp_path / "healed"
    df = failing(rows(spark.range(0, 1000, 1, 4)), str(marker))
    write_lake(rows(spark.range(1000, 1010)), path)
    with pytest.raises(Exception, match="lost"):
        write_lake(df, path)
    assert read_lake(spark, path, schema=SMALL).count() == 10
    marker.touch()
    write_lake(df, path)
    assert read_lake(spark, path, schema=SMALL).count() == 1010


def test_failed_micro_batch_is_repeated_once(spark, tmp_path):
    marker, source = tmp_path / "healed", str(tmp_path / "source")
    spark.range(0, 1000, 1, 4).write.parquet(source)
    sink = Sink(str(tmp_path / "lake"), str(tmp_path / "checkpoint"), until_caught_up=True, gather=False)

    def run():
        arriving = rows(spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source))
        wait(start_append(failing(arriving, str(marker)), sink, "brand"), timeout=300)

    with pytest.raises(Exception, match="lost"):
        run()
    marker.touch()
    run()
    stored = read_lake(spark, sink.path, schema=SMALL)
    assert stored.count() == stored.select("id").distinct().count() == 1000
