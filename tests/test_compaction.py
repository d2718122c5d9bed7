import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from sluiceway.operators.change_events import table_rows
from sluiceway.plans import catalog, compaction
from sluiceway.sources.lake import differing_partitions, read_lake, write_lake


@pytest.fixture
def small_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "table")
    rows = table_rows(fx.change_topic(fx.line_products(spark, sf_dir)))
    for part in range(6):
        write_lake(rows.where(F.abs(F.hash("id")) % 6 == part), path)
    return path


def sizes(df):
    rows = df.select("brand", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct().collect()
    return {row["file"]: (row["brand"], row["size"]) for row in rows}


def test_bins_hold_less_than_twice_the_target(spark, small_files):
    rows = read_lake(spark, small_files)
    target = 20_000
    totals, brands = {}, {}
    for row in compaction.file_bins(rows, target).collect():
        totals.setdefault((row["brand"], row["_bin"]), []).append(row["_size"])
        brands[row["brand"]] = brands.get(row["brand"], 0) + row["_size"]
    assert all(sum(own) < 2 * target or len(own) == 1 for own in totals.values())
    for brand, size in brands.items():
        assert sum(own == brand for own, _ in totals) <= size // target + 1
    assert sum(map(len, totals.values())) == len(sizes(rows))


def test_versions_equal_the_table_and_readers_go_on(spark, small_files, tmp_path, database):
    rows = read_lake(spark, small_files)
    view = f"{database}.products"
    first = compaction.publish_compacted(spark, view, small_files, str(tmp_path / "versions"))
    reading = spark.table(view)  # resolved before the next version
    assert len(sizes(spark.table(first))) == rows.select("brand").distinct().count() < len(sizes(rows)) / 3
    assert differing_partitions(rows, spark.table(view)).count() == 0
    write_lake(rows.limit(10), small_files)
    second = compaction.publish_compacted(spark, view, small_files, str(tmp_path / "versions"), target_bytes=10_000)
    before = reading.count()
    assert spark.table(view).count() == before + 10 == catalog.run_sql(spark, f"SELECT count(*) FROM {first}").first()[0] + 10
    assert compaction.drop_versions(spark, view, second) == [first]
    assert spark.table(view).count() == before + 10


def test_a_version_that_lost_rows_is_not_published(spark, small_files, tmp_path, database, monkeypatch):
    view = f"{database}.products"
    compaction.publish_compacted(spark, view, small_files, str(tmp_path / "versions"))
    before = spark.table(view).count()
    whole = compaction.read_lake
    monkeypatch.setattr(compaction, "read_lake", lambda spark, path, *o: (
        whole(spark, path, *o) if path == small_files else whole(spark, path, *o).limit(before - 1)))
    with pytest.raises(compaction.Unequal):
        compaction.publish_compacted(spark, view, small_files, str(tmp_path / "versions"))
    assert spark.table(view).count() == before


def test_empty_table(spark, small_files, tmp_path):
    empty, target = str(tmp_path / "empty"), str(tmp_path / "out")
    read_lake(spark, small_files).limit(0).write.parquet(empty)
    assert compaction.compacted(spark, empty, target).count() == 0
