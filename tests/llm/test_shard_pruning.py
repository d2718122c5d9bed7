"""Levels in order, the curve against a loop over bits, and which files a filter must open."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import hilbert_shards as hs

SCHEMA = "doc_id long, text string, lang string, source string, _level_source string"


def plain_index(point, bits):
    """The published transform of axes, one bit and axis at a time."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    return int("".join(str((one ^ flip) >> bit & 1) for bit in range(bits - 1, -1, -1) for one in x), 2)


@pytest.mark.parametrize(("axes", "bits"), [(2, 6), (3, 6), (4, 5), (3, 8)])
def test_curve_equals_a_loop(spark, axes, bits):
    rng = random.Random(axes)
    points = [[rng.randrange(1 << bits) for _ in range(axes)] for _ in range(300)]
    frame = spark.createDataFrame([(point,) for point in points], "x array<long>")
    found = frame.select("x", hs.hilbert_index([F.col("x")[i] for i in range(axes)], bits).alias("at")).collect()
    assert all(row["at"] == plain_index(row["x"], bits) for row in found)


def corpus(spark, n=4000):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        source = rng.choice([f"host{rng.randint(0, 19)}", "hot"]) if i % 50 else None
        rows.append((i, "x" * int(2 ** rng.uniform(0, 12)) if i % 31 else None, rng.choice(["en", "en", "de", "fr"]), source, "own"))
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_levels_keep_order_and_hold_equal_rows(spark):
    docs = corpus(spark)
    found, levels = hs.with_levels(docs)
    rows = found.select("doc_id", "source", "_level_source", hs.text_size(F.col("text")).alias("size"), *(
        level.alias(f"at_{name}") for name, level in levels.items())).collect()
    assert len(rows) == 4000 and {row["_level_source"] for row in rows} == {"own"}
    named = sorted({(row["source"], row["at_source"]) for row in rows if row["source"] is not None})
    assert [level for _, level in named] == sorted(level for _, level in named) and len(named) == 21
    assert {row["at_source"] for row in rows if row["source"] is None} == {0}
    by_size = sorted((row["size"], row["at_size"]) for row in rows)
    assert [level for _, level in by_size] == sorted(level for _, level in by_size)
    upper = sum(level >= 32 for _, level in by_size)
    assert abs(upper - 2000) < 120  # the first bit halves the rows
    assert 0 <= min(row["at_lang"] for row in rows) and max(row["at_lang"] for row in rows) < 16


def test_many_categories_are_summed_in_ranges(spark, settings):
    settings(spark__sql__shuffle__partitions="7")
    docs = spark.range(20_000).selectExpr("concat('h', lpad(cast(id % 5000 AS string), 5, '0')) AS source")
    levels = {row["value"]: row["level"] for row in hs.category_levels(docs, "source", 6).collect()}
    expected = {f"h{i:05d}": int((i * 4 + 2) / 20_000 * 63) + 1 for i in range(5000)}
    assert levels == expected


def test_files_of_few_shards_are_opened_for_a_range(spark, tmp_path):
    docs = corpus(spark).withColumn("size", hs.text_size(F.col("text")))
    hs.write_shards(docs, str(tmp_path / "out"), bits=6)
    told = {}
    for file in (tmp_path / "out").glob("shard=*/*.parquet"):
        meta = pq.read_metadata(file)
        for group in range(meta.num_row_groups):
            columns = {meta.row_group(group).column(i).path_in_schema: meta.row_group(group).column(i) for i in range(meta.num_columns)}
            for name in ("size", "source"):
                stats = columns[name].statistics
                if stats.has_min_max:
                    told.setdefault((file.parent.name, name), []).append((stats.min, stats.max))

    def opened(name, low, high):
        return sum(any(a <= high and b >= low for a, b in told.get((f"shard={i}", name), [])) for i in range(16))

    sizes = sorted(row[0] for row in docs.select("size").collect())
    twentieths = [opened("size", sizes[i * 200], sizes[i * 200 + 199]) for i in range(20)]
    assert max(twentieths) <= 9 and sum(twentieths) <= 6 * 20
    hosts = [opened("source", f"host{i}", f"host{i}") for i in range(20)]
    assert max(hosts) <= 8 and sum(hosts) <= 6 * 20


def test_levels_of_empty_and_uniform_tables(spark):
    docs = corpus(spark)
    for odd in (docs.limit(0), docs.withColumns({"source": F.lit(None).cast("string"), "text": F.lit("same"), "lang": F.lit("en")}).limit(50)):
        found, levels = hs.with_levels(odd)
        placed = hs.assign(found, levels, bits=6)
        assert placed.count() == odd.count()
