import random
import re

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import topic_offsets as to

TOPIC = "topic string, partition int, offset long"


def read(spark, offsets, partition=0, topic="t"):
    return spark.createDataFrame([(topic, partition, one) for one in offsets], TOPIC)


def as_set(df):
    return {tuple(row) for row in df.collect()}


@pytest.mark.parametrize("offsets", [
    [0], [7], [0, 1, 2, 4, 9, 10], list(range(40_000)), list(range(32_768)), list(range(32_760, 32_776)),
    [32_767, 32_768, 65_535, 65_536, 65_538], [2**40, 2**40 + 1, 2**40 + 3], [5, 5, 6, 6, 6],
])
def test_intervals_equal_a_walk(spark, offsets):
    runs = []
    for one in sorted(set(offsets)):
        if runs and runs[-1][1] + 1 == one:
            runs[-1][1] = one
        else:
            runs.append([one, one])
    found = as_set(to.read_intervals(read(spark, offsets).repartition(3)))
    assert found == {("t", 0, first, last) for first, last in runs}


def test_intervals_of_reads_are_merged(spark):
    both = spark.createDataFrame(
        [("t", 0, 0, 9), ("t", 0, 10, 12), ("t", 0, 3, 5), ("t", 0, 20, 30), ("t", 0, 25, 26), ("t", 1, 13, 13), ("u", 0, 13, 14)],
        "topic string, partition int, first long, last long")
    assert as_set(to.merged(both)) == {("t", 0, 0, 12), ("t", 0, 20, 30), ("t", 1, 13, 13), ("u", 0, 13, 14)}
    assert as_set(to.gaps(to.merged(both))) == {("t", 0, 13, 19, 7)}
    assert as_set(to.gaps(to.merged(both), earliest=0)) == {("t", 0, 13, 19, 7), ("t", 1, 0, 12, 13), ("u", 0, 0, 12, 13)}


def test_only_bitmaps_are_shuffled(spark, plan):
    rows = spark.range(100_000, numPartitions=2).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    maps = to.offset_bitmaps(rows)
    assert maps.count() == 4
    text = plan(maps).split("== Physical Plan ==")[1]
    assert text.index("functions=[bitmap_construct_agg") < text.index("Exchange") < text.index("partial_bitmap_construct_agg")


def test_empty_topic(spark):
    assert to.gaps(to.read_intervals(read(spark, []))).count() == 0


def walk(intervals):
    runs = []
    for first, last in sorted(intervals):
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return runs


@pytest.mark.parametrize("longest", [3, 40, 400])
def test_stretches_change_nothing(spark, monkeypatch, longest):
    """Stretches of eight offsets, with intervals over many of them, null topics and rows that come twice."""
    monkeypatch.setattr(to, "STRETCH_BITS", 3)
    rng = random.Random(longest)
    own = {name: [(first, first + rng.randint(0, longest)) for first in (rng.randint(0, 3000) for _ in range(150))]
           for name in ("t", None)}
    rows = [(name, 0, *one) for name, pairs in own.items() for one in [*pairs, *pairs[:20]]]
    found = to.merged(spark.createDataFrame(rows, "topic string, partition int, first long, last long"))
    runs = {name: walk(pairs) for name, pairs in own.items()}
    assert sorted(map(str, found.collect())) == sorted(str(row) for row in spark.createDataFrame(
        [(name, 0, *run) for name in own for run in runs[name]], found.schema).collect())
    holes = {(name, 0, a[1] + 1, b[0] - 1, b[0] - a[1] - 1) for name in own for a, b in zip(runs[name], runs[name][1:])}
    assert as_set(to.gaps(found)) == holes
    start = {(name, 0, 0, runs[name][0][0] - 1, runs[name][0][0]) for name in own if runs[name][0][0] > 0}
    assert as_set(to.gaps(found, earliest=0)) == holes | start


def test_no_task_gets_all_intervals_of_a_partition(spark):
    """Every other offset was read: the tasks that merge get a stretch each, and one row of it goes on."""
    count = 4 * 2**to.STRETCH_BITS // 64
    every = spark.range(count).selectExpr("'t' AS topic", "0 AS partition", "id * 64 AS first", "id * 64 AS last")
    assert to.in_stretches(every).groupBy("_stretch").count().agg(F.max("count")).first()[0] == count / 4
    assert to.merged(every).count() == count and to.gaps(to.merged(every)).count() == count - 1


def test_windows_over_whole_partitions_see_stretches_only(spark, plan):
    every = spark.createDataFrame([("t", 0, 0, 9), ("t", 0, 20, 30)], "topic string, partition int, first long, last long")
    text = plan(to.gaps(every)).split("== Physical Plan ==")[1]
    whole = re.findall(r"windowspecdefinition\(topic#\d+, partition#\d+, ([a-z_]+)#", text)
    assert whole and set(whole) == {"_stretch"}


def test_messages_are_not_sorted(spark, plan):
    rows = spark.range(1000).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    text = plan(to.offset_words(rows)).split("== Physical Plan ==")[1]
    assert "Sort" not in text and text.index("functions=[bit_or(") < text.index("Exchange") < text.index("partial_bit_or")
