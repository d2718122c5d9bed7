import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from sluiceway.operators import change_events as changes
from sluiceway.plans import catalog, jobs
from sluiceway.plans.ledger import Ledger, LoadId, LostRows
from sluiceway.schemas import LAKE_ROW, PRODUCT_COLUMNS, REJECT_ROW, TOPIC_ROW
from sluiceway.sources.lake import differing_partitions, read_lake, write_lake
from sluiceway.sources.topic import read_topic, write_topic
from sluiceway.streaming.changes import Sink, append_changes, append_routed, routed_rejects, routed_table, start_append, wait
from sluiceway.streaming.replay import replay


@pytest.fixture
def captured(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    fx.change_topic(fx.line_products(spark, sf_dir)).repartition(8).write.parquet(path)
    return path


@pytest.fixture
def sink(tmp_path):
    return lambda name, **o: Sink(
        str(tmp_path / name / "data"), str(tmp_path / name / "checkpoint"), until_caught_up=True, **o
    )


def stream(spark, path, **options):
    return read_topic(spark, path=path, format="parquet", **options)


def files(path, pattern):
    return len(list(Path(path).glob(f"{pattern}/*.parquet")))


def test_every_message_ends_in_one_sink(spark, captured, sink):
    rows, refused = sink("rows"), sink("refused")
    started = jobs.stream_changes(stream(spark, captured), rows, refused)
    assert len(started) == 2
    for query in started:
        wait(query, timeout=300)
    messages = spark.read.parquet(captured).count()
    kept = read_lake(spark, rows.path).count()
    kinds = read_lake(spark, refused.path, schema=REJECT_ROW).groupBy("kind").count()
    counts = {r.kind: r["count"] for r in kinds.collect()}
    assert set(counts) == {"malformed", "tombstone", "delete"}
    assert kept + sum(counts.values()) == messages


def test_stream_and_batch_write_the_same(spark, captured, sink):
    streamed, batch = sink("streamed"), sink("batch")
    wait(append_changes(stream(spark, captured, maxFilesPerTrigger=1), streamed), timeout=300)
    assert append_changes(stream(spark, captured, streaming=False), batch) is None
    one, other = read_lake(spark, streamed.path), read_lake(spark, batch.path)
    assert one.count() > 0
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_restart_adds_only_what_is_new(spark, captured, sink):
    target = sink("rows")

    def run():
        query = append_changes(stream(spark, captured), target)
        wait(query, timeout=300)
        return sum(p["numInputRows"] for p in query.recentProgress), read_lake(spark, target.path).count()

    first = run()
    assert first[0] > 0 and first[1] > 0
    assert run() == (0, first[1])
    spark.read.parquet(captured).where("partition = 0").write.mode("append").parquet(captured)
    assert run()[1] > first[1]


def test_batches_follow_the_file_limit(spark, captured, sink):
    query = append_changes(stream(spark, captured, maxFilesPerTrigger=3), sink("rows"))
    wait(query, timeout=300)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3  # of eight files


def test_frequent_brand_is_split(spark, captured, sink, settings):
    """A brand with a third of all rows, identical ones among them, is written by several
    tasks, batch and stream alike; rare brands are not scattered."""
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="32k")
    streamed, scattered = sink("streamed"), sink("scattered", gather=False)
    wait(append_changes(stream(spark, captured), streamed), timeout=300)
    wait(append_changes(stream(spark, captured), scattered), timeout=300)
    assert files(streamed.path, "brand=Brand%231") > 1
    assert files(streamed.path, "brand=Brand%237") == 1
    assert files(streamed.path, "*") < files(scattered.path, "*")
    same = spark.range(0, 200000, 1, 8).select(
        *(F.lit("Brand#1" if f.name == "brand" else None).cast(f.dataType).alias(f.name) for f in LAKE_ROW)
    )
    batch = sink("batch")
    write_lake(same, batch.path)
    assert files(batch.path, "brand=Brand%231") > 1
    assert read_lake(spark, batch.path).count() == 200000


def test_replay_in_portions(spark, tmp_path, sink):
    source = str(tmp_path / "source")
    spark.range(0, 90, 1, 3).write.csv(source, header=True)
    target = sink("replayed")
    query = start_append(replay(spark, source, "id bigint", files_per_batch=1), target)
    wait(query, timeout=300)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [30, 30, 30]
    assert spark.read.parquet(target.path).count() == 90
    by_bytes = start_append(
        replay(spark, source, "id bigint", bytes_per_batch=1), sink("by_bytes")
    )
    wait(by_bytes, timeout=300)
    assert len([p for p in by_bytes.recentProgress if p["numInputRows"]]) == 3


def test_paced_load_into_a_table(spark, sf_dir, tmp_path, database, monkeypatch):
    """Portions arrive one by one; one whose table write fails is loaded again, once."""
    source, rejects, name = str(tmp_path / "source"), str(tmp_path / "rejects"), f"{database}.products"
    rows = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    rows.repartition(2).write.parquet(source)
    catalog.recreate_table(spark, name, location=str(tmp_path / "table"), by_load=True)
    once, seen = catalog.replace_load, []

    def failing(df, table, load_id):
        once(df, table, load_id)
        seen.append(str(load_id))
        if len(seen) == 1:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(catalog, "replace_load", failing)
    for _ in range(2):
        arriving = replay(spark, source, rows.schema, "parquet", files_per_batch=1)
        query = jobs.start_paced_load(
            arriving, lambda part, id: jobs.load_catalog_table(part, name, rejects, id), str(tmp_path / "c"))
        try:
            query.awaitTermination()
        except Exception as error:
            assert "lost after the write" in str(error)
    own = json.loads((tmp_path / "c" / "metadata").read_text())["id"].replace("-", "_")
    assert seen == [f"{own}_0000000000", f"{own}_0000000000", f"{own}_0000000001"]
    whole = jobs.checked_products(rows)
    loaded = spark.table(name).drop(catalog.LOAD)
    assert loaded.exceptAll(whole.accepted).count() == 0 and loaded.count() == whole.accepted.count()
    kept = spark.read.parquet(rejects)
    assert kept.count() + loaded.count() == rows.count()
    counts = jobs.reject_counts(spark, rejects)
    assert counts.agg(F.sum("row_count")).first()[0] == kept.count()


@pytest.mark.parametrize("named", [True, False])
def test_two_paced_loads_keep_all_rows(spark, sf_dir, tmp_path, database, named):
    """Two sources, two checkpoints, one table: a load never takes the place of another one's rows."""
    name, rejects = f"{database}.products", str(tmp_path / "rejects")
    catalog.recreate_table(spark, name, location=str(tmp_path / "table"), by_load=True)
    ledger = Ledger.open(spark, f"{database}.loads", str(tmp_path / "ledger"))
    rows = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    rows.repartition(2).write.parquet(str(tmp_path / "source"))
    for one in ("first", "second"):
        arriving = replay(spark, str(tmp_path / "source"), rows.schema, "parquet", files_per_batch=1)
        wait(jobs.start_paced_load(
            arriving, lambda part, id: jobs.load_catalog_table(part, name, rejects, id, ledger),
            str(tmp_path / one), source=one if named else None), timeout=300)
    taken = jobs.checked_products(rows).accepted.count()
    assert spark.table(name).count() == 2 * taken
    assert jobs.reject_counts(spark, rejects).agg(F.sum("row_count")).first()[0] == 2 * (rows.count() - taken)
    entries = ledger.by_source().collect()
    assert len(entries) == 2 and ledger.unfinished().count() == 0
    assert {(e.portions, e.rows_in, e.rows_taken, e.rows_rejected, e.balanced) for e in entries} == {
        (2, rows.count(), taken, rows.count() - taken, True)}


def test_ledger_tells_of_loads_that_died_or_lost_rows(spark, sf_dir, tmp_path, database, monkeypatch):
    name, rejects = f"{database}.products", str(tmp_path / "rejects")
    catalog.recreate_table(spark, name, location=str(tmp_path / "table"), by_load=True)
    ledger = Ledger.open(spark, f"{database}.loads")
    rows = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    whole = catalog.replace_load
    with monkeypatch.context() as broken:
        broken.setattr(catalog, "replace_load", lambda df, table, load: whole(df.limit(3), table, load))
        with pytest.raises(LostRows, match="3 were taken"):
            jobs.load_catalog_table(rows, name, rejects, LoadId("short"), ledger)
        broken.setattr(catalog, "replace_load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.load_catalog_table(rows, name, rejects, LoadId("dead"), ledger)
    assert {(e.load_id, e.state) for e in ledger.unfinished().collect()} == {
        ("short_0000000000", "short"), ("dead_0000000000", "begun")}
    for source in ("short", "dead"):
        jobs.load_catalog_table(rows, name, rejects, LoadId(source), ledger)
    assert ledger.unfinished().count() == 0
    with pytest.raises(ValueError, match="a ledger needs"):
        jobs.load_catalog_table(rows, name, rejects, "plain", ledger)
    with pytest.raises(ValueError, match="letters, digits"):
        LoadId("a b")


def test_rejects_of_loads_with_and_without_id_are_counted(spark, sf_dir, tmp_path, database):
    name, rejects = f"{database}.products", str(tmp_path / "rejects")
    rows = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    lost = rows.count() - jobs.checked_products(rows).accepted.count()
    catalog.recreate_table(spark, name)
    for _ in range(2):
        jobs.load_catalog_table(rows, name, rejects)
    catalog.recreate_table(spark, name, by_load=True)
    for load in ("l1", "0000000001", "0000000001"):
        jobs.load_catalog_table(rows, name, rejects, load)
    counts = jobs.reject_counts(spark, rejects).groupBy(catalog.LOAD).agg(F.sum("row_count")).collect()
    assert {tuple(row) for row in counts} == {(None, 2 * lost), ("l1", lost), ("0000000001", lost)}


def test_routed_sink_parses_once_and_holds_both_parts(spark, captured, sink, tmp_path):
    topic = read_topic(spark, path=captured, format="parquet", streaming=False)
    target = sink("routed")
    query = append_routed(stream(spark, captured, maxFilesPerTrigger="1"), target)
    wait(query, timeout=300)
    plan = query._jsq.explainInternal(False).split("Initial Plan")[0]
    assert plan.count("from_json(") == 1 and plan.count("FileScan") == 1 and "EvalPython" not in plan
    wait(append_routed(stream(spark, captured), target), timeout=300)  # nothing twice
    rows, rejects = routed_table(spark, target.path), routed_rejects(spark, target.path)
    assert differing_partitions(changes.table_rows(topic), rows).count() == 0
    assert differing_partitions(changes.rejects(topic), rejects, "kind").count() == 0
    assert rows.count() + rejects.count() == topic.count()


def test_routed_batch_that_died_between_kinds_is_made_again(spark, captured, sink):
    """Files of a batch that has no commit are not read; the next run makes the batch anew."""
    target = sink("died")
    wait(append_routed(stream(spark, captured, maxFilesPerTrigger="1"), target), timeout=300)
    whole = routed_table(spark, target.path).count(), routed_rejects(spark, target.path).count()
    last = max((Path(target.path) / "_spark_metadata").glob("[0-9]*"), key=lambda one: int(one.name.split(".")[0]))
    for folder in (last.parent, Path(target.checkpoint) / "commits"):
        for one in (last.name, f".{last.name}.crc"):
            (folder / one).unlink()
    assert routed_table(spark, target.path).count() < whole[0]
    wait(append_routed(stream(spark, captured, maxFilesPerTrigger="1"), target), timeout=300)
    assert (routed_table(spark, target.path).count(), routed_rejects(spark, target.path).count()) == whole


def test_digests_find_what_counts_miss(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 3, "y"), (None, 4, "z"), (None, 4, "z")], "brand string, n int, t string")
    assert differing_partitions(rows, rows.repartition(3).orderBy(F.rand(1))).count() == 0
    moved = rows.withColumn("n", F.when(F.col("n") == 2, 1).when(F.col("n") == 1, 2).otherwise(F.col("n")))
    assert [tuple(row) for row in differing_partitions(rows, moved).collect()] == [("a", 2, 2)]
    assert [tuple(row) for row in differing_partitions(rows, rows.distinct()).collect()] == [(None, 2, 1)]
    swapped = rows.select("brand", "n", F.when(F.col("n") == 3, None).otherwise(F.col("t")).alias("t"))
    assert differing_partitions(rows, swapped).count() == 1
    assert differing_partitions(rows, rows.limit(0)).count() == 3
    with pytest.raises(ValueError, match="columns differ"):
        differing_partitions(rows, rows.drop("t"))


def test_paced_query_keeps_running(spark, captured, tmp_path):
    paced = Sink(str(tmp_path / "p" / "data"), str(tmp_path / "p" / "checkpoint"), interval="1 second", name="paced")
    query = append_changes(stream(spark, captured), paced)
    with pytest.raises(TimeoutError):
        wait(query, timeout=1)
    assert not query.isActive


def test_published_messages_can_be_subscribed_to(spark, tmp_path):
    path = str(tmp_path / "topic")
    values = spark.range(3).select(
        F.lit("sales.public.products").alias("topic"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value")
    )
    write_topic(values, path=path, format="parquet")
    back = read_topic(spark, path=path, format="parquet", streaming=False)
    assert back.schema.names == TOPIC_ROW.names
    assert sorted(bytes(r.value) for r in back.collect()) == [b"0", b"1", b"2"]


def test_stream_plan_has_no_python_and_one_shuffle(spark, captured, sink):
    query = append_changes(stream(spark, captured), sink("rows"))
    wait(query, timeout=300)
    plan = query._jsq.explainInternal(False)
    final = plan.split("Initial Plan")[0]
    assert "EvalPython" not in plan
    assert final.count("from_json(") == 1
    assert final.count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_COL" in final
