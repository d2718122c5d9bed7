import json

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import change_events as changes
from sluiceway.schemas import CHANGE, PRODUCT_COLUMNS, TOPIC_ROW

IMAGE = {
    "id": "1", "name": "n", "original_price": "MDk=", "price": "nA==", "brand": "b", "review_count": 3,
}
MESSAGES = {
    "row": json.dumps({"payload": {"after": IMAGE, "op": "c"}}),
    "row with schema": json.dumps({"schema": {"type": "struct"}, "payload": {"before": None, "after": IMAGE, "op": "u"}}),
    "row without op": json.dumps({"payload": {"after": IMAGE}}),
    "row of nothing": json.dumps({"payload": {"after": {}, "op": "r"}}),
    "row with extra": json.dumps({"payload": {"after": {**IMAGE, "more": [1, {"x": 2}]}, "op": "c"}}),
    "row with wrong types": json.dumps({"payload": {"after": {**IMAGE, "review_count": "3", "id": 7, "name": {"a": 1}}, "op": "c"}}),
    "delete": json.dumps({"payload": {"before": {"id": "1"}, "after": None, "op": "d"}}),
    "delete that keeps its image": json.dumps({"payload": {"before": {"id": "1"}, "after": IMAGE, "op": "d"}}),
    "tombstone": None,
    "malformed": "{bad",
    "malformed, cut off": json.dumps({"payload": {"after": IMAGE, "op": "c"}})[:-1],
    "malformed, empty": "",
    "malformed, other shape": json.dumps({"after": IMAGE}),
    "malformed, flat event": json.dumps({"schema": {}, "payload": None}),
    "malformed, number": "5",
    "empty": json.dumps({"payload": {"op": "c"}}),
    "empty, wrong type": json.dumps({"payload": {"after": 5, "op": "c"}}),
}


@pytest.fixture
def topic(spark):
    rows = [
        (name.encode(), None if text is None else text.encode(), "sales.public.products", 0, i, None, 0)
        for i, (name, text) in enumerate(MESSAGES.items())
    ]
    return spark.createDataFrame(rows, TOPIC_ROW)


def expected_kind(name):
    return name.split(",")[0].split(" ")[0]


def test_kinds(topic):
    found = {bytes(r.key).decode(): r.kind for r in changes.classified(topic).collect()}
    assert found == {name: expected_kind(name) for name in MESSAGES}


def test_every_message_is_a_row_or_a_reject(topic):
    """None lost, none twice; a row message is refused only if a value of it would be lost."""
    kept = changes.table_rows(topic).count()
    refused = {bytes(r.key).decode(): r.kind for r in changes.rejects(topic).collect()}
    lost = {name for name, kind in refused.items() if kind == changes.UNDECODABLE}
    assert "row with wrong types" in lost
    assert {name: kind for name, kind in refused.items() if name not in lost} == {
        name: expected_kind(name) for name in MESSAGES if expected_kind(name) != "row"}
    assert kept + len(refused) == len(MESSAGES)


def test_rejects_keep_the_message(topic):
    refused = changes.rejects(topic)
    assert refused.columns == ["kind", *TOPIC_ROW.names]
    by_name = {bytes(r.key).decode(): r.value for r in refused.collect()}
    assert by_name["tombstone"] is None
    assert bytes(by_name["malformed"]) == b"{bad"


def test_raw_images_have_a_row_per_message(topic):
    raw = changes.images_raw(topic)
    assert raw.columns == list(PRODUCT_COLUMNS)
    assert raw.count() == len(MESSAGES)
    nothing = raw.where(" AND ".join(f"{c} IS NULL" for c in PRODUCT_COLUMNS)).count()
    with_values = sum("IMAGE" not in n for n in MESSAGES if n.startswith("row") and "nothing" not in n) + 1
    assert nothing == len(MESSAGES) - with_values


def test_lost_values_are_refused(spark):
    after = {"id": "7", "price": "nA==", "review_count": 5}
    cases = [{}, {"price": ""}, {"price": None}, {"price": "!!"}, {"price": "AQEBAQEBAQEB"}, {"review_count": 3000000000},
             {"review_count": "x"}]
    text = [json.dumps({"payload": {"op": "c", "after": {**after, **case}}}) for case in cases]
    topic = spark.createDataFrame([(bytes(t, "utf8"), str(i)) for i, t in enumerate(text)], "value binary, key string")
    assert [str(r.price) for r in changes.table_rows(topic).collect()] == ["-1.00", "None", "None"]
    assert {r.key: r.kind for r in changes.rejects(topic).collect()} == dict.fromkeys("3456", changes.UNDECODABLE)


def test_signs(topic):
    row = topic.where(F.col("key") == b"row")
    assert str(changes.table_rows(row).first().price) == "-1.00"
    assert str(changes.table_rows(row, signed=False).first().price) == "1.56"


def test_messages_are_parsed_once(topic, plan):
    for result in (changes.table_rows(topic), changes.rejects(topic), changes.classified(topic)):
        physical = plan(result).split("Physical Plan")[1]
        assert physical.count("from_json(") == 1
        assert "EvalPython" not in physical
        assert "Exchange" not in physical


def test_only_listed_tables(spark, topic):
    other = topic.withColumn("topic", F.lit("sales.public.orders"))
    both = topic.unionAll(other)
    assert changes.of_tables(both).count() == len(MESSAGES)
    listed = changes.of_tables(both, ("sales", "public", "orders"), ("sales", "public", "products"))
    assert listed.count() == 2 * len(MESSAGES)


def test_table_filter_reaches_the_scan(spark, topic, tmp_path, plan):
    topic.write.parquet(str(tmp_path / "t"))
    captured = spark.read.parquet(str(tmp_path / "t"))
    assert "PushedFilters: [IsNotNull(topic), EqualTo(topic,sales.public.products)]" in plan(
        changes.of_tables(captured).select("offset")
    )


def test_routing(spark):
    df = spark.createDataFrame([("orders",), ("products",)], "t string")
    routed = changes.routed(df, "sales", "public", F.col("t"))
    assert [r.topic for r in routed.orderBy("t").collect()] == [
        "sales.public.orders", "sales.public.products",
    ]


def test_image_schema_is_the_declared_one():
    assert CHANGE["payload"].dataType["after"].dataType.names == list(PRODUCT_COLUMNS)
