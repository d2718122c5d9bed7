import json

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import event_schemas as es
from sluiceway.sources.avro_schema import parse_record, read_schema_folder, resolve


def record(*fields, name="R"):
    return parse_record(json.dumps({"type": "record", "name": name, "fields": list(fields)}))


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


def test_types_that_promote_and_those_that_do_not():
    for kind, wider in (("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"),
                        ("float", "double"), ("string", "bytes"), ("bytes", "string")):
        assert resolve(record(field("a", kind)), record(field("a", wider)))[0][1].kind == kind
    for kind, narrower in (("long", "int"), ("double", "float"), ("string", "int"), ("boolean", "int"), ("int", "string")):
        with pytest.raises(ValueError, match="can't hold"):
            resolve(record(field("a", kind)), record(field("a", narrower)))


def test_fields_without_counterpart_need_a_default():
    with pytest.raises(ValueError, match="default"):
        resolve(record(field("a", "int")), record(field("b", "int")))
    assert resolve(record(field("a", "int")), record(field("b", "int", default=3)))[0][1] is None
    assert resolve(record(field("a", "int")), record(field("b", "int", aliases=["a"])))[0][1].name == "a"


def test_unions():
    assert record(field("a", ["null", "int", "double"])).fields[0].kind == "double"
    assert record(field("a", ["null", "int"])).fields[0].nullable
    with pytest.raises(ValueError, match="no type holds"):
        record(field("a", ["int", "string"]))
    with pytest.raises(ValueError, match="unsupported"):
        record(field("a", {"type": "array", "items": "int"}))
    with pytest.raises(ValueError, match="nothing but null"):
        record(field("a", "null"))


def test_folder_of_schemas(spark, tmp_path):
    text = json.dumps({"type": "record", "name": "P", "fields": [field("name", "string")]})
    for own in ("0", "17"):
        (tmp_path / f"products_schema_{own}.avsc").write_text(text)
    found = read_schema_folder(spark, str(tmp_path))
    assert set(found) == {"0", "17"} and found["0"] == found["17"]
    with pytest.raises(ValueError, match="more than 1"):
        read_schema_folder(spark, str(tmp_path), most=1)
    (tmp_path / "other_17.avsc").write_text(text)
    with pytest.raises(ValueError, match="two schemas"):
        read_schema_folder(spark, str(tmp_path))


def message(own, payload):
    return (own.encode() if own is not None else None, payload.encode() if payload is not None else None)


def test_every_message_is_an_event_or_rejected(spark, plan):
    old, new = record(field("a", "int")), record(field("a", "long"), field("b", ["null", "string"]))
    reader = record(field("a", "double"), field("b", ["null", "string"], default="none"))
    schemas = {"1": old, "2": new, "3": old}
    rows = [
        message("1", '{"payload":{"a":4}}'), message("2", '{"payload":{"a":5,"b":"x"}}'), message("3", '{"payload":{"a":6}}'),
        message("2", '{"payload":{"a":7}}'), message("1", '{"payload":{"a":null}}'), message("1", '{"payload":{"a":"4"}}'),
        message("1", "{bad"), message("1", None), message("9", '{"payload":{"a":4}}'), message(None, '{"payload":{"a":4}}'),
        message("1", '{"payload":{"a":3000000000}}'), message("1", "{}"),
    ]
    messages = spark.createDataFrame(rows, "key binary, value binary")
    events = es.events_by_id(messages, schemas, reader)
    assert {tuple(row) for row in events.collect()} == {(4.0, "none"), (5.0, "x"), (6.0, "none"), (7.0, None)}
    rejected = es.rejected_events(messages, schemas, reader)
    assert sorted(rejected.select("reason").toPandas()["reason"]) == sorted(
        ["null in a", "malformed", "malformed", "malformed", "no schema", "no schema", "malformed", "malformed"])
    assert rejected.columns == ["reason", "key", "value"]
    # Two distinct schemas: two parses in the plan, of which a row takes one.
    assert plan(events).split("== Physical Plan ==")[1].count("from_json(") == 2


def test_written_events_are_read_back(spark):
    schemas = {"1": record(field("a", "int"), field("c", "string", default="d")), "2": record(field("a", "float"))}
    rows = spark.createDataFrame([(1, 3.0), (2, 4.5), (3, 1.0)], "product_id int, a double")
    messages = es.messages_by_id(rows, schemas, F.lit("2024-01-01 00:00:00"))
    reader = record(field("a", "double"), field("c", ["null", "string"], default=None))
    assert {tuple(row) for row in es.events_by_id(messages, schemas, reader).collect()} == {(3.0, "d"), (4.5, None)}
    assert es.rejected_events(messages, schemas, reader).count() == 1
