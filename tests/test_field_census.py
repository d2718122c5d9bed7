from pyspark.sql import functions as F

from checks import fixtures as fx
from sluiceway.operators import field_census as fc
from sluiceway.operators.change_events import images


def messages(spark, *texts):
    rows = [(None if text is None else text.encode(),) for text in texts]
    return spark.createDataFrame(rows, "value binary")


def census(spark, *texts, **options):
    return {tuple(row) for row in fc.field_census(messages(spark, *texts), **options).collect()}


def test_every_leaf_is_counted_by_path_and_type(spark):
    found = census(spark, '{"a":1,"b":{"c":[1,"x",[true]],"d":{}}}', '{"a":2.5,"b":[]}', "7", "[]", None, "{", '{"a":1,"a":2}', '{"a":null}')
    assert found == {
        ("a", "BIGINT", 1), ("b.c.[]", "BIGINT", 1), ("b.c.[]", "STRING", 1), ("b.c.[].[]", "BOOLEAN", 1), ("b.d", "OBJECT<>", 1),
        ("a", "DECIMAL(2,1)", 1), ("b", "ARRAY<VOID>", 1), ("", "BIGINT", 1), ("", "ARRAY<VOID>", 1), ("", "tombstone", 1),
        ("", "malformed", 2), ("a", "VOID", 1)}


def test_what_lies_deeper_is_one_leaf(spark):
    assert census(spark, '{"a":{"b":{"c":1}}}', depth=2) == {("a.b", "OBJECT<c: BIGINT>", 1)}


def test_censuses_add_up_and_nothing_is_parsed_twice(spark, sf_dir, plan):
    topic = fx.as_topic(fx.table(spark, sf_dir, "part").selectExpr("p_partkey AS seq", f"{fx.FIELD_CHANGE} AS value"))
    halves = [fc.field_census(topic.where(F.col("offset") % 2 == half)) for half in (0, 1)]
    whole = fc.field_census(topic)
    assert {tuple(row) for row in fc.added(*halves).collect()} == {tuple(row) for row in whole.collect()}
    physical = plan(fc.field_census(topic)).split("== Physical Plan ==")[1]
    assert physical.count("parseJson(") == 1 and "Join" not in physical and physical.count("Exchange") == 1


def test_mistyped_values_are_those_that_the_parser_loses(spark, sf_dir):
    """Counts of nulls in the declared parse are the nulls and mistyped values of the census."""
    topic = fx.as_topic(fx.table(spark, sf_dir, "part").selectExpr("p_partkey AS seq", f"{fx.FIELD_CHANGE} AS value"))
    lost = images(topic).where("review_count IS NULL").count()
    told = fc.against_schema(fc.field_census(topic)).where("path = 'payload.after.review_count' AND status = 'mistyped'")
    assert told.agg(F.sum("occurrences")).first()[0] == lost > 0


def test_empty_topic(spark):
    found = fc.against_schema(fc.field_census(messages(spark).limit(0)))
    assert found.where("status <> 'unseen'").count() == 0 and found.count() > 10
