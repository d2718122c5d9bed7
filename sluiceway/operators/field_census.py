"""What fields messages have, against those that the declared schema takes.

A declared parse drops fields that it does not know and nulls values of another type, without
a trace. The census reads messages as variants and counts each leaf by path and type. Counts are
sums: they are combined before the shuffle, and censuses of several batches add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from sluiceway.functions.expressions import bytes_to_text
from sluiceway.schemas import CHANGE

#: Entries for whole messages that have no fields to count.
MALFORMED, TOMBSTONE = "malformed", "tombstone"
ELEMENT = "[]"
DECLARED, MISTYPED, EXTRA, UNSEEN, DEEPER = "declared", "mistyped", "extra", "unseen", "deeper"


def field_census(topic: DataFrame, depth: int = 8) -> DataFrame:
    """``path``, ``type`` and ``occurrences`` of every leaf of the messages.

    Names on a path are joined by dots, and ``[]`` stands for the elements of a list. A leaf is a
    value, a null, or an empty object or list. What lies below ``depth`` levels is one leaf with its
    whole type. Messages that are null or no JSON are counted with an empty path.
    """
    spark, text = topic.sparkSession, bytes_to_text(F.col("value"))
    rows = topic.select(
        F.col("value").isNull().alias("_null"), F.try_parse_json(text).alias("_leaf"), F.array().cast("array<string>").alias("_path"))
    for _ in range(depth):
        # An outer explode keeps leaves as they are: they have neither name nor place.
        parts = spark.tvf.variant_explode_outer(F.col("_leaf").outer())
        name = F.coalesce(F.col("key"), F.when(F.col("pos").isNotNull(), ELEMENT))
        rows = rows.lateralJoin(parts).select(
            "_null", F.when(F.col("pos").isNull(), F.col("_leaf")).otherwise(F.col("value")).alias("_leaf"),
            F.when(F.col("pos").isNull(), F.col("_path")).otherwise(F.concat("_path", F.array(name))).alias("_path"))
    kind = F.when(F.col("_null"), TOMBSTONE).when(F.col("_leaf").isNull(), MALFORMED).otherwise(F.schema_of_variant("_leaf"))
    return rows.groupBy(F.array_join("_path", ".").alias("path"), kind.alias("type")).agg(F.count("*").alias("occurrences"))


def added(*censuses: DataFrame) -> DataFrame:
    """One census of several, such as those of a stream's batches."""
    whole = censuses[0]
    for one in censuses[1:]:
        whole = whole.unionByName(one)
    return whole.groupBy("path", "type").agg(F.sum("occurrences").alias("occurrences"))


def declared_leaves(schema: DataType, path: str = "") -> dict[str, str]:
    """Type names of a schema's leaves by path."""
    if isinstance(schema, StructType):
        found: dict[str, str] = {}
        for field in schema:
            found |= declared_leaves(field.dataType, f"{path}.{field.name}" if path else field.name)
        return found
    if isinstance(schema, ArrayType):
        return declared_leaves(schema.elementType, f"{path}.{ELEMENT}")
    return {path: schema.simpleString()}


# Types of JSON values that a declared type takes without losing any: numbers of whole types are
# counted as BIGINT, others as DECIMAL or DOUBLE.
_TAKES = {
    "string": "STRING", "int": "BIGINT", "bigint": "BIGINT", "smallint": "BIGINT", "tinyint": "BIGINT", "boolean": "BOOLEAN",
    "float": "BIGINT|DOUBLE|DECIMAL.*", "double": "BIGINT|DOUBLE|DECIMAL.*",
}


def against_schema(census: DataFrame, schema: StructType = CHANGE) -> DataFrame:
    """The census with the ``declared`` type of each path and a ``status``.

    ``mistyped`` are values that the declared type does not take as they are: the parser nulls them
    or, for strings, writes them as text. ``extra`` are paths that it drops, ``deeper`` paths where
    a value stands for a declared object or the other way round. Declared fields that no message
    has are ``unseen``. Nulls are taken by every type.
    """
    leaves = declared_leaves(schema)
    entries = [(path, kind, _TAKES.get(kind, ".*") + "|VOID") for path, kind in leaves.items()]
    known = census.sparkSession.createDataFrame(entries, "path string, declared string, takes string")
    inner = sorted({path[:i] for path in leaves for i, letter in enumerate(path) if letter == "."})
    above = F.array(*map(F.lit, ["", *inner]))
    below = F.exists(F.array(*map(F.lit, sorted(leaves))), lambda leaf: F.startswith(F.col("path"), F.concat(leaf, F.lit("."))))
    status = (
        F.when(F.col("type").isNull(), UNSEEN)
        .when(F.col("declared").isNull() & F.col("type").isin(MALFORMED, TOMBSTONE) & (F.col("path") == ""), F.col("type"))
        .when(F.col("declared").isNull() & F.array_contains(above, F.col("path")) & (F.col("type") == "VOID"), DECLARED)
        .when(F.col("declared").isNull() & (F.array_contains(above, F.col("path")) | below), DEEPER)
        .when(F.col("declared").isNull(), EXTRA)
        .when(F.regexp_like("type", F.concat(F.lit("^("), F.col("takes"), F.lit(")$"))), DECLARED)
        .otherwise(MISTYPED))
    return census.join(known, "path", "full").select(
        "path", "type", F.coalesce("occurrences", F.lit(0)).cast("long").alias("occurrences"), "declared", status.alias("status"))
