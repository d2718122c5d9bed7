"""Declared Avro record schemas as Spark schemas."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_SPARK_TYPES: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
    "double": DoubleType(), "boolean": BooleanType(), "bytes": BinaryType(),
}
_AVRO_TYPES = {kind: name for name, kind in _SPARK_TYPES.items()}


def avro_type(kind: DataType) -> str:
    """Avro name of a primitive Spark type."""
    return _AVRO_TYPES[kind]


def parse_avro_schema(text: str) -> StructType:
    """Record schema with primitive fields, each optionally in a union with null."""
    record = json.loads(text)
    if record.get("type") != "record":
        raise ValueError(f"not a record schema: type {record.get('type')!r}")
    return StructType([
        StructField(field["name"], _field_type(field)) for field in record["fields"]
    ])


def _field_type(field: dict) -> DataType:
    kinds = field["type"] if isinstance(field["type"], list) else [field["type"]]
    kinds = [kind for kind in kinds if kind != "null"]
    if len(kinds) != 1 or kinds[0] not in _SPARK_TYPES:
        raise ValueError(f"field {field['name']!r} has unsupported type {field['type']!r}")
    return _SPARK_TYPES[kinds[0]]


def read_avro_schema(spark: SparkSession, path: str) -> StructType:
    """Schema from a file on any file system that Spark reaches (one small file).

    A folder with several files is refused, as any one of them could be meant.
    """
    texts = [row[0] for row in spark.read.text(path, wholetext=True).take(2)]
    if len(texts) != 1:
        raise ValueError(f"{path} holds {'no' if not texts else 'more than one'} schema file")
    return parse_avro_schema(texts[0])


def to_avro_schema(schema: StructType, name: str) -> str:
    """Avro JSON text of a schema of primitive columns."""
    fields = [{"name": f.name, "type": avro_type(f.dataType)} for f in schema]
    return json.dumps({"type": "record", "name": name, "fields": fields})


#: What a value may become when it is read: of the format's own rules.
PROMOTIONS: dict[str, tuple[str, ...]] = {
    "int": ("int", "long", "float", "double"), "long": ("long", "float", "double"), "float": ("float", "double"),
    "double": ("double",), "string": ("string", "bytes"), "bytes": ("bytes", "string"), "boolean": ("boolean",),
}


@dataclass(frozen=True)
class RecordField:
    """A field: its types apart from null, whether null is one of them, and its default as (value,)."""

    name: str
    kinds: tuple[str, ...]
    nullable: bool = False
    default: tuple = ()
    aliases: tuple[str, ...] = ()

    @property
    def kind(self) -> str:
        """The narrowest type that all of a union's promote to."""
        for kind in (*self.kinds, *_SPARK_TYPES):
            if all(kind in PROMOTIONS[one] for one in self.kinds):
                return kind
        raise ValueError(f"field {self.name!r}: no type holds all of {self.kinds}")

    @property
    def spark_type(self) -> DataType:
        return _SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class Record:
    """A record schema with the parts that reading one schema's data by another needs."""

    name: str
    fields: tuple[RecordField, ...]

    @property
    def spark_schema(self) -> StructType:
        return StructType([StructField(field.name, field.spark_type) for field in self.fields])


def parse_record(text: str) -> Record:
    """Record schema of primitive fields, with unions, defaults and aliases."""
    record = json.loads(text)
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError(f"not a record schema: {text[:80]!r}")
    return Record(record.get("name", ""), tuple(_record_field(field) for field in record["fields"]))


def _record_field(field: dict) -> RecordField:
    kinds = field["type"] if isinstance(field["type"], list) else [field["type"]]
    if unknown := [kind for kind in kinds if kind != "null" and kind not in list(_SPARK_TYPES)]:
        raise ValueError(f"field {field['name']!r} has unsupported types {unknown}")
    own = tuple(kind for kind in kinds if kind != "null")
    if not own:
        raise ValueError(f"field {field['name']!r} holds nothing but null")
    default = (field["default"],) if "default" in field else ()
    found = RecordField(field["name"], own, "null" in kinds, default, tuple(field.get("aliases", ())))
    found.kind  # noqa: B018  raises if there is none
    return found


def resolve(writer: Record, reader: Record) -> list[tuple[RecordField, RecordField | None]]:
    """The writer's field that each of the reader's fields is read from, or none where its default counts.

    Raises where the format forbids to read the one by the other: a field without a
    counterpart or default, or a type that does not promote.
    """
    own = {field.name: field for field in writer.fields}
    pairs: list[tuple[RecordField, RecordField | None]] = []
    for field in reader.fields:
        found = next((own[name] for name in (field.name, *field.aliases) if name in own), None)
        if found is None and not field.default:
            raise ValueError(f"{reader.name}: {writer.name} has no field {field.name!r}, nor is there a default")
        if found is not None and not all(set(PROMOTIONS[one]) & set(field.kinds) for one in found.kinds):
            raise ValueError(f"{reader.name}: {field.name!r} is {found.kinds} in {writer.name}, which {field.kinds} can't hold")
        pairs.append((field, found))
    return pairs


def read_schema_folder(spark: SparkSession, path: str, most: int = 10_000) -> dict[str, Record]:
    """The schemas of a folder by id: the part of a file's name after its last underscore.

    Each schema becomes an expression of a plan, so more files than ``most`` are refused.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value").take(most + 1)
    if len(files) > most:
        raise ValueError(f"{path} holds more than {most} schemas")
    found: dict[str, Record] = {}
    for row in files:
        own = PurePosixPath(unquote(row["file"])).stem.rpartition("_")[2]
        if own in found:
            raise ValueError(f"{path} holds two schemas for {own!r}")
        found[own] = parse_record(row["value"])
    return found
