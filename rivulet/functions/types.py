"""Relational column types, their Avro and Spark types, and a schema registry."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import types as T

# Avro type of each column type as a result set names it.
SNAPSHOT_AVRO = {
    "TINYINT": "int", "SMALLINT": "int", "MEDIUMINT": "int", "INT": "int", "BIGINT": "long",
    "UNSIGNED TINYINT": "int", "UNSIGNED SMALLINT": "int", "UNSIGNED MEDIUMINT": "int", "UNSIGNED INT": "long", "UNSIGNED BIGINT": "long",
    "FLOAT": "float", "DOUBLE": "double", "DECIMAL": "double", "NUMERIC": "double", "BIT": "fixed",
    "CHAR": "string", "VARCHAR": "string", "TINYTEXT": "string", "TEXT": "string", "MEDIUMTEXT": "string", "LONGTEXT": "string",
    "BINARY": "bytes", "VARBINARY": "bytes", "TINYBLOB": "bytes", "BLOB": "bytes", "MEDIUMBLOB": "bytes", "LONGBLOB": "bytes",
    "DATE": "string", "TIME": "string", "DATETIME": "string", "TIMESTAMP": "string", "YEAR": "int",
    "ENUM": "string", "SET": "string", "JSON": "string", "POINT": "string",
}
DATES = {"DATE", "TIME", "DATETIME", "TIMESTAMP"}
SUBJECT_NAMESPACE = "mysql"
FIXED_SIZE = 8

# Spark type that carries each Avro type.
SPARK_OF_AVRO = {"int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(), "fixed": T.BinaryType(), "boolean": T.BooleanType()}


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class UnsupportedType(ValueError):
    """A column has a type without an Avro equivalent."""


@dataclass(frozen=True)
class AvroColumn:
    name: str
    avro: str
    is_date: bool = False

    def field(self) -> dict:
        if self.avro == "fixed":
            return {"name": self.name, "type": {"name": f"{self.name}_fixed", "type": "fixed", "size": FIXED_SIZE}}
        return {"name": self.name, "type": self.avro}


def snapshot_column(name: str, type_name: str) -> AvroColumn:
    """A column of a result set, by the type name that the database gives it."""
    key = " ".join(type_name.upper().split())
    if key.endswith(" UNSIGNED"):
        key = f"UNSIGNED {key.removesuffix(' UNSIGNED')}"
    if key not in SNAPSHOT_AVRO:
        raise UnsupportedType(f"column {name}: type {type_name} has no Avro type")
    return AvroColumn(name, SNAPSHOT_AVRO[key], key in DATES)


def log_column(name: str, raw_type: str) -> AvroColumn:
    """A column of the change log, by its declared type such as ``int(11) unsigned``."""
    words = re.sub(r"\([^)]*\)", "", raw_type).lower().split()
    unsigned = "unsigned" in words
    base = [w for w in words if w not in ("unsigned", "zerofill", "signed")]
    if not base:
        raise UnsupportedType(f"column {name}: empty type")
    kind = {"integer": "int", "dec": "decimal", "real": "double", "bool": "tinyint", "boolean": "tinyint"}.get(base[0], base[0])
    return snapshot_column(name, f"unsigned {kind}" if unsigned and kind.endswith("int") else kind)


def spark_column(name: str, kind: T.DataType) -> AvroColumn:
    """A column of a DataFrame."""
    avro = {T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.DecimalType: "double", T.StringType: "string", T.VarcharType: "string", T.CharType: "string", T.BinaryType: "bytes", T.DateType: "string", T.TimestampType: "string", T.TimestampNTZType: "string", T.BooleanType: "boolean"}.get(type(kind))
    if avro is None:
        raise UnsupportedType(f"column {name}: type {kind.simpleString()} has no Avro type")
    return AvroColumn(name, avro, isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)))


def columns_of(schema: T.StructType) -> list[AvroColumn]:
    return [spark_column(f.name, f.dataType) for f in schema.fields]


def record_schema(name: str, columns: list[AvroColumn]) -> dict:
    return {"name": f"{SUBJECT_NAMESPACE}.{name}", "type": "record", "fields": [c.field() for c in columns]}


def canonical(schema: dict) -> str:
    return json.dumps(schema, separators=(",", ":"))


def struct_of(columns: list[AvroColumn]) -> T.StructType:
    return T.StructType([T.StructField(c.name, SPARK_OF_AVRO[c.avro]) for c in columns])


@dataclass
class SchemaRegistry:
    """Versions of schemas by subject; the same schema registered again keeps its version.

    With a ``path`` (any file system that pyarrow knows) versions are kept in that file,
    so they outlive the driver.  One driver writes at a time.
    """

    versions: dict[str, list[str]] = field(default_factory=dict)
    path: str | None = None

    def __post_init__(self) -> None:
        if self.path:
            fs, place = filesystem(self.path)
            if fs.get_file_info(place).type == pafs.FileType.File:
                with fs.open_input_stream(place) as f:
                    self.versions = json.loads(f.read())

    def save(self) -> None:
        """Write all versions beside the file and put them in its place."""
        fs, place = filesystem(self.path)
        fs.create_dir(place.rpartition("/")[0] or ".", recursive=True)
        with fs.open_output_stream(f"{place}.new") as f:
            f.write(json.dumps(self.versions).encode())
        fs.move(f"{place}.new", place)

    def register(self, subject: str, schema: dict) -> tuple[str, int]:
        known = self.versions.setdefault(subject, [])
        text = canonical(schema)
        if text not in known:
            known.append(text)
            if self.path:
                self.save()
        return subject, known.index(text) + 1

    def get(self, subject: str, version: int) -> dict:
        return json.loads(self.versions[subject][version - 1])

    def payload(self, table: str, columns: list[AvroColumn]) -> tuple[str, int]:
        return self.register(f"{SUBJECT_NAMESPACE}.{table}_payload", record_schema(f"{table}_payload", columns))

    def key(self, table: str, columns: list[AvroColumn], keys: tuple[str, ...]) -> tuple[str, int]:
        by_name = {c.name: c for c in columns}
        if missing := [k for k in keys if k not in by_name]:
            raise KeyError(f"table {table} has no key column {', '.join(missing)}")
        return self.register(f"{SUBJECT_NAMESPACE}.{table}_key", record_schema(f"{table}_key", [by_name[k] for k in keys]))
