"""Column expressions that bring values to their Avro types.

``nulls="zero"`` replaces null by the type's zero value, ``"keep"`` leaves it.
A number that does not fit its type fails the query; text that is no number
fails it too, unless ``strict`` is off, which makes it null before the zero rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import SPARK_OF_AVRO, AvroColumn, columns_of

INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def zero(avro: str) -> Column:
    """The zero value of an Avro type."""
    zeros = {"string": F.lit(""), "bytes": F.lit(b""), "int": F.lit(0), "long": F.lit(0).cast("long"), "float": F.lit(0.0).cast("float"), "double": F.lit(0.0), "boolean": F.lit(False), "fixed": F.lit(bytes(8))}
    return zeros[avro]


def int_to_bytes(value: Column) -> Column:
    """Eight bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))


def last_eight(value: Column) -> Column:
    """The last eight bytes, with zero bytes before shorter values."""
    n = F.octet_length(value)
    tail = F.substring(value, F.greatest(n - 7, F.lit(1)), F.lit(8))
    return F.unhex(F.lpad(F.hex(tail), 16, "0"))


def bytes_to_long(value: Column) -> Column:
    """Big-endian bytes as a long; no bytes are 0, and more than eight fail."""
    wide = F.octet_length(value) > 8
    unsigned = F.conv(F.hex(last_eight(value)), 16, 10).cast("decimal(20,0)")
    signed = F.when(unsigned > F.lit("9223372036854775807").cast("decimal(20,0)"), unsigned - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(unsigned)
    return F.when(wide, F.raise_error(F.lit("more than eight bytes for a long"))).when(F.octet_length(value) == 0, F.lit(0)).otherwise(signed).cast("long")


def narrow(value: Column, kind: str, strict: bool) -> Column:
    """A cast that fails, or gives null, where the value does not fit."""
    return value.cast(kind) if strict else value.try_cast(kind)


def date_text(value: Column, kind: T.DataType) -> Column:
    """Dates and times as ISO text; a text that is a date alone gets a midnight, other texts stay."""
    if isinstance(kind, T.StringType):
        midnight = F.date_format(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.coalesce(midnight, value)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return value.cast("string")


def normalized(value: Column, kind: T.DataType, column: AvroColumn, nulls: str = "zero", strict: bool = True) -> Column:
    """``value``, of Spark type ``kind``, as the Avro type of ``column``."""
    avro, binary, text = column.avro, isinstance(kind, T.BinaryType), isinstance(kind, T.StringType)
    if avro == "string" and column.is_date and not binary:
        out = date_text(value, kind)
    elif avro == "string":
        out = F.decode(value, "UTF-8") if binary else value.cast("string")
    elif avro in ("int", "long"):
        out = narrow(bytes_to_long(value) if binary else value, "int" if avro == "int" else "bigint", strict)
    elif avro in ("float", "double"):
        out = narrow(F.decode(value, "UTF-8") if binary else F.trim(value) if text else value, avro, strict)
    elif avro == "boolean":
        out = value != 0 if isinstance(kind, INTS) else value.cast("boolean")
    elif avro == "fixed":
        out = last_eight(value) if binary else int_to_bytes(value)
    else:
        out = F.encode(value, "UTF-8") if text else value
    if nulls == "keep":
        return out
    if nulls != "zero":
        raise ValueError(f"nulls is zero or keep, not {nulls}")
    return F.coalesce(out, zero(avro))


def normalize(df: DataFrame, columns: list[AvroColumn] | None = None, nulls: str = "zero", strict: bool = True) -> DataFrame:
    """All columns of ``df`` at their Avro types; columns that have no type given stay as they are."""
    by_name = {c.name: c for c in (columns if columns is not None else columns_of(df.schema))}
    return df.select(*[normalized(F.col(f"`{f.name}`"), f.dataType, by_name[f.name], nulls, strict).alias(f.name) if f.name in by_name else F.col(f"`{f.name}`") for f in df.schema.fields])


def spark_type(column: AvroColumn) -> T.DataType:
    return SPARK_OF_AVRO[column.avro]
