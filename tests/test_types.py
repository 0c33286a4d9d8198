import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import normalize as norm
from rivulet.functions import types as K

CASES = [
    ("tinyint(1)", "int"), ("smallint", "int"), ("mediumint(3)", "int"), ("int(5)", "int"), ("bigint(11)", "long"), ("int(8) unsigned", "long"), ("bigint unsigned", "long"),
    ("tinyint(1) unsigned", "int"), ("decimal(10,2)", "double"), ("float(24)", "float"), ("double(10,2)", "double"), ("char(10)", "string"), ("longtext", "string"),
    ("binary(10)", "bytes"), ("tinyblob", "bytes"), ("date", "string"), ("year", "int"), ("json", "string"), ("enum('a','b')", "string"), ("bit(8)", "fixed"), ("point", "string"),
]


@pytest.mark.parametrize(("raw", "avro"), CASES)
def test_log_types(raw, avro):
    assert K.log_column("c", raw).avro == avro


def test_snapshot_types():
    assert K.snapshot_column("c", "UNSIGNED INT").avro == "long"
    assert K.snapshot_column("c", "INT UNSIGNED").avro == "long"
    assert K.snapshot_column("c", "DATETIME") == K.AvroColumn("c", "string", True)
    with pytest.raises(K.UnsupportedType):
        K.snapshot_column("c", "GEOMETRY")
    assert K.AvroColumn("b", "fixed").field() == {"name": "b", "type": {"name": "b_fixed", "type": "fixed", "size": 8}}


def test_registry():
    r, columns = K.SchemaRegistry(), [K.AvroColumn("id", "int"), K.AvroColumn("f1", "string")]
    assert r.key("t", columns, ("f1",)) == ("mysql.t_key", 1)
    assert r.get("mysql.t_key", 1)["fields"] == [{"name": "f1", "type": "string"}]
    assert r.payload("t", columns) == r.payload("t", columns) == ("mysql.t_payload", 1)
    assert r.payload("t", columns[:1]) == ("mysql.t_payload", 2)
    with pytest.raises(KeyError):
        r.key("t", columns, ("x",))


def one(spark, value, kind, avro, **more):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", kind)]))
    return norm.normalize(df, [K.AvroColumn("c", avro, more.pop("is_date", False))], **more).first()[0]


@pytest.mark.parametrize(
    ("value", "kind", "avro", "want"),
    [
        (b"\x01\x02", T.BinaryType(), "long", 258),
        (b"\xff" * 8, T.BinaryType(), "long", -1),
        (b"", T.BinaryType(), "long", 0),
        (b"123456789", T.BinaryType(), "fixed", b"23456789"),
        (b"\xab", T.BinaryType(), "fixed", bytes(7) + b"\xab"),
        (1, T.LongType(), "fixed", bytes(7) + b"\x01"),
        (-1, T.LongType(), "fixed", b"\xff" * 8),
        (None, T.LongType(), "fixed", bytes(8)),
        (b"123.5", T.BinaryType(), "double", 123.5),
        ("é", T.StringType(), "bytes", "é".encode()),
        (b"caf\xc3\xa9", T.BinaryType(), "string", "café"),
        (2, T.IntegerType(), "boolean", True),
        (None, T.StringType(), "string", ""),
        (None, T.BinaryType(), "bytes", b""),
        (None, T.DoubleType(), "float", 0.0),
        (2147483647, T.LongType(), "int", 2147483647),
    ],
)
def test_values(spark, value, kind, avro, want):
    got = one(spark, value, kind, avro)
    assert (bytes(got) if isinstance(got, bytearray) else got) == want


def test_misfits(spark):
    assert one(spark, None, T.StringType(), "string", nulls="keep") is None
    assert one(spark, 1 << 40, T.LongType(), "int", strict=False) == 0
    for value, kind, avro in ((1 << 40, T.LongType(), "int"), ("x", T.StringType(), "double"), (bytes(9), T.BinaryType(), "long")):
        with pytest.raises(Exception, match="CAST|overflow|more than eight"):
            one(spark, value, kind, avro)


def test_dates(spark):
    assert one(spark, "2024-02-03", T.StringType(), "string", is_date=True) == "2024-02-03T00:00:00Z"
    assert one(spark, "12:30:00", T.StringType(), "string", is_date=True) == "12:30:00"
    assert one(spark, dt.datetime(2024, 2, 3, 4, 5, 6), T.TimestampNTZType(), "string", is_date=True) == "2024-02-03T04:05:06Z"


def test_unknown_columns_stay(spark):
    df = spark.range(1).select(F.lit("x").alias("a b"), F.lit(None).cast("string").alias("c"))
    assert tuple(norm.normalize(df, [K.AvroColumn("c", "string")]).first()) == ("x", "")
