import pytest

from rivulet.operators import changes
from rivulet.operators.envelope import LogPosition

SCHEMA = "file string, pos long, ts long, server_id long, database string, collection string, action string, rows array<struct<id: long, name: string>>"


def log(spark, events):
    return spark.createDataFrame([(f, p, 60, 1, "db", "users", a, r) for f, p, a, r in events], SCHEMA)


def test_operations_and_images(spark):
    df = log(spark, [("b.9", 4, "insert", [(1, "a"), (2, "b")]), ("b.9", 9, "update", [(1, "a"), (1, "c")]), ("b.10", 4, "delete", [(2, "b")]), ("b.10", 7, "ddl", [])])
    rows = changes.records(df, ("id",)).orderBy(changes.file_number(changes.F.col("position.name")), "position.pos", "position.idx").collect()
    assert [(r.operation, r.key.id, r.before and r.before.name, r.after and r.after.name, r.position.idx) for r in rows] == [("create", 1, None, "a", 0), ("create", 2, None, "b", 1), ("update", 1, "a", "c", 0), ("delete", 2, "b", None, 0)]
    assert [r.position.prev and tuple(r.position.prev) for r in rows] == [None, None, ("b.9", 4), ("b.9", 9)]
    assert rows[0].metadata["created_at"] == "1970-01-01T00:01:00Z"


def test_restart_inside_an_event_keeps_indexes(spark):
    df = log(spark, [("b.1", 4, "insert", [(i, "x") for i in range(10, 100)]), ("b.1", 9, "insert", [(i, "x") for i in range(110, 130)])])
    rest = changes.records(df, ("id",), LogPosition("b.1", 4, 15)).collect()
    assert sorted(r.key.id for r in rest) == [*range(26, 100), *range(110, 130)]
    assert {r.key.id: r.position.idx for r in rest}[26] == 16
    again = changes.records(df, ("id",), LogPosition("b.1", 4, 40)).collect()
    assert sorted(r.key.id for r in again) == [*range(51, 100), *range(110, 130)]


def test_odd_images_fail(spark):
    with pytest.raises(Exception, match="odd number"):
        changes.pairs(log(spark, [("b.1", 4, "update", [(1, "a")])])).collect()
    assert changes.pairs(log(spark, [("b.1", 4, "update", []), ("b.1", 5, "insert", [])])).count() == 0


def test_file_numbers_order_names(spark):
    df = log(spark, [("b.999", 4, "insert", [(1, "a")]), ("b.1000", 4, "insert", [(2, "a")])])
    assert [r.key.id for r in changes.records(df, ("id",), LogPosition("b.999", 4, 0)).collect()] == [2]
    assert changes.head(df).name == "b.1000"
    assert changes.head(df.limit(0)) is None


def test_key_without_primary_key(spark):
    assert [r.key for r in changes.records(log(spark, [("b.1", 4, "insert", [(1, "a"), (2, "a")])]), ()).collect()] == ["b.1_4", "b.1_4"]
