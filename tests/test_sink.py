import datetime as dt
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivulet.operators import sink
from rivulet.operators.tables import FileTable


def batches(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, collection string, operation string")
    return [r.batch for r in sink.run_batches(df).orderBy("seq").collect()]


def test_runs(spark):
    assert batches(spark, [("t", "create")] * 3) == [0, 0, 0]
    assert batches(spark, [("t", "create"), ("t", "delete"), ("t", "update")]) == [0, 1, 2]
    assert batches(spark, [("t1", "create"), ("t2", "snapshot"), ("t1", "update")]) == [0, 1, 2]
    for bad in (("", "create"), (None, "create"), ("t", "truncate"), ("t", None)):
        with pytest.raises(Exception, match="no collection|unknown operation"):
            batches(spark, [bad])


def test_keys_are_asked_for(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    for call in (lambda: sink.delete(df, df, []), lambda: sink.delete(df, df, ["x"]), lambda: sink.upsert(df, df.withColumn("seq", df.id).withColumn("y", df.id), ["id"]), lambda: sink.append(df, df.select("id", df.id.alias("seq")))):
        with pytest.raises(sink.SinkError):
            call()


def test_null_keys_match_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "id long, v string")
    assert [r.v for r in sink.delete(df, df, ["id"]).collect()] == ["a"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["create", "update", "delete", "snapshot"]), st.integers(1, 4), st.integers(0, 9)), max_size=12))
def test_replay_is_one_by_one(spark, ops):
    state = {1: 100, 2: 200}
    target = spark.createDataFrame(list(state.items()), "id long, v long")
    for op, k, v in ops:
        state.pop(k, None) if op == "delete" else state.update({k: v})
    records = spark.createDataFrame([(i, *o) for i, o in enumerate(ops)], "seq long, operation string, id long, v long")
    assert dict(map(tuple, sink.replay(target, records, ["id"]).collect())) == state


def test_moved_keys(spark):
    target = spark.createDataFrame([(1, "a")], "id long, v string")
    image = "struct<id: long, v: string>"
    rec = spark.createDataFrame([(0, "update", (1, "a"), (2, "b"))], f"seq long, operation string, before {image}, after {image}")
    assert sorted(map(tuple, sink.replay_images(target, rec, ["id"]).collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, sink.replay_images(target, rec, ["id"], move_keys=True).collect())) == [(2, "b")]


def test_conflicts_fold_only_what_they_touch(spark):
    schema = "id int, username string, email string, age int"
    target = spark.createDataFrame([(1, "u1", "e1", 1), (2, "u2", "e2", 2), (9, "u9", None, 9)], schema)
    new = spark.createDataFrame([(0, 3, "u1", "e3", 3), (1, 1, "u5", "e5", 5)], f"seq long, {schema}")
    found = sink.fold_conflicts(target, new, [["id"], ["username"], ["email", "age"]])
    assert sorted(map(tuple, found.collect())) == [(1, "u5", "e5", 5), (2, "u2", "e2", 2), (3, "u1", "e3", 3), (9, "u9", None, 9)]


def test_file_table_versions(spark, tmp_path):
    t = FileTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.keys = ("id",)
    assert t.write(spark.range(3).toDF("id")) and not t.write(spark.range(9).toDF("id"))
    gone = lambda k: spark.createDataFrame([(1, "delete", k)], "seq long, operation string, id long")
    step = lambda old, new: sink.replay(old, new, ["id"])
    assert t.change(("q", 1), gone(0), step)
    assert not t.change(("q", 1), gone(1), step)
    assert t.read().count() == 2 and t.versions() == [0, 1] and t.read(0).count() == 3
    t.change(("q", 2), gone(1), step)
    assert t.versions() == [1, 2] and [r.id for r in t.read().collect()] == [2]


def test_scratch_tables_go(spark):
    from rivulet.operators import storage

    before = list(storage.TABLES)
    with storage.scratch(spark):
        rows = storage.materialize(spark.range(5), "kept").collect()
        path = storage.TABLES[-1]
    assert len(rows) == 5 and storage.TABLES == before
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_conflicts_keep_large_numbers_and_nulls(spark):
    big = 2**53 + 1
    schema = "id long, code long, name string"
    target = spark.createDataFrame([(big, 1, "a"), (big + 2, None, "b"), (7, 3, None)], schema)
    new = spark.createDataFrame([(1, big, None, None), (2, big + 4, 3, "c"), (3, None, None, "d"), (4, None, 9, "e")], f"seq long, {schema}")
    found = sink.fold_conflicts(target, new, [["id"], ["code"]]).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(big, None, None), (big + 2, None, "b"), (big + 4, 3, "c"), (None, None, "d"), (None, 9, "e")], key=repr)


def test_conflicts_of_rows_with_all_types(spark):
    schema = "id long, at timestamp, day date, price decimal(20,3), raw binary, tags array<string>"
    at, day = dt.datetime(2024, 2, 29, 12, 30, 5, 123456), dt.date(2024, 2, 29)
    rows = [(1, at, day, decimal.Decimal("12345678901234567.891"), b"\x00\xff", ["a", None]), (2, None, None, None, None, None)]
    new = spark.createDataFrame([(1, *rows[0]), (2, 2, at, None, None, b"", [])], f"seq long, {schema}")
    found = sink.fold_conflicts(spark.createDataFrame(rows, schema), new, [["id"]])
    assert sorted(map(tuple, found.collect())) == [rows[0], (2, at, None, None, b"", [])]


def test_conflicts_in_the_order_of_any_sequence(spark):
    schema = "seq struct<f: long, p: long>, id long, code long"
    new = spark.createDataFrame([((1, 10), 1, 5), ((1, 9), 2, 5), ((0, 99), 3, 5)], schema)
    assert sink.fold_conflicts(spark.createDataFrame([], "id long, code long"), new, [["id"], ["code"]]).collect() == [(1, 5)]


def test_rows_that_share_nothing_with_a_record_are_not_grouped(spark, monkeypatch):
    seen, found = [], sink.components

    def counted(links):
        seen.append(links.count())
        return found(links)

    monkeypatch.setattr(sink, "components", counted)
    target = spark.range(1000).selectExpr("id", "id + 5000 AS code")
    new = spark.createDataFrame([(1, 3, 5004)], "seq long, id long, code long")
    with pytest.raises(Exception, match="two rows"):
        sink.fold_conflicts(target, new, [["id"], ["code"]]).collect()
    assert seen == [6]  # the record's two values and those of the two rows


def test_records_with_a_null_in_their_key_all_stand(spark):
    target = spark.createDataFrame([(1, "a")], "id long, name string")
    new = spark.createDataFrame([(1, "create", None, "x"), (2, "create", None, "y"), (3, "delete", None, "x"), (4, "update", 1, "b")], "seq long, operation string, id long, name string")
    assert sorted(map(tuple, sink.replay(target, new, ["id"]).collect()), key=repr) == sorted([(1, "b"), (None, "x"), (None, "y")], key=repr)
    assert sink.upsert(target, new.where("operation <> 'delete'").drop("operation"), ["id"]).count() == 3
