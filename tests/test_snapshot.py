import pytest
from pyspark.sql import functions as F

from rivulet.operators import envelope, ordering, snapshot
from rivulet.operators.envelope import KeyPosition, LogPosition


@pytest.fixture()
def users(spark):
    return spark.range(1, 101).select("id", F.concat(F.lit("user-"), "id").alias("username"))


def test_gaps_and_starts(spark):
    ids = [i for i in range(20, 100) if not 30 < i < 60]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    spec = snapshot.plan(df, "users", ("id",), fetch_size=10)
    assert (spec.start, spec.end) == ((20,), (99,))
    assert sorted(r.id for r in snapshot.scan(df, spec).collect()) == ids


def test_resume_loses_and_repeats_nothing(users):
    spec = snapshot.plan(users, "users", ("id",), fetch_size=10)
    first = [r.id for r in snapshot.page(users, spec).collect()]
    more = snapshot.plan(users, "users", ("id",), [KeyPosition("id", first[-1], spec.end[0])])
    grown = users.unionByName(users.limit(1).select(F.lit(500).cast("long").alias("id"), "username"))
    rest = [r.id for r in snapshot.scan(grown, more).collect()]
    assert sorted(first + rest) == list(range(1, 101))


def test_composite_resume_is_lexicographic(spark):
    rows = [(a, b) for a in range(5) for b in "xyz"]
    df = spark.createDataFrame(rows, "a int, b string")
    spec = snapshot.plan(df, "t", ("a", "b"), [KeyPosition("a", 1, 4), KeyPosition("b", "z", "y")])
    assert sorted(map(tuple, snapshot.scan(df, spec).collect())) == [r for r in rows if (1, "z") < r <= (4, "y")]


def test_empty_and_null_keys(spark):
    empty = spark.createDataFrame([], "id long")
    assert snapshot.plan(empty, "t", ("id",)) is None
    assert snapshot.plan(empty, "t", ()) is None
    assert snapshot.key_bounds(empty, ("id",)).count() == 0
    assert snapshot.count_total(empty).count() == 0
    nulls = spark.createDataFrame([(None,), (3,)], "id long")
    assert [r.id for r in snapshot.scan(nulls, snapshot.plan(nulls, "t", ("id",))).collect()] == [3]
    with pytest.raises(snapshot.KeyNotInTable):
        snapshot.plan(nulls, "t", ("x",))


def test_unfit_position_is_ignored(users):
    assert snapshot.plan(users, "users", ("id",), [KeyPosition("a", 1, 2), KeyPosition("b", 1, 2)]).start == (1,)


def test_keyless_rows_are_numbered(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",)], "data string")
    found = snapshot.records(df, snapshot.plan(df, "t", ()))
    assert sorted(r.key for r in found.collect()) == ["t_0", "t_1", "t_2"]


def test_filter_reaches_the_scan(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    spec = snapshot.plan(orders, "orders", ("o_orderkey",), [KeyPosition("o_orderkey", 10, 20)])
    text = snapshot.scan(orders, spec).select("o_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in text and "LessThanOrEqual(o_orderkey,20)" in text


def test_row_and_run_numbers_over_buckets(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), F.when(F.col("id") % 700 < 650, "a").otherwise("b").alias("v"))
    rows = ordering.with_row_number(df.orderBy(F.rand(3)), ["seq"], "n", rows_per_bucket=300).collect()
    assert all(r.n == r.seq for r in rows) and len(rows) == 5000
    runs = ordering.with_run_number(df, ["seq"], F.col("v"), "run", rows_per_bucket=300).orderBy("seq").collect()
    want, run = [], -1
    for i, r in enumerate(runs):
        run += i == 0 or r.v != runs[i - 1].v
        want.append(run)
    assert [r.run for r in runs] == want


def test_positions_survive_json():
    import datetime as dt

    p = LogPosition("binlog.000002", 504, 3, ("binlog.000002", 404))
    assert envelope.parse_position(envelope.log_position_json(p)) == p
    assert envelope.log_position_json(LogPosition("f.1", 4)) == '{"cdc_position":{"name":"f.1","pos":4}}'
    tables = {"a": [KeyPosition("", (1 << 60) + 1, 9)], "b": [KeyPosition("x", b"\x00\xff", b"z"), KeyPosition("y", dt.datetime(2024, 1, 2), dt.datetime(2025, 1, 1))]}
    assert envelope.parse_position(envelope.snapshot_position_json(tables, LogPosition("f.1", 4))) == (tables, LogPosition("f.1", 4))
    assert envelope.parse_position("") is None


def test_a_mark_inside_an_event_survives():
    mark = envelope.LogPosition("binlog.000002", 504, (1 << 31) - 1)
    text = envelope.snapshot_position_json({"t": [envelope.KeyPosition("id", 1, 9)]}, mark)
    tables, found = envelope.parse_position(text)
    assert found == mark and tables == {"t": [envelope.KeyPosition("id", 1, 9)]}
    old = '{"snapshot_position":{"snapshots":{"t":{"last_read":1,"snapshot_end":9}},"mark":{"name":"b.1","pos":4}}}'
    assert envelope.parse_position(old) == ({"t": [envelope.KeyPosition("", 1, 9)]}, envelope.LogPosition("b.1", 4))


def test_a_position_of_another_column_is_ignored(spark):
    df = spark.range(10).selectExpr("id AS a", "10 - id AS b")
    assert snapshot.plan(df, "t", ("b",), [envelope.KeyPosition("a", 5, 9)]).start == (1,)
    assert snapshot.plan(df, "t", ("b",), [envelope.KeyPosition("b", 5, 9)]).start == (5,)
    assert snapshot.plan(df, "t", ("b",), [envelope.KeyPosition("", 5, 9)]).start == (5,)
