import json
import pickle
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivulet.functions.types import SchemaRegistry
from rivulet.operators import sink, snapshot, tables
from rivulet.operators.envelope import KeyPosition, LogPosition, log_position_json, parse_position, snapshot_position_json
from rivulet.operators.tables import FileTable
from rivulet.plans import combined
from rivulet.plans.config import SourceConfig
from rivulet.plans.source import Source
from rivulet.sources.backend import FolderBackend
from rivulet.sources.catalog import KeylessTableError, NoTablesError, TableKeys
from rivulet.streaming import apply, changelog
from rivulet.streaming.apply import drain
from rivulet.streaming.changelog import SCHEMA, ChangeLogSource, _Log


def write(path, number, events):
    with open(path / f"binlog.{number:06d}.json", "a") as f:
        for pos, action, rows in events:
            f.write(json.dumps({"pos": pos, "ts": 1, "server_id": 1, "database": "db", "collection": "users", "action": action, "rows": rows}) + "\n")


def user(i, name):
    return {"id": i, "name": name}


KEYS = {"users": TableKeys(("id",), ("id",))}


def state(t):
    return dict(map(tuple, t.read().select("id", "name").collect()))


def test_batch_read_and_resume(spark, tmp_path):
    spark.dataSource.register(ChangeLogSource)
    write(tmp_path, 1, [(4, "insert", [user(i, "a") for i in range(10)]), (9, "update", [user(1, "a"), user(1, "b"), user(2, "a"), user(2, "b")])])
    write(tmp_path, 2, [(4, "delete", [user(3, "a")]), (5, "ddl", [])])
    df = spark.read.format("changelog").option("path", str(tmp_path)).load()
    assert df.count() == 13 and df.schema.simpleString().count(":") == len(SCHEMA.split(","))
    rest = spark.read.format("changelog").option("path", str(tmp_path)).option("startingposition", json.dumps({"name": "binlog.000001.json", "pos": 4, "idx": 6})).load()
    assert sorted((r.file, r.pos, r.idx) for r in rest.collect()) == [("binlog.000001.json", 4, 7), ("binlog.000001.json", 4, 8), ("binlog.000001.json", 4, 9), ("binlog.000001.json", 9, 0), ("binlog.000001.json", 9, 1), ("binlog.000002.json", 4, 0)]


def open_source(spark, tmp_path, frames, primary, position="", **options):
    for name, df in frames.items():
        place = tmp_path / "tables" / f"{name}.parquet"
        if not place.exists():
            df.write.parquet(str(place))
    (tmp_path / "log").mkdir(exist_ok=True)
    config = SourceConfig.from_options({"dsn": "u:p@tcp(h)/db", "tables": "*", "sdk.batch.delay.ms": "0", **{k.replace("__", "."): v for k, v in options.items()}})
    backend = FolderBackend(spark, str(tmp_path / "tables"), str(tmp_path / "log"), primary, "7")
    return Source.open(spark, config, backend, position)


def follow(source, targets, checkpoint):
    drain(source.run(targets, checkpoint))
    source.teardown()


def test_snapshot_then_stream_then_restart(spark, tmp_path):
    log, check = tmp_path / "log", str(tmp_path / "check")
    log.mkdir()
    write(log, 1, [(4, "insert", [user(1, "old")])])
    users = {"users": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")}
    target = FileTable(spark, str(tmp_path / "users"))
    run = lambda checkpoint=check: follow(open_source(spark, tmp_path, users, {"users": ("id",)}), {"users": target}, checkpoint)
    run()
    assert state(target) == {1: "a", 2: "b", 3: "c"}  # what is before the mark is in the snapshot
    write(log, 1, [(9, "update", [user(1, "a"), user(1, "x")]), (12, "delete", [user(2, "b")])])
    write(log, 2, [(4, "insert", [user(4, "d"), user(5, "e")])])
    run()
    assert state(target) == {1: "x", 3: "c", 4: "d", 5: "e"}
    run()
    assert state(target) == {1: "x", 3: "c", 4: "d", 5: "e"}


def test_a_new_checkpoint_is_not_skipped(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    users = {"users": spark.createDataFrame([(1, "a")], "id long, name string")}
    target = FileTable(spark, str(tmp_path / "users"))
    for k in range(3):
        mark = open_source(spark, tmp_path, users, {"users": ("id",)}).plan.mark
        write(log, 1, [(10 * k + 4, "insert", [user(10 + k, "n")])])
        source = open_source(spark, tmp_path, users, {"users": ("id",)}, position=log_position_json(mark))
        follow(source, {"users": target}, str(tmp_path / f"check{k}"))
    assert state(target) == {10: "n", 11: "n", 12: "n"}


def test_micro_batches_are_bounded_also_after_a_restart(spark, tmp_path):
    spark.dataSource.register(ChangeLogSource)
    log, check = tmp_path / "log", str(tmp_path / "check")
    log.mkdir()
    write(log, 1, [(4, "insert", [user(i, "a") for i in range(25)]), (9, "ddl", []), (12, "insert", [user(i, "b") for i in range(100, 107)])])
    write(log, 2, [(k, "insert", [user(200 + k, "c")]) for k in range(30)])
    sizes, seen = [], []

    def take(batch, _):
        rows = [(r.file, r.pos, r.idx) for r in batch.collect()]
        sizes.append(len(rows))
        seen.extend(rows)

    def run():
        stream = spark.readStream.format("changelog").option("path", str(log)).option("maxrows", "10").option("checkpoint", check).load()
        drain(stream.writeStream.foreachBatch(take).option("checkpointLocation", check).start())

    run()
    assert sum(sizes) == 62 and max(sizes) == 10 and len(set(seen)) == 62
    write(log, 2, [(100 + k, "insert", [user(300 + k, "d")]) for k in range(33)])
    sizes.clear()
    run()
    assert sizes == [10, 10, 10, 3] and len(seen) == len(set(seen)) == 95


def test_offsets_of_a_growing_log(tmp_path):
    write(tmp_path, 1, [(4, "insert", [user(i, "a") for i in range(5)]), (9, "ddl", [])])
    log = _Log({"path": str(tmp_path), "maxrows": "3"})
    a = log.ahead(log.begin)
    assert (a["pos"], a["idx"], a["byte"]) == (4, 2, 0)
    b = log.ahead(a)
    assert (b["pos"], b["idx"]) == (9, (1 << 31) - 1) and log.ahead(b) == b == log.head()
    with open(tmp_path / "binlog.000001.json", "a") as f:
        f.write('{"pos": 15, "ts": 1')  # not complete yet
    assert log.ahead(b) == b == log.head()
    with open(tmp_path / "binlog.000001.json", "a") as f:
        f.write(', "server_id": 1, "database": "db", "collection": "users", "action": "insert", "rows": [{"id": 1}]}\n\n')
    assert log.ahead(b)["pos"] == log.head()["pos"] == 15 and log.ahead(b)["byte"] == log.head()["byte"] > b["byte"]
    (tmp_path / "binlog.000002.json").write_text("")
    assert log.head()["pos"] == 15
    (tmp_path / "binlog.000002.json").write_text("x" * 200_000)  # one line, longer than a block, without an end
    assert log.head()["pos"] == 15


def test_the_head_reads_the_end_of_a_file_only(tmp_path, monkeypatch):
    write(tmp_path, 1, [(k, "insert", [user(k, "n" * 50)]) for k in range(20_000)])
    log, parsed, loads = _Log({"path": str(tmp_path)}), [], json.loads
    monkeypatch.setattr(json, "loads", lambda x: parsed.append(1) or loads(x))
    assert log.head()["pos"] == 19_999 and len(parsed) == 1


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    target = FileTable(spark, str(tmp_path / "t"), ("id",), buckets=50)
    target.write(spark.range(5000).selectExpr("id", "'a' AS name"))
    before = target.manifest()["folders"]
    records = spark.createDataFrame([(i, "update", 17 * i, "b") for i in range(10)], "seq long, operation string, id long, name string")
    step = lambda old, new: sink.replay(old, new, ["id"])
    assert target.change(("q", 0), records, step) and not target.change(("q", 0), records, step)
    after = target.manifest()["folders"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 10 and set(before) == set(after)
    rows = dict(map(tuple, target.read().collect()))
    assert len(rows) == 5000 and {i for i, n in rows.items() if n == "b"} == {17 * i for i in range(10)}
    assert target.change(("q", 1), records.limit(0), step) and target.manifest()["folders"] == after
    assert target.change(("other", 0), records.withColumn("operation", F.lit("delete")), step) and target.read().count() == 4990
    assert target.versions() == [2, 3]
    with pytest.raises(FileNotFoundError):
        FileTable(spark, str(tmp_path / "none")).read()


def test_a_table_without_keys_is_appended_to(spark, tmp_path):
    target = FileTable(spark, str(tmp_path / "t"))
    target.write(spark.createDataFrame([(1,)], "id long"))
    for k in range(3):
        assert target.change(("q", k), spark.createDataFrame([(k, 10 + k)], "seq long, id long"), sink.append)
    assert sorted(r.id for r in target.read().collect()) == [1, 10, 11, 12] and len(target.manifest()["folders"][""]) == 4
    target.compact()
    assert target.read().count() == 4 and len(target.manifest()["folders"][""]) == 1


def test_pages_resume_with_cumulative_positions(spark, tmp_path):
    """Key gaps, a start that is not zero, ties of a sorting column, a composite key and an empty table; a new source a page."""
    users = spark.range(20, 100).where("id < 41 OR id > 61").selectExpr("id", "id % 4 AS grp")
    pairs = spark.createDataFrame([(u, t) for u in range(3) for t in "abc"], "user_id int, tenant_id string")
    times = spark.range(30).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, 0, 0, id div 7) AS at")
    tables = {"users": users, "pairs": pairs, "times": times, "empty": users.limit(0)}
    primary = {"users": ("id",), "pairs": ("user_id", "tenant_id"), "times": ("id",), "empty": ("id",)}
    options = {"snapshot__fetchSize": "24", "tableConfig__times__sortingColumn": "at"}
    whole, position, sizes = Counter(), "", []
    while True:
        source = open_source(spark, tmp_path, tables, primary, position, **options)
        found = next(iter(source.pages()), None)
        if found is None:
            break
        table, records, position = found
        rows = records.collect()
        sizes.append((table, len(rows)))
        whole.update((table, *r.after) for r in rows)
        assert parse_position(max(rows, key=lambda r: tuple(r.last_read)).position) == parse_position(position) or not source.left()
    assert whole == Counter((t, *r) for t, df in tables.items() for r in df.collect())
    assert sizes == [("pairs", 9), ("times", 28), ("times", 2), ("users", 24), ("users", 24), ("users", 11)]
    assert source.left() == [] and source.position == log_position_json(source.plan.mark)


def test_a_table_without_keys_is_one_page(spark, tmp_path):
    source = open_source(spark, tmp_path, {"loose": spark.range(5).toDF("data")}, {}, snapshot__unsafe="true")
    ((table, records, _),) = list(source.pages())
    assert table == "loose" and {r.key for r in records.collect()} == {f"loose_{i}" for i in range(5)}


def test_records_carry_keys_and_schemas(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a", "x")], "user_id int, tenant_id string, email string")
    source = open_source(spark, tmp_path, {"pairs": pairs}, {"pairs": ("user_id", "tenant_id")})
    source.registry = SchemaRegistry(path=str(tmp_path / "registry" / "schemas.json"))
    (r,) = source.snapshot()["pairs"].collect()
    assert r.operation == "snapshot" and tuple(r.key) == (1, "a") and r.metadata["mysql.serverID"] == "7" and r.metadata["collection"] == "pairs"
    assert r.metadata["payload_schema_subject"] == "mysql.pairs_payload" and r.metadata["key_schema_version"] == "1"
    assert snapshot.key_positions(r) == parse_position(r.position)[0]["pairs"] == [KeyPosition("user_id", 1, 1), KeyPosition("tenant_id", "a", "a")]
    again = SchemaRegistry(path=str(tmp_path / "registry" / "schemas.json"))
    assert again.versions == source.registry.versions and again.get("mysql.pairs_key", 1)["fields"][0] == {"name": "user_id", "type": "int"}


def test_changes_while_the_snapshot_runs(spark, tmp_path):
    users = {"users": spark.createDataFrame([(i, "a") for i in range(1, 5)], "id long, name string")}
    source = open_source(spark, tmp_path, users, {"users": ("id",)})
    # The mark is taken; what is written now is in the log behind it.
    write(tmp_path / "log", 1, [(4, "insert", [user(5, "e")]), (8, "insert", [user(6, "f")]), (12, "delete", [user(4, "a")])])
    target = FileTable(spark, str(tmp_path / "users"))
    follow(source, {"users": target}, str(tmp_path / "check"))
    assert state(target) == {1: "a", 2: "a", 3: "a", 5: "e", 6: "f"}


def test_sources_that_do_not_open(spark, tmp_path):
    users = {"users": spark.range(3)}
    with pytest.raises(NoTablesError):
        open_source(spark, tmp_path, users, {}, tables="none")
    with pytest.raises(KeylessTableError):
        open_source(spark, tmp_path, users, {})
    assert open_source(spark, tmp_path, users, {}, snapshot__unsafe="true", snapshot__enabled="false").snapshot() == {}


def test_plans(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    head = LogPosition("binlog.1", 4)
    assert combined.plan({"users": users}, KEYS, head).mark == head
    assert not combined.plan({"users": users}, KEYS, head, with_snapshot=False).scans
    done = combined.plan({"users": users}, KEYS, head, '{"cdc_position":{"name":"binlog.1","pos":2}}')
    assert not done.scans and done.mark == LogPosition("binlog.1", 2)
    from rivulet.operators.envelope import KeyPosition

    half = snapshot_position_json({"users": [KeyPosition("id", 1, 2)]}, LogPosition("binlog.1", 1))
    again = combined.plan({"users": users}, KEYS, head, half)
    assert again.mark == LogPosition("binlog.1", 1) and again.scans["users"].start_read and again.scans["users"].end == (2,)


def test_small_batches_are_taken_in_and_merged_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PENDING", 3)
    target, plain = (FileTable(spark, str(tmp_path / n), ("id",), buckets=8) for n in ("t", "plain"))
    step = lambda old, new: sink.replay(old, new, ["id"])
    for t in (target, plain):
        t.write(spark.range(40).selectExpr("id", "'a' AS name"))
    first = target.manifest()["folders"]
    # The numbers of a later batch may be lower (a new log); what comes later counts.
    batches = [[(9, "update", 1, "x"), (8, "update", 1, "y"), (7, "delete", 2, None)], [(1, "update", 1, "z"), (2, "create", 2, "b")], [], [(1, "delete", 1, None), (3, "create", 50, "c")], [(1, "update", 50, "d")]]
    for k, rows in enumerate(batches):
        records = spark.createDataFrame(rows, "seq long, operation string, id long, name string")
        assert target.take(("q", k), records) and not target.take(("q", k), records) and plain.change(("q", k), records, step)
        assert (target.manifest()["folders"] == first) == (k < 2) and len(target.manifest().get("pending", {}).get("folders", [])) == (k + 1) % 3
        assert state(target) == state(plain)
    # Another kind of seq, and a change that is not put off, come after what was taken in.
    other = spark.createDataFrame([("s", "update", 50, "e")], "seq string, operation string, id long, name string")
    assert target.take(("q", 5), other) and state(target)[50] == "e"
    assert target.change(("q", 6), other.withColumn("operation", F.lit("delete")), step) and 50 not in state(target) and "pending" not in target.manifest()
    with pytest.raises(Exception, match="unknown operation"):
        target.take(("q", 7), other.withColumn("operation", F.lit("none")))
    kept = {f.split("/")[0] for v in target.versions() for f in target._named(target.manifest(v))}
    assert kept <= {p.name for p in (tmp_path / "t" / "data").iterdir()}


def test_a_stream_does_not_rewrite_a_table_each_batch(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    users = {"users": spark.range(100).selectExpr("id", "'a' AS name")}
    source = open_source(spark, tmp_path, users, {"users": ("id",)}, sdk__batch__size="5")
    write(log, 1, [(k, "update", [user(k, "a"), user(k, f"n{k}")]) for k in range(20)])
    target = FileTable(spark, str(tmp_path / "users"), buckets=4)
    query = source.run({"users": target}, str(tmp_path / "check"))
    drain(query)
    # All folders are of the one write of the snapshot; four batches are beside them.
    assert len({f.split("/")[0] for folders in target.manifest()["folders"].values() for f in folders}) == 1
    assert len(target.manifest()["pending"]["folders"]) == 4
    assert state(target) == {i: f"n{i}" if i < 20 else "a" for i in range(100)}


def test_a_long_backlog_is_one_batch_before_the_stream(spark, tmp_path):
    log, check = tmp_path / "log", str(tmp_path / "check")
    log.mkdir()
    frames = {"users": spark.range(50).selectExpr("id", "'a' AS name")}
    target = FileTable(spark, str(tmp_path / "users"), buckets=4)
    mark = log_position_json(open_source(spark, tmp_path, frames, {"users": ("id",)}).plan.mark)
    for n in range(1, 5):  # 120 rows, 24 micro-batches of five
        write(log, n, [(k, "update", [user(k, "a"), user(k, f"n{n}-{k}")]) for k in range(29)] + [(29, "delete", [user(40 + n, "a")])])

    def source():
        return open_source(spark, tmp_path, frames, {"users": ("id",)}, position=mark, sdk__batch__size="5", snapshot__enabled="true")

    target.keys = ("id",)
    target.write(frames["users"])
    first = source()
    query = first.run({"users": target}, check)
    wanted = {i: f"n4-{i}" if i < 29 else "a" for i in range(50) if i not in range(41, 45)}
    assert state(target) == wanted and len(target.versions()) == 2  # before the stream has done anything
    write(log, 5, [(k, "insert", [user(60 + k, "late")]) for k in range(7)])
    drain(query)
    first.teardown()
    wanted |= {60 + k: "late" for k in range(7)}
    assert state(target) == wanted and len(target.manifest()["pending"]["folders"]) == 2
    # A restart finds the backlog applied, and the stream's own place.
    applied = target.manifest()["applied"]
    follow(source(), {"users": target}, check)
    assert state(target) == wanted and target.manifest()["applied"] == applied


def test_a_backlog_that_was_cut_off_is_applied_once(spark, tmp_path, monkeypatch):
    log, check = tmp_path / "log", str(tmp_path / "check")
    log.mkdir()
    frames = {"users": spark.createDataFrame([], "id long, name string")}
    target = FileTable(spark, str(tmp_path / "users"))
    source = lambda: open_source(spark, tmp_path, frames, {}, tableConfig__users__sortingColumn="id", sdk__batch__size="2")
    first = source()
    write(log, 1, [(k, "insert", [user(k, "a")]) for k in range(40)])
    monkeypatch.setattr(apply, "start", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        first.run({"users": target}, check)
    monkeypatch.undo()
    write(log, 1, [(k, "insert", [user(k, "b")]) for k in range(40, 43)])
    follow(source(), {"users": target}, check)
    assert sorted(target.read().select("id").toPandas().id.tolist()) == list(range(43))


def test_a_batch_does_not_list_the_log_again(tmp_path, monkeypatch):
    for n in range(1, 9):
        write(tmp_path, n, [(k, "insert", [user(k, "a")]) for k in range(5)])
    log, listed, real = _Log({"path": str(tmp_path), "maxrows": "7"}), [], changelog.log_files
    monkeypatch.setattr(changelog, "log_files", lambda path: listed.append(1) or real(path))
    at, rows = log.begin, []
    for _ in range(4):
        end = log.ahead(at)
        parts = log.range(at, end)
        rows.append(sum(b.num_rows for p in parts for b in log.read(p)))
        at = end
    assert rows == [7, 7, 7, 7] and len(listed) == 1 and not pickle.loads(pickle.dumps(log)).known
    write(tmp_path, 9, [(4, "insert", [user(1, "b")])])
    while (end := log.ahead(at)) != at:
        rows.append(sum(b.num_rows for p in log.range(at, end) for b in log.read(p)))
        at = end
    assert sum(rows) == 41 and max(rows) == 7 and at["name"] == "binlog.000009.json"
