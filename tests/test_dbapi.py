import logging
import sqlite3

import pytest

from rivulet.sources import dbapi, jdbc
from rivulet.streaming.listener import LogListener

LITE = jdbc.Database("jdbc:sqlite:x", "none", quote='"')


def upsert(db, table, columns, rows):
    values = ", ".join("(" + ", ".join("?" * len(columns)) + ")" for _ in range(rows))
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES {values} ON CONFLICT DO UPDATE SET v = excluded.v"


def test_records_reach_a_database(spark, tmp_path):
    path = str(tmp_path / "x.db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE t (a INTEGER, b TEXT, v INTEGER, PRIMARY KEY (a, b))")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(1, "x", 1), (2, "y", 2), (3, "z", 3)])
    con.commit()
    ops = [(0, "update", 1, "x", 10), (1, "delete", 2, "y", None), (2, "create", 4, "w", 4), (3, "delete", 4, "w", None), (4, "create", 2, "y", 20), (5, "delete", 3, "z", None), *[(10 + i, "snapshot", 100 + i, "s", i) for i in range(50)]]
    records = spark.createDataFrame(ops, "seq long, operation string, a int, b string, v int")
    dbapi.write(records.coalesce(1), lambda: sqlite3.connect(path, timeout=60), LITE, "t", ["a", "b"], batch_size=7, upsert=upsert)
    assert con.execute("SELECT * FROM t WHERE a < 100 ORDER BY a").fetchall() == [(1, "x", 10), (2, "y", 20)]
    assert con.execute("SELECT count(*) FROM t").fetchone() == (52,)
    with pytest.raises(Exception, match="no such table"):
        dbapi.write(records, lambda: sqlite3.connect(path, timeout=60), LITE, "missing", ["a", "b"], upsert=upsert)


def test_rate():
    now, slept = [0.0], []
    rate = dbapi.Rate(10, 20, clock=lambda: now[0], sleep=slept.append)
    rate.take(20)
    rate.take(5)
    assert slept == [0.5]
    dbapi.Rate(0, 0, sleep=slept.append).take(1000)
    assert len(slept) == 1


def test_listener(spark, caplog, tmp_path):
    listener = LogListener()
    spark.streams.addListener(listener)
    try:
        spark.range(5).write.parquet(f"{tmp_path}/in")
        with caplog.at_level(logging.INFO, "rivulet.streaming"):
            q = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
            q.awaitTermination()
            spark._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
    assert any('"rows": 5' in m for m in caplog.messages)
