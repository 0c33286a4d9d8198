"""Upserts and deletes in a database, by connections that tasks open themselves.

Records are first reduced to the last one of each key, so rows of different
tasks never touch the same key and their order does not matter.  Each task
writes its part in one transaction, many rows a statement; a task that runs
again writes the same rows.  With one task, a batch is one transaction.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import sink
from .jdbc import Database, delete_sql, upsert_sql

Connect = Callable[[], object]


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    held: list[Row] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


class Rate:
    """At most ``per_second`` rows on average after a first ``burst``; 0 sets no limit."""

    def __init__(self, per_second: float, burst: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.per_second, self.burst, self.clock, self.sleep = per_second, max(burst, 1), clock, sleep
        self.free, self.at = float(self.burst), clock()

    def take(self, n: int) -> None:
        if self.per_second <= 0:
            return
        now = self.clock()
        self.free = min(self.burst, self.free + (now - self.at) * self.per_second) - n
        self.at = now
        if self.free < 0:
            self.sleep(-self.free / self.per_second)


def write(
    records: DataFrame,
    connect: Connect,
    db: Database,
    table: str,
    keys: Sequence[str],
    seq: str = "seq",
    batch_size: int = 1000,
    upsert: Callable[[Database, str, Sequence[str], int], str] = upsert_sql,
    delete: Callable[[Database, str, Sequence[str], int], str] = delete_sql,
    rate_per_second: float = 0.0,
    burst: int = 0,
    tasks: int | None = None,
) -> None:
    """Apply records (``seq``, ``operation`` and the row's columns) to a table, by ``tasks`` tasks (as many as Spark makes, unless given).

    The rate and the burst hold for all tasks together: each gets its share.
    """
    keys = sink.check_keys(records, keys)
    last = sink.last_by_key(records.withColumn("operation", sink.kind(F.col("operation"))), keys, seq).drop(seq)
    columns = [c for c in last.columns if c != "operation"]
    if rate_per_second > 0 and tasks is None:
        tasks = partitions_of(records.sparkSession)
    if tasks is not None:
        last = last.coalesce(1) if tasks == 1 else last.repartition(tasks, *keys)
    share = max(1, tasks or 1)

    def run(rows: Iterator[Row]) -> None:
        connection = connect()
        try:
            cursor, rate = connection.cursor(), Rate(rate_per_second / share, burst // share)
            for part in batches(rows, batch_size):
                rate.take(len(part))
                put = [r for r in part if r["operation"] == sink.UPSERT]
                gone = [r for r in part if r["operation"] != sink.UPSERT]
                if put:
                    cursor.execute(upsert(db, table, columns, len(put)), [r[c] for r in put for c in columns])
                if gone:
                    cursor.execute(delete(db, table, keys, len(gone)), [r[k] for r in gone for k in keys])
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    last.select("operation", *columns).foreachPartition(run)
