"""Sinks for micro-batches of change-log rows, and for a backlog of them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sink
from ..operators.changes import file_number, operation
from ..operators.tables import FileTable
from .changelog import planned

Tables = Mapping[str, tuple[FileTable, str, tuple[str, ...]]]


def flat(collection: str, schema: str) -> Callable[[DataFrame], DataFrame]:
    """One table's rows as records: seq (position in the log), operation, and the columns of the image that counts.

    Micro-batches are many, so their expressions are made once.
    """
    image = F.when(F.col("action") == "delete", F.col("before")).otherwise(F.col("after"))
    seq = F.struct(file_number(F.col("file")).alias("f"), F.col("pos").alias("p"), F.col("idx").alias("i")).alias("seq")
    here, kind, row = F.col("collection") == collection, operation(F.col("action")).alias("operation"), F.from_json(image, schema).alias("row")
    return lambda log_rows: log_rows.where(here).select(seq, kind, row).select("seq", "operation", "row.*")


def flat_records(log_rows: DataFrame, collection: str, schema: str) -> DataFrame:
    return flat(collection, schema)(log_rows)


def stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id that a checkpoint got when it was made; it stays over restarts, and a new checkpoint has another."""
    return json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def apply_batch(tables: Tables, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that applies a batch to file tables (table, row schema, keys).

    A batch that comes again after a failure is skipped.  Tables with keys take a
    batch in as it is and merge many together; tables without get their rows appended.
    """
    stream = ""
    records = {name: flat(name, schema) for name, (_, schema, _) in sorted(tables.items())}
    # One table with keys reads a batch once.
    once = len(tables) == 1 and all(keys for _, _, keys in tables.values())

    def run(batch: DataFrame, batch_id: int) -> None:
        nonlocal stream
        stream = stream or stream_id(batch, checkpoint)
        batch = batch if once else batch.persist()
        try:
            for name, (target, _, keys) in sorted(tables.items()):
                rows = records[name](batch)
                if keys and target.manifest()["keys"] == list(keys):
                    target.take((stream, batch_id), rows)
                elif keys:
                    target.change((stream, batch_id), rows, lambda old, new, keys=keys: sink.replay(old, new, keys))
                else:
                    target.change((stream, batch_id), rows.where("operation <> 'delete'").drop("operation"), sink.append)
        finally:
            if not once:
                batch.unpersist()

    return run


def catch_up(tables: Tables, stream: str, rows: DataFrame) -> None:
    """Apply a backlog of change-log rows to file tables (table, row schema, keys) as the only batch of ``stream``.

    The rows are read once a table, each key's last record is kept, and the buckets are written once.
    """
    for name, (target, schema, keys) in sorted(tables.items()):
        records = flat(name, schema)(rows)
        if not keys:
            target.change((stream, 0), records.where("operation <> 'delete'").drop("operation"), sink.append)
            continue
        known = F.when(sink.kind(F.col("operation")).isNotNull(), F.col("operation"))
        last = sink.last_by_key(records.withColumn("operation", known), list(keys)).select(*records.columns).persist()
        try:
            target.change((stream, 0), last, lambda old, new, keys=keys: sink.replay(old, new, keys))
        finally:
            last.unpersist()


def backlog(spark: SparkSession, checkpoint: str, found: Callable[[], tuple[dict, dict] | None]) -> dict | None:
    """``stream``, ``begin`` and ``end`` of the backlog that a checkpoint's stream starts after, None if it has none.

    It is written down beside the stream's own offsets before it is applied, so a restart applies just the
    same rows under the same name, or none of them again.  A stream that has offsets of its own is past it.
    """
    place = f"{checkpoint.rstrip('/')}/backlog.json"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(place)):
        if planned(checkpoint) is not None or (ends := found()) is None:
            return None
        hidden = path(f"{checkpoint.rstrip('/')}/.{uuid.uuid4().hex}")
        out = fs.create(hidden)
        out.write(bytearray(json.dumps({"stream": uuid.uuid4().hex, "begin": ends[0], "end": ends[1]}).encode()))
        out.close()
        if not fs.rename(hidden, path(place)):
            raise RuntimeError(f"{place} was written by another")
    return json.loads("\n".join(r[0] for r in spark.read.text(place, wholetext=True).collect()))


def start(stream: DataFrame, tables: Tables, checkpoint: str, delay_ms: int = 1000) -> StreamingQuery:
    """Apply a stream of change-log rows to file tables."""
    writer = stream.writeStream.foreachBatch(apply_batch(tables, checkpoint)).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=f"{delay_ms} milliseconds").start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a query take all there is, in as many batches as it takes, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
