"""From options to running plans: a source that opens, reads and is torn down, and a sink.

Opening finds the tables that the rules include and their keys, takes the log's mark and
the bounds of every table while the tables are locked, and decides from a stored
position what is left to do.  The snapshot is one plan, or pages with a position after
each; the log follows from the mark, in micro-batches of a bounded number of rows.  A
long backlog is caught up with first, by one batch job over its files.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.types import SchemaRegistry, columns_of
from ..operators import envelope, snapshot
from ..operators.envelope import KeyPosition
from ..operators.tables import FileTable
from ..sources import catalog, dbapi, jdbc
from ..sources.backend import Backend, log_head
from ..sources.catalog import TableKeys
from ..streaming import apply
from ..streaming.changelog import ChangeLogBatch, ChangeLogSource, number, offset
from . import combined
from .config import Dsn, SinkConfig, SourceConfig

#: More micro-batches than these are a backlog, which a batch job applies before the stream starts.
BACKLOG_BATCHES = 16


@dataclass
class Source:
    """An open source.  ``position`` tells what has been read: a snapshot position, or the log's."""

    spark: SparkSession
    config: SourceConfig
    backend: Backend
    keys: Mapping[str, TableKeys]
    plan: combined.Plan
    registry: SchemaRegistry
    server_id: str
    done: dict[str, list[KeyPosition]] = field(default_factory=dict)
    queries: list[StreamingQuery] = field(default_factory=list)

    @classmethod
    def open(cls, spark: SparkSession, config: SourceConfig, backend: Backend, position: str = "", registry: SchemaRegistry | None = None) -> Source:
        names = catalog.included(backend.tables(), config.tables)
        if not names:
            raise catalog.NoTablesError(f"no table matches {', '.join(config.tables)}")
        keys = catalog.resolve_keys(names, backend.primary_keys(names), config.sorting, config.unsafe)
        with backend.locked(names):
            frames = {t: backend.frame(t) for t in names}
            found = combined.plan(frames, keys, log_head(backend.log_path), position, config.snapshot, config.fetch_size)
        stored = envelope.parse_position(position)
        # What a position says of a table counts if the scan goes on from it.
        done = {t: p for t, p in stored[0].items() if t in found.scans and found.scans[t].start_read} if isinstance(stored, tuple) else {}
        return cls(spark, config, backend, keys, found, registry or SchemaRegistry(), backend.server_id(), done)

    @property
    def position(self) -> str:
        """Where a source that opens later goes on: in the snapshot while tables are left, then at the mark."""
        if self.left():
            return envelope.snapshot_position_json(self.done, self.plan.mark)
        return envelope.log_position_json(self.plan.mark) if self.plan.mark else ""

    def left(self) -> list[str]:
        """The tables whose scans are not at their end."""
        read = lambda t: t in self.done and all(p.last_read == p.snapshot_end for p in self.done[t])
        return [t for t in self.plan.scans if not read(t)]

    def schemas(self, table: str) -> tuple[tuple[str, int], tuple[str, int] | None]:
        """Subject and version of a table's rows and of its keys, registered if they are new."""
        columns, record = columns_of(self.backend.frame(table).schema), self.keys[table].record
        return self.registry.payload(table, columns), self.registry.key(table, columns, record) if record else None

    def records(self, table: str, rows: DataFrame, spec: snapshot.ScanSpec) -> DataFrame:
        """Snapshot records with metadata, and with a position if the table has sort keys."""
        found = snapshot.records(rows, spec, self.keys[table].record or None)
        payload, key = self.schemas(table)
        now = F.unix_timestamp(F.current_timestamp())
        found = found.withColumn("metadata", envelope.metadata(F.lit(table), now, F.lit(self.server_id), payload, key))
        if spec.keys:
            found = snapshot.with_position(found, spec, {t: p for t, p in self.done.items() if t != table}, self.plan.mark)
        return found

    def snapshot(self) -> dict[str, DataFrame]:
        """Each table's records, as one plan a table."""
        return {t: self.records(t, self.backend.rows(s), s) for t, s in self.plan.scans.items()}

    def pages(self) -> Iterator[tuple[str, DataFrame, str]]:
        """(table, records, position after them) page by page; a source that opens at the position reads what follows.

        A table without sort keys is one page and has no position: it is read again.
        """
        for table in list(self.left()):
            spec = self.plan.scans[table]
            if not spec.keys:
                yield table, self.records(table, self.backend.rows(spec), spec), self.position
                self.done[table] = []
                continue
            rest, end = spec, spec.end
            while (found := snapshot.next_page(self.backend.rows(rest), rest)) is not None:
                rows, rest = found
                records = self.records(table, rows, replace(spec, start=None, end=end))
                self.done[table] = snapshot.positions_after(spec, rest.start)
                yield table, records, self.position
            # The scan is at its end, also if the row with its last key is gone by now.
            self.done[table] = snapshot.positions_after(spec, end)

    def _options(self, begin: dict) -> dict[str, str]:
        self.spark.dataSource.register(ChangeLogSource)
        return {"path": self.backend.log_path, "database": self.config.database, "tables": ",".join(sorted(self.keys)), "startingposition": json.dumps(begin)}

    def _mark(self) -> dict:
        mark = self.plan.mark
        return offset(mark.name, mark.pos, mark.idx) if mark else offset()

    def log(self, checkpoint: str | None = None, begin: dict | None = None) -> DataFrame:
        """The log after the mark (or ``begin``) as a stream of rows, at most ``batch_size`` a micro-batch."""
        reader = self.spark.readStream.format("changelog").options(**self._options(begin or self._mark()), maxrows=str(self.config.batch_size))
        if checkpoint:
            reader = reader.option("checkpoint", checkpoint)
        return reader.load()

    def backlog(self) -> tuple[dict, dict] | None:
        """(mark, head of the log) if more than ``BACKLOG_BATCHES`` micro-batches of rows lie between them."""
        if not self.config.batch_size:
            return None
        options = {**self._options(self._mark()), "maxrows": str(BACKLOG_BATCHES * self.config.batch_size)}
        log = ChangeLogBatch(options)
        begin, near = log.begin, log.ahead(log.begin)
        head = log.head()
        place = lambda at: (number(at["name"]) if at["name"] else -1, at["pos"])
        return (begin, head) if place(near) < place(head) else None

    def _caught_up(self, sinks: apply.Tables, checkpoint: str) -> dict | None:
        """Where the stream of a new checkpoint begins: after the backlog, which is applied here."""
        found = apply.backlog(self.spark, checkpoint, self.backlog)
        if found is None:
            return None
        rows = self.spark.read.format("changelog").options(**self._options(found["begin"]), endingposition=json.dumps(found["end"])).load()
        apply.catch_up(sinks, found["stream"], rows)
        return found["end"]

    def run(self, targets: Mapping[str, FileTable], checkpoint: str) -> StreamingQuery:
        """Write the snapshot to file tables, then stream the log into them from the mark.

        The batch job commits before the stream starts; rows that changed in between
        come twice and are upserted.  So does the job that applies a backlog, if there is one.
        """
        for name, target in targets.items():
            if not target.versions():
                target.keys = self.keys[name].record
                spec = self.plan.scans.get(name)
                target.write(snapshot.scan(self.backend.rows(spec), spec) if spec else self.backend.frame(name).limit(0))
        sinks = {n: (t, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.backend.frame(n).schema.fields), self.keys[n].record) for n, t in targets.items()}
        query = apply.start(self.log(checkpoint, self._caught_up(sinks, checkpoint)), sinks, checkpoint, self.config.batch_delay_ms)
        self.queries.append(query)
        return query

    def teardown(self) -> None:
        """Stop the streams; the first failure of one is raised when all are stopped."""
        failures = []
        for query in self.queries:
            try:
                query.stop()
                if (failure := query.exception()) is not None:
                    failures.append(failure)
            except Exception as e:
                failures.append(e)
        self.queries.clear()
        if failures:
            raise failures[0]


def database_of(dsn: str, driver: str = "com.mysql.cj.jdbc.Driver") -> jdbc.Database:
    """The database of a data source name, with statements as its usual Python drivers want them."""
    found = Dsn.parse(dsn)
    login = {k: v for k, v in (("user", found.user), ("password", found.password)) if v}
    return jdbc.Database(found.jdbc_url(), driver, login, placeholder="%s")


@dataclass
class Sink:
    """Writes records to the tables of a database."""

    config: SinkConfig
    connect: Callable[[], object]
    db: jdbc.Database
    statements: Mapping[str, Callable] = field(default_factory=dict)

    @classmethod
    def open(cls, config: SinkConfig, connect: Callable[[], object], db: jdbc.Database | None = None, **statements: Callable) -> Sink:
        return cls(config, connect, db or database_of(config.dsn), statements)

    def write(self, table: str, records: DataFrame, seq: str = "seq", one_transaction: bool = False) -> None:
        """Apply records; with ``one_transaction`` all of them or none are there."""
        keys = self.config.keys.get(table, ())
        dbapi.write(records, self.connect, self.db, table, keys, seq, self.config.batch_size or 1000, rate_per_second=self.config.rate_per_second, burst=self.config.burst, tasks=1 if one_transaction else None, **self.statements)

    def start(self, stream: DataFrame, schemas: Mapping[str, str], checkpoint: str) -> StreamingQuery:
        """Apply a stream of change-log rows to the tables whose row schemas are given, a transaction a batch and table."""

        def run(batch: DataFrame, _: int) -> None:
            batch = batch.persist()
            try:
                for table, schema in sorted(schemas.items()):
                    self.write(table, apply.flat_records(batch, table, schema), one_transaction=True)
            finally:
                batch.unpersist()

        writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return writer.trigger(processingTime=f"{self.config.batch_delay_ms} milliseconds").start()
