"""What a source reads from: a database over JDBC, or a folder of Parquet tables, with a change log beside it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ..operators.envelope import LogPosition
from ..operators.snapshot import ScanSpec
from . import catalog, jdbc


class Backend(Protocol):
    spark: SparkSession
    log_path: str

    def tables(self) -> list[str]: ...

    def primary_keys(self, tables: Iterable[str]) -> Mapping[str, tuple[str, ...]]: ...

    def frame(self, table: str) -> DataFrame: ...

    def rows(self, spec: ScanSpec) -> DataFrame:
        """A frame that holds the rows of a scan, at least."""

    def server_id(self) -> str: ...

    def locked(self, tables: Iterable[str]) -> AbstractContextManager: ...


def log_head(log_path: str) -> LogPosition:
    """The position of the last event in a log folder."""
    from ..streaming.changelog import _Log

    found = _Log({"path": log_path}).head()
    return LogPosition(found["name"], found["pos"], found["idx"])


@dataclass
class FolderBackend:
    """Tables are ``<path>/<name>.parquet``, files or folders; they do not change while they are read, so nothing is locked."""

    spark: SparkSession
    path: str
    log_path: str
    primary: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    server: str = "0"

    def tables(self) -> list[str]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        names = [s.getPath().getName() for s in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)]
        return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and n[0] not in "._")

    def primary_keys(self, tables: Iterable[str]) -> Mapping[str, tuple[str, ...]]:
        return {t: tuple(self.primary[t]) for t in tables if t in self.primary}

    def frame(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    def rows(self, spec: ScanSpec) -> DataFrame:
        return self.frame(spec.table)

    def server_id(self) -> str:
        return self.server

    def locked(self, tables: Iterable[str]) -> AbstractContextManager:
        return nullcontext()


@dataclass
class JdbcBackend:
    """A database; ``connect`` opens a DB-API connection for the lock (without it nothing is locked)."""

    spark: SparkSession
    db: jdbc.Database
    database: str
    log_path: str
    connect: Callable[[], object] | None = None
    partitions: int = 8

    def tables(self) -> list[str]:
        return catalog.tables_in(jdbc.information_schema(self.spark, self.db, "tables"), self.database)

    def primary_keys(self, tables: Iterable[str]) -> Mapping[str, tuple[str, ...]]:
        return catalog.primary_keys_in(jdbc.information_schema(self.spark, self.db, "key_column_usage"), self.database)

    def frame(self, table: str) -> DataFrame:
        return jdbc.read(self.spark, self.db, ScanSpec(table, ()))

    def rows(self, spec: ScanSpec) -> DataFrame:
        return jdbc.read(self.spark, self.db, spec, self.partitions)

    def server_id(self) -> str:
        return jdbc.server_id(self.spark, self.db)

    def locked(self, tables: Iterable[str]) -> AbstractContextManager:
        return jdbc.locked(self.connect, self.db, tables) if self.connect else nullcontext()
