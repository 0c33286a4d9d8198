"""A change log in files as a streaming source.

The log is a folder of JSON-lines files whose names end in a number; files in
order of that number, lines in order of ``pos``, make up the log.  An offset is
the position of the last row taken: file name, pos and row index, and the byte at
which its event begins, so that reading goes on there and never parses a file from
its start again.  A micro-batch is the rows after one offset up to another, at most
``maxrows`` of them, read by one task a file; a restart inside an event goes on with
its next row.

Spark asks a stream for its latest offset without saying where it is.  So the stream
keeps the end of the last batch that was planned; a stream that starts again finds it
in the checkpoint, named by the option ``checkpoint``.  Without that option the
first batch after a restart has no bound.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.types import filesystem

SCHEMA = "file string, pos long, idx int, n_rows int, ts long, server_id long, database string, collection string, action string, before string, after string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
KINDS = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string()]
ROW_ACTIONS = ("insert", "update", "delete")
LAST_ROW = (1 << 31) - 1


@dataclass
class LogFile(InputPartition):
    """Rows of one file after ``start`` and up to ``end``, both (pos, idx); the event of ``start`` begins at ``byte``."""

    path: str
    name: str
    start: tuple[int, int]
    end: tuple[int, int]
    byte: int = 0


@dataclass
class LogFiles(InputPartition):
    """Files that one task of a batch reads one after the other."""

    files: list[LogFile]


#: Bytes of small files that one task of a batch reads.
TASK_BYTES = 8 << 20


def offset(name: str = "", pos: int = -1, idx: int = -1, byte: int = 0) -> dict:
    return {"name": name, "pos": pos, "idx": idx, "byte": byte}


def number(name: str) -> int:
    found = re.search(r"(\d+)$", name.removesuffix(".json"))
    if not found:
        raise ValueError(f"log file {name} has no number")
    return int(found[1])


def log_files(path: str) -> list[tuple[str, str]]:
    """(path, name) of the files in log order."""
    fs, root = filesystem(path)
    found = [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.type == pafs.FileType.File and re.search(r"\d+(\.json)?$", i.base_name) and i.base_name[0] not in "._"]
    return [(i.path, i.base_name) for i in sorted(found, key=lambda i: number(i.base_name))]


def events(fs: pafs.FileSystem, path: str, byte: int = 0) -> Iterator[tuple[int, dict]]:
    """(where it begins, event) of a file from a byte on; a last line that is not complete yet is not there yet."""
    with fs.open_input_file(path) as f:
        f.seek(byte)
        rest, at = b"", byte
        while block := f.read(1 << 20):
            *lines, rest = (rest + block).split(b"\n")
            for line in lines:
                if line.strip():
                    yield at, json.loads(line)
                at += len(line) + 1


def last_event(fs: pafs.FileSystem, path: str) -> tuple[int, dict] | None:
    """(where it begins, event) of the last complete line, found from the end of the file."""
    with fs.open_input_file(path) as f:
        size = f.size()
        tail, first = b"", size
        while first > 0:
            step = min(1 << 16, first)
            f.seek(first - step)
            tail, first = f.read(step) + tail, first - step
            whole = tail[: tail.rfind(b"\n") + 1]
            # Of the lines in hand all but the first are known to be whole; at the file's start that one is too.
            at = len(whole)
            for line in reversed(whole.split(b"\n")[:-1]):
                at -= len(line) + 1
                if line.strip() and (at > 0 or first == 0):
                    return first + at, json.loads(line)
    return None


def rows_of(event: dict) -> list[tuple[dict | None, dict | None]]:
    """(before, after) of each row that an event changes."""
    images = event.get("rows") or []
    if event["action"] == "insert":
        return [(None, r) for r in images]
    if event["action"] == "delete":
        return [(r, None) for r in images]
    if len(images) % 2:
        raise ValueError("an update has an odd number of row images")
    return list(zip(images[::2], images[1::2], strict=True))


def read_file(part: LogFile, base: str, wanted: Callable[[dict], bool]) -> Iterator[pa.RecordBatch]:
    fs, _ = filesystem(base)
    out: list[tuple] = []
    for _, e in events(fs, part.path, part.byte):
        if e["pos"] > part.end[0]:
            break
        if e["pos"] < part.start[0] or not wanted(e):
            continue
        changed = rows_of(e)
        for idx, (before, after) in enumerate(changed):
            if part.start < (e["pos"], idx) <= part.end:
                image = [None if r is None else json.dumps(r, ensure_ascii=False) for r in (before, after)]
                out.append((part.name, e["pos"], idx, len(changed), e["ts"], e["server_id"], e["database"], e["collection"], e["action"], *image))
        if len(out) >= 4096:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)


def write_log(log: DataFrame, path: str) -> None:
    """Write events (``file``, whose names end in a number, ``pos``, ``action``, ``rows`` and the rest) as a log folder.

    Each log file is written by one task, in order; the driver only gives it its name.
    """
    spark, place = log.sparkSession, f"{path}.written"
    event = F.to_json(F.struct(*[c for c in log.columns if c != "file"]), {"ignoreNullFields": "false"})
    lines = log.select("file", "pos", event.alias("value")).repartition("file").sortWithinPartitions("file", "pos").select("file", "value")
    lines.write.partitionBy("file").text(place)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(place).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(path))
    names = [s.getPath().getName()[5:] for s in fs.listStatus(hadoop(place)) if s.getPath().getName().startswith("file=")]
    # In order: a stream may be reading, and a file that has a next one gets no more rows.
    for name in sorted(names, key=number):
        (part,) = [s.getPath() for s in fs.listStatus(hadoop(f"{place}/file={name}")) if s.getPath().getName().startswith("part-")]
        fs.rename(part, hadoop(f"{path}/{name}"))
    fs.delete(hadoop(place), True)


class _Log:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.database = options.get("database")
        self.tables = frozenset(t for t in options.get("tables", "").split(",") if t)
        self.begin = {**offset(), **json.loads(options["startingposition"])} if options.get("startingposition") else offset()
        self.end = {**offset(), **json.loads(options["endingposition"])} if options.get("endingposition") else None
        self.limit = int(options.get("maxrows", "0"))
        self.checkpoint = options.get("checkpoint")
        self.at: dict | None = None
        self.known: list[tuple[int, str, str]] = []
        if self.limit < 0:
            raise ValueError("maxrows is not negative")

    def __getstate__(self) -> dict:
        """What tasks get: they know their file, not the folder's list."""
        return {**self.__dict__, "known": []}

    def relist(self) -> None:
        self.known = [(number(name), path, name) for path, name in log_files(self.path)]

    def files(self, first: int) -> Iterator[tuple[int, str, str]]:
        """(number, path, name) from a number on.  A file that has a next one gets no more rows, so the folder is
        listed anew only before the last file known is read."""
        k, listed = bisect_left(self.known, (first,)), False
        while True:
            if not listed and k >= len(self.known) - 1:
                at = self.known[k][0] if k < len(self.known) else first
                self.relist()
                k, listed = bisect_left(self.known, (at,)), True
            if k >= len(self.known):
                return
            yield self.known[k]
            k += 1

    def wanted(self, event: dict) -> bool:
        return event["action"] in ROW_ACTIONS and (not self.database or event["database"] == self.database) and (not self.tables or event["collection"] in self.tables)

    def range(self, start: dict, end: dict) -> list[LogFile]:
        out, first, last = [], number(start["name"]) if start["name"] else -1, number(end["name"]) if end["name"] else -1
        if not self.known or self.known[-1][0] < last:
            self.relist()
        for n, path, name in self.known[bisect_left(self.known, (first,)) : bisect_left(self.known, (last + 1,))]:
            a = (start["pos"], start["idx"]) if n == first else (-1, -1)
            b = (end["pos"], end["idx"]) if n == last else (1 << 62, LAST_ROW)
            if a < b:
                out.append(LogFile(path, name, a, b, start.get("byte", 0) if n == first else 0))
        return out

    def head(self) -> dict:
        """The position of the last event; reads the end of the last file alone."""
        fs, _ = filesystem(self.path)
        self.relist()
        for _, path, name in reversed(self.known):
            if found := last_event(fs, path):
                return offset(name, found[1]["pos"], LAST_ROW, found[0])
        return offset()

    def ahead(self, start: dict) -> dict:
        """The position at most ``limit`` rows after ``start``; parses these rows alone."""
        fs, _ = filesystem(self.path)
        left, out, first = self.limit, start, number(start["name"]) if start["name"] else -1
        for n, path, name in self.files(first):
            for at, e in events(fs, path, start.get("byte", 0) if n == first else 0):
                if n == first and e["pos"] < start["pos"]:
                    continue
                done = start["idx"] + 1 if n == first and e["pos"] == start["pos"] else 0
                rows = max(0, len(rows_of(e)) - done) if self.wanted(e) else 0
                if rows > left:
                    return offset(name, e["pos"], done + left - 1, at) if left else out
                left -= rows
                if (n, e["pos"], LAST_ROW) > (first, start["pos"], start["idx"]):
                    out = offset(name, e["pos"], LAST_ROW, at)
        return out

    def read(self, partition: LogFile | None) -> Iterator[pa.RecordBatch]:
        """A read without partitions has one that is None."""
        return read_file(partition, self.path, self.wanted) if partition else iter(())


def planned(checkpoint: str) -> dict | None:
    """The end of the last batch that a checkpoint has planned; offsets are the last line of its newest file."""
    fs, root = filesystem(f"{checkpoint.rstrip('/')}/offsets")
    if fs.get_file_info(root).type != pafs.FileType.Directory:
        return None
    found = [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name.isdigit()]
    if not found:
        return None
    with fs.open_input_stream(max(found, key=lambda i: int(i.base_name)).path) as f:
        last = f.read().decode().strip().splitlines()[-1]
    return None if last == "-" else json.loads(last)


class ChangeLogStream(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.begin

    def latestOffset(self) -> dict:
        if not self.limit:
            return self.head()
        if self.at is None:
            self.at = (planned(self.checkpoint) if self.checkpoint else None) or self.begin
        return self.ahead(self.at)

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        self.at = end
        return self.range(start, end)

    def commit(self, end: dict) -> None:
        """Nothing is kept at the source: the log stays where it is."""

    def stop(self) -> None:
        """Files are closed after each use; what is left is the place, which a new stream finds by itself."""
        self.at = None


class ChangeLogBatch(_Log, DataSourceReader):
    def partitions(self) -> list[LogFiles]:
        """Consecutive files, about ``TASK_BYTES`` of them a task."""
        fs, root = filesystem(self.path)
        size = {i.path: i.size for i in fs.get_file_info(pafs.FileSelector(root)) if i.type == pafs.FileType.File}
        out, held = [], 0
        for f in self.range(self.begin, self.end or (self.ahead(self.begin) if self.limit else self.head())):
            if not out or held + size.get(f.path, 0) > TASK_BYTES:
                out.append(LogFiles([]))
                held = 0
            out[-1].files.append(f)
            held += size.get(f.path, 0)
        return out

    def read(self, partition: LogFiles | None) -> Iterator[pa.RecordBatch]:
        for f in partition.files if partition else ():
            yield from read_file(f, self.path, self.wanted)


class ChangeLogSource(DataSource):
    """``spark.dataSource.register(ChangeLogSource)``, then format ``changelog``.

    Options: ``path``, ``database``, ``tables`` (names with commas between),
    ``startingposition`` (JSON with name, pos and idx; rows after it are read),
    ``endingposition`` (the last row of a batch read; without it the log's head),
    ``maxrows`` (rows of a micro-batch at most; 0: no bound) and ``checkpoint`` (the
    stream's checkpoint folder, where a restart finds its place).
    """

    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ChangeLogBatch(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeLogStream(self.options)
