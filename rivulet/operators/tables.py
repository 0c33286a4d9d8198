"""File tables that a sink changes bucket by bucket.

Rows lie in buckets by a hash of their key.  A version is a manifest, a small JSON
file that names the folders each bucket consists of; it is renamed into place, so it
is there whole or not at all.  A change reads and writes the buckets that its records
fall into and takes over the others as they are; a table without keys gets its new
rows as a further folder.  Folders that no kept version names are deleted.

A small batch would rewrite as much as a large one.  So a table with keys can also take
a batch in as it is, as a folder of records beside the buckets: reading merges them, and
when there are ``PENDING`` of them they are put into the buckets together.

A change comes from a batch, named by its stream and number.  A stream's batch that is
applied again finds its number and does nothing; another stream (a new or lost
checkpoint) is known by its name and is applied, however its batches are numbered.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import sink

BUCKET = "rv_bucket"
NUMBER, ATTEMPT = "rv_number", "rv_attempt"
#: Batches taken in that are merged when a table is read.
PENDING = 128


@dataclass
class FileTable:
    """``keys`` and ``buckets`` are fixed by the first version."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ()
    buckets: int = 64
    keep: int = 2
    _known: dict = field(default_factory=dict, repr=False)

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        place = path(f"{self.path}/versions")
        if not fs.exists(place):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json") and n[1:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"{self.path} has no version")
        v = known[-1] if version is None else version
        if v not in self._known:
            self._known[v] = json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.path}/versions/v{v}.json", wholetext=True).collect()))
        return self._known[v]

    def _commit(self, manifest: dict, version: int) -> None:
        fs, path = self._fs()
        hidden, final = path(f"{self.path}/versions/.{uuid.uuid4().hex}"), path(f"{self.path}/versions/v{version}.json")
        out = fs.create(hidden)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(hidden, final):
            raise RuntimeError(f"version {version} of {self.path} was written by another")
        self._known[version] = manifest
        known = self.versions()
        named = {f for v in known[-self.keep :] for f in self._named(self.manifest(v))}
        for v in known[: -self.keep]:
            for f in self._named(self.manifest(v)) - named:
                fs.delete(path(f"{self.path}/data/{f}"), True)
            fs.delete(path(f"{self.path}/versions/v{v}.json"), False)
            del self._known[v]

    @staticmethod
    def _named(manifest: dict) -> set[str]:
        return {f for folders in manifest["folders"].values() for f in folders} | set(manifest.get("pending", {}).get("folders", []))

    def bucket(self, keys: Iterable[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, keys: list[str], buckets: int) -> dict[str, list[str]]:
        """The folder of each bucket that has rows."""
        fs, path = self._fs()
        name = uuid.uuid4().hex
        if not keys:
            rows.write.parquet(f"{self.path}/data/{name}")
            return {"": [name]}
        # Rows of a bucket come together, so each bucket is a few files.
        rows.withColumn(BUCKET, self.bucket(keys, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        found = [s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/data/{name}"))]
        return {n.split("=")[1]: [f"{name}/{n}"] for n in found if n.startswith(f"{BUCKET}=")}

    def _read(self, manifest: dict, only: Iterable[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        chosen = manifest["folders"] if only is None else {b: manifest["folders"][b] for b in only if b in manifest["folders"]}
        paths = [f"{self.path}/data/{f}" for folders in chosen.values() for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _pending(self, manifest: dict) -> DataFrame:
        """The records taken in and not merged yet; they come in the order of their batches, then of their own."""
        pending = manifest["pending"]
        schema = StructType.fromJson(pending["schema"]).add(NUMBER, "long").add(ATTEMPT, "string")
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{pending['root']}").parquet(*[f"{self.path}/data/{f}" for f in pending["folders"]])
        return rows.withColumn("seq", F.struct(NUMBER, "seq")).drop(NUMBER, ATTEMPT)

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        rows = self._read(manifest)
        return sink.replay(rows, self._pending(manifest), manifest["keys"]) if manifest.get("pending") else rows

    def write(self, df: DataFrame) -> bool:
        """Write the first version; False if there is one already."""
        if self.versions():
            return False
        folders = self._write(df, list(self.keys), self.buckets)
        self._commit({"schema": json.loads(df.schema.json()), "keys": list(self.keys), "buckets": self.buckets, "folders": folders, "applied": {}}, 0)
        return True

    def take(self, batch: tuple[str, int], records: DataFrame) -> bool:
        """Take in ``records`` (``seq``, ``operation`` and the table's columns) as they are; False if the batch was taken in before.

        What is read afterwards is what ``change`` with ``sink.replay`` would have left.
        """
        manifest = self.manifest()
        stream, number = batch
        if number <= manifest["applied"].get(stream, -1):
            return False
        sink.check_keys(records, manifest["keys"])
        names = [f["name"] for f in manifest["schema"]["fields"]]
        version = self.versions()[-1] + 1
        known = F.when(sink.kind(F.col("operation")).isNotNull(), F.col("operation")).alias("operation")
        rows = records.select("seq", known, *names)
        schema = json.loads(rows.schema.json())
        pending = manifest.get("pending") or {"schema": schema, "root": uuid.uuid4().hex, "folders": []}
        if pending["schema"] != schema:
            self.merge()
            return self.take(batch, records)
        # The number is in the path: in the rows it would have each batch compiled anew.
        name = f"{pending['root']}/{NUMBER}={version}/{ATTEMPT}={uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{name}")
        self._commit({**manifest, "pending": {**pending, "folders": [*pending["folders"], name]}, "applied": {**manifest["applied"], stream: number}}, version)
        if len(pending["folders"]) + 1 >= PENDING:
            self.merge()
        return True

    def merge(self) -> None:
        """Put the records taken in into their buckets."""
        manifest, known = self.manifest(), self.versions()
        if manifest.get("pending"):
            folders = self._replaced(manifest, self._pending(manifest), lambda old, new: sink.replay(old, new, manifest["keys"]))
            self._commit({k: v for k, v in manifest.items() if k != "pending"} | {"folders": folders}, known[-1] + 1)

    def _replaced(self, manifest: dict, records: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[str, list[str]]:
        """The folders of each bucket after ``step`` on those that ``records`` fall into."""
        keys, buckets, folders = manifest["keys"], manifest["buckets"], manifest["folders"]
        # At most as many rows as there are buckets.
        touched = sorted(str(r[0]) for r in records.select(self.bucket(keys, buckets).alias("b")).distinct().collect())
        if not touched:
            return folders
        new = self._write(step(self._read(manifest, touched), records), keys, buckets)
        return {b: f for b, f in folders.items() if b not in touched} | new

    def change(self, batch: tuple[str, int], records: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Apply ``step(old rows, records)`` to the buckets that ``records`` fall into; False if the batch was applied before."""
        stream, number = batch
        if number <= self.manifest()["applied"].get(stream, -1):
            return False
        self.merge()
        manifest, known = self.manifest(), self.versions()
        folders = dict(manifest["folders"])
        if manifest["keys"]:
            folders = self._replaced(manifest, records, step)
        elif not records.isEmpty():
            empty = self.spark.createDataFrame([], StructType.fromJson(manifest["schema"]))
            folders[""] = folders.get("", []) + self._write(step(empty, records), [], manifest["buckets"])[""]
        # Streams other than the current one are kept, so that none of them is applied twice.
        applied = {**manifest["applied"], stream: number}
        self._commit({**manifest, "folders": folders, "applied": applied}, known[-1] + 1)
        return True

    def compact(self) -> None:
        """Put the folders of a table without keys together."""
        manifest, known = self.manifest(), self.versions()
        if not manifest["keys"] and len(manifest["folders"].get("", [])) > 1:
            self._commit({**manifest, "folders": self._write(self._read(manifest), [], manifest["buckets"])}, known[-1] + 1)
