"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import TABLES, drop_tables, materialize

__all__ = ["TABLES", "Buckets", "bucket_bounds", "column", "drop_tables", "forget", "fresh", "materialize", "partitions_of", "slices", "table", "text_or_empty"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with underscores until no column is called so."""
    known, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` has about ``most_bytes`` in each (a longer row stands alone).

    At the end, memory that is free goes back to the system: workers live on, and what a
    stage leaves in them would be missing in the next.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_dictionary(col.type):
            col = col.dictionary_decode()
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to
    release_memory()


#: What operators keep in a worker from task to task, such as tokenizers with their memos.
HELD: list[dict] = []


def forget() -> None:
    """Drop what operators that ran in this worker before have kept: workers live on from stage to stage."""
    if any(HELD):
        for kept in HELD:
            kept.clear()
        release_memory()


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


MOST_BUCKETS = 1 << 16
#: Bounds are quantiles of about so many keys at most.
BOUND_SAMPLE = 1 << 21
#: Stands for null: it comes first.
LEAST_KEY = -(1 << 63)


def bucket_bounds(df: DataFrame, key: str, rows_per_bucket: int) -> np.ndarray:
    """Bounds that part rows into buckets of about ``rows_per_bucket`` (more, beyond 65,536 buckets).

    They are approximate quantiles of the key alone, so finding them reads one
    narrow column; beyond two million rows, of a sample of so many, which one task
    can hold however large the table is.  A key with more than a bucket's worth of
    rows is there more than once, null (as the least) like any other.  Bounds say
    where rows go and change no result that is not about place.
    """
    n = df.select(key).count()
    buckets = min(MOST_BUCKETS, -(-n // rows_per_bucket))
    if buckets < 2:
        return np.zeros(0, dtype=np.int64)
    keys = df.select(F.coalesce(F.col(key).cast("long"), F.lit(LEAST_KEY)).alias("k"))
    if n > BOUND_SAMPLE:
        keys = keys.sample(BOUND_SAMPLE / n, seed=7)
    at = [i / buckets for i in range(1, buckets)]
    found = keys.select(F.percentile_approx("k", at, 10 * buckets)).first()[0]
    return np.sort(np.array(found or [], dtype=np.int64))


class Buckets:
    """Deals the rows of one task to buckets that ascend with the key, null first.

    Rows of a key with several buckets are dealt over them by their text; rows that
    are equal in key and text go round from there.  The n-th equal row of a task goes
    to the same bucket whichever of them it is, so a task that runs again deals alike.
    """

    def __init__(self, bounds: np.ndarray) -> None:
        context = TaskContext.get()
        self.bounds, self.seen = bounds, {}
        self.shift = 7919 * context.partitionId() if context else 0

    def of(self, keys: pa.Array, texts: list[str]) -> np.ndarray:
        known = np.asarray(pc.fill_null(keys, LEAST_KEY), dtype=np.int64)
        out = np.searchsorted(self.bounds, known, side="left")
        several = np.searchsorted(self.bounds, known, side="right") - out
        for i in np.flatnonzero(several > 1).tolist():
            row = (int(known[i]), xxhash.xxh64_intdigest(texts[i].encode("utf-8", "replace")))
            nth = self.seen[row] = self.seen.get(row, -1) + 1
            out[i] += (row[1] + (nth + self.shift if nth else 0)) % int(several[i])
        return out
