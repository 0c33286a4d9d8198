"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tables that this driver has written to the shared folder and not dropped.
TABLES: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    temporary folder when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='rivulet-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    TABLES.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_tables(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables written since ``TABLES`` had ``since`` entries; nothing may read them any more."""
    for path in TABLES[since:]:
        delete(spark, path)
    del TABLES[since:]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were written inside; results have to be read or written before.

    A query returns a plan that reads its tables, so it cannot delete them itself.
    """
    before = len(TABLES)
    try:
        yield
    finally:
        drop_tables(spark, before)


def drop_last(spark: SparkSession, before: int) -> None:
    """Delete the table written ``before`` tables before the last."""
    delete(spark, TABLES.pop(-1 - before))
