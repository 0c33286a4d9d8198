"""Records from a row-change log.

A log has one row an event: ``file``, ``pos``, ``ts`` (epoch seconds),
``server_id``, ``database``, ``collection``, ``action`` (insert, update or
delete) and ``rows``, an array of row structs; an update's rows are pairs of
images before and after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import envelope
from .envelope import LogPosition

ROW_ACTIONS = ("insert", "update", "delete")


def file_number(name: Column) -> Column:
    """The number that ends a log file's name; names compare by it, whatever its width."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("long")


def row_events(log: DataFrame) -> DataFrame:
    """Events that change rows; others (schema changes, rotations) are not modelled."""
    return log.where(F.col("action").isin(*ROW_ACTIONS))


def with_previous(log: DataFrame) -> DataFrame:
    """``log`` with ``prev``, the position of the event before in log order (null for the first).

    Inside a file that is the event before; a file's first event follows the
    last one of the nearest file before, found in a table of one row a file.
    """
    place = F.struct(F.col("file").alias("name"), F.col("pos"))
    inside = Window.partitionBy("file").orderBy("pos")
    files = log.groupBy("file").agg(F.max("pos").alias("rv_last"))
    order = Window.orderBy(file_number(F.col("file")), "file")
    before = F.lag(F.struct(F.col("file").alias("name"), F.col("rv_last").alias("pos"))).over(order)
    leads = files.select("file", before.alias("rv_lead"))
    return log.withColumn("rv_prev", F.lag(place).over(inside)).join(leads, "file").select(*log.columns, F.coalesce("rv_prev", "rv_lead").alias("prev"))


def pairs(log: DataFrame) -> DataFrame:
    """One row a changed row: ``idx`` in its event, ``before`` and ``after``.

    Inserts have no image before, deletes none after.  An update with an odd
    number of images fails.
    """
    rows = row_events(log)
    empty = F.lit(None).cast(rows.schema["rows"].dataType.elementType)
    n = F.size("rows")
    last = F.floor(n / 2).cast("int") - 1
    none = F.filter(F.transform("rows", lambda r: F.struct(r.alias("before"), r.alias("after"))), lambda _: F.lit(False))
    twos = F.when(n % 2 != 0, F.raise_error(F.lit("an update has an odd number of row images"))).when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(F.get("rows", 2 * i).alias("before"), F.get("rows", 2 * i + 1).alias("after")))).otherwise(none)
    images = (
        F.when(F.col("action") == "update", twos)
        .when(F.col("action") == "insert", F.transform("rows", lambda r: F.struct(empty.alias("before"), r.alias("after"))))
        .otherwise(F.transform("rows", lambda r: F.struct(r.alias("before"), empty.alias("after"))))
    )
    kept = [c for c in rows.columns if c != "rows"]
    return rows.select(*kept, F.posexplode(images).alias("idx", "rv_image")).select(*kept, "idx", "rv_image.before", "rv_image.after")


def after_position(changes: DataFrame, position: LogPosition | None) -> DataFrame:
    """Changes that come after a position, also inside an event: ``idx`` is counted from the event's first row always."""
    if position is None:
        return changes
    number = file_number(F.lit(position.name))
    here = F.struct(file_number(F.col("file")).alias("f"), F.col("pos").cast("long").alias("p"), F.col("idx").cast("long").alias("i"))
    there = F.struct(number.alias("f"), F.lit(position.pos).cast("long").alias("p"), F.lit(position.idx).cast("long").alias("i"))
    return changes.where((file_number(F.col("file")) >= number) & (here > there))


def operation(action: Column) -> Column:
    return F.when(action == "insert", envelope.CREATE).when(action == "update", envelope.UPDATE).when(action == "delete", envelope.DELETE)


def record_key(keys: tuple[str, ...]) -> Column:
    """Key columns of the image after (before, for a delete); without keys ``file_pos``."""
    if not keys:
        return F.concat_ws("_", "file", F.col("pos").cast("string"))
    return F.struct(*[F.when(F.col("action") == "delete", F.col(f"before.{k}")).otherwise(F.col(f"after.{k}")).alias(k) for k in keys])


def records(log: DataFrame, keys: tuple[str, ...], position: LogPosition | None = None, payload: tuple[str, int] | None = None, key: tuple[str, int] | None = None) -> DataFrame:
    """Change records of one table's log: operation, key, before, after, position and metadata."""
    changes = after_position(pairs(with_previous(row_events(log))), position)
    place = F.struct(F.col("file").alias("name"), F.col("pos"), F.col("idx"), F.col("prev"))
    return changes.select(
        "collection",
        operation(F.col("action")).alias("operation"),
        record_key(keys).alias("key"),
        "before",
        "after",
        place.alias("position"),
        envelope.metadata(F.col("collection"), F.col("ts"), F.col("server_id"), payload, key).alias("metadata"),
    )


def head(log: DataFrame) -> LogPosition | None:
    """The position of the log's last event."""
    row = log.agg(F.max(F.struct(file_number(F.col("file")).alias("f"), F.col("pos").alias("p"), F.col("file").alias("name"))).alias("m")).first()["m"]
    return LogPosition(row["name"], row["p"], (1 << 31) - 1) if row else None
