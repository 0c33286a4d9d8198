"""Applying record batches to tables: ordered upserts, appends and deletes.

Records have ``seq`` (a total order), ``collection`` and ``operation`` beside
the row's columns.  With one unique key, applying records one by one leaves for
each key what its last record says, so a batch of any length is one aggregation
and one join.  Tables with more unique keys need the order: see ``fold_conflicts``.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from . import envelope
from .components import components
from .ordering import with_run_number

UPSERT, DELETE_KIND = "upsert", "delete"


class SinkError(ValueError):
    """Records that cannot be applied."""


def kind(operation: Column) -> Column:
    """upsert or delete; an unknown operation fails."""
    return F.when(operation.isin(envelope.SNAPSHOT, envelope.CREATE, envelope.UPDATE), UPSERT).when(operation == envelope.DELETE, DELETE_KIND).otherwise(F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(operation, F.lit("null")))).cast("string"))


def run_batches(records: DataFrame, seq: str = "seq") -> DataFrame:
    """``records`` with ``kind`` and ``batch``: consecutive records of one kind and table share a batch."""
    table = F.when(F.col("collection").isNull() | (F.col("collection") == ""), F.raise_error(F.lit("a record has no collection")).cast("string")).otherwise(F.col("collection"))
    rows = records.withColumns({"kind": kind(F.col("operation")), "collection": table})
    return with_run_number(rows, [seq], F.struct("kind", "collection"), "batch")


def check_keys(target: DataFrame, keys: Iterable[str]) -> list[str]:
    keys = list(keys)
    if not keys:
        raise SinkError("deletes and upserts need a key; without one, append")
    if missing := [k for k in keys if k not in target.columns]:
        raise SinkError(f"the target has no column {', '.join(missing)}")
    return keys


def last_by_key(records: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The last record of each key: an aggregation, so hot keys shrink before the shuffle.

    A key with a null in it equals no other, as in a unique index, so each record of one stands.
    """
    rest = F.struct(*[c for c in records.columns if c not in keys])
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    own = F.when(null, F.col(seq)).alias("rv_own")
    return records.groupBy(*keys, own).agg(F.max_by(rest, seq).alias("rv_last")).select(*keys, "rv_last.*")


def columns_alike(target: DataFrame, rows: DataFrame) -> None:
    if extra := [c for c in rows.columns if c not in target.columns]:
        raise SinkError(f"the target has no column {', '.join(extra)}")
    if missing := [c for c in target.columns if c not in rows.columns]:
        raise SinkError(f"the records have no column {', '.join(missing)}")


def upsert(target: DataFrame, records: DataFrame, keys: Iterable[str], seq: str = "seq") -> DataFrame:
    """The target after inserting each record or replacing the row with its key."""
    keys = check_keys(target, keys)
    rows = last_by_key(records, keys, seq).drop(seq)
    columns_alike(target, rows)
    return target.join(rows.select(*keys), keys, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def append(target: DataFrame, records: DataFrame, seq: str = "seq") -> DataFrame:
    """The target and all records: what an upsert is without a unique key."""
    rows = records.drop(seq)
    columns_alike(target, rows)
    return target.unionByName(rows.select(*target.columns))


def delete(target: DataFrame, doomed: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The target without rows whose key occurs in ``doomed``; null keys match nothing."""
    keys = check_keys(target, keys)
    return target.join(doomed.select(*keys).distinct(), keys, "left_anti").select(*target.columns)


def replay(target: DataFrame, records: DataFrame, keys: Iterable[str], seq: str = "seq") -> DataFrame:
    """The target after applying mixed records (with ``operation``) in order."""
    keys = check_keys(target, keys)
    last = last_by_key(records.withColumn("operation", kind(F.col("operation"))), keys, seq)
    rows = last.where(F.col("operation") == UPSERT).select(*target.columns)
    return target.join(last.select(*keys), keys, "left_anti").select(*target.columns).unionByName(rows)


def replay_images(target: DataFrame, records: DataFrame, keys: Iterable[str], seq: str = "seq", move_keys: bool = False) -> DataFrame:
    """Replay of records with images ``before`` and ``after``; ``move_keys`` also deletes the key an update left."""
    keys = check_keys(target, keys)
    put = records.where(F.col("operation") != envelope.DELETE).select(F.struct(F.col(seq).alias("s"), F.lit(1).alias("o")).alias("seq"), "operation", "after.*")
    gone = records.where(F.col("operation") == envelope.DELETE).select(F.struct(F.col(seq).alias("s"), F.lit(1).alias("o")).alias("seq"), "operation", "before.*")
    flat = put.unionByName(gone)
    if move_keys:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
        left = records.where((F.col("operation") == envelope.UPDATE) & F.col("before").isNotNull() & ~same)
        flat = flat.unionByName(left.select(F.struct(F.col(seq).alias("s"), F.lit(0).alias("o")).alias("seq"), F.lit(envelope.DELETE).alias("operation"), "before.*"))
    return replay(target, flat, keys, "seq")


def fold_conflicts(target: DataFrame, records: DataFrame, uniques: list[list[str]], seq: str = "seq") -> DataFrame:
    """Upsert into a table with several unique keys, the primary key first.

    A record replaces all columns, the primary key included, of the row that
    holds one of its unique values (keys tried in order); without such a row it
    is inserted.  That depends on order, but only among rows that share unique
    values, so rows and records are grouped by connected components of shared
    values and each group is folded on its own.  Rows of the target share nothing
    with each other, so only those that hold a value of a record take part; the
    others are not touched.  ``seq`` may have any type that orders.
    """
    for keys in uniques:
        check_keys(target, keys)
    columns = target.columns
    columns_alike(target, records.drop(seq))
    values = F.array_compact(F.array(*[F.when(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull(), F.concat_ws("\x1f", F.lit(str(i)), *[F.col(k).cast("string") for k in keys])) for i, keys in enumerate(uniques)]))
    new = records.select(*columns, F.col(seq).alias("rv_seq"), F.lit(True).alias("rv_new"), values.alias("rv_values"))
    old = target.select(*columns, F.lit(None).cast(records.schema[seq].dataType).alias("rv_seq"), F.lit(False).alias("rv_new"), values.alias("rv_values")).withColumn("rv_first", F.get("rv_values", F.lit(0)))
    held = new.select(F.explode("rv_values").alias("v")).distinct()
    hit = old.select("rv_first", F.explode("rv_values").alias("v")).join(held, "v", "left_semi").select("rv_first").distinct()
    free = old.join(hit, "rv_first", "left_anti").select(*columns)
    rows = old.join(hit, "rv_first", "left_semi").drop("rv_first").unionByName(new)
    first = F.get("rv_values", F.lit(0))
    roots = components(rows.select(first.alias("a"), F.explode("rv_values").alias("b")))
    # A record without any unique value is a group of its own and simply stays.
    alone = new.where(F.size("rv_values") == 0).select(*columns)
    grouped = rows.where(F.size("rv_values") > 0).withColumn("rv_first", first).join(roots, F.col("rv_first") == F.col("node"))
    order = F.row_number().over(Window.partitionBy("root").orderBy("rv_new", "rv_seq")).alias("rv_nth")
    schema = to_arrow_schema(target.schema)

    def fold(group: pa.Table) -> pa.Table:
        rows: list[dict] = []
        held: list[dict[tuple, dict]] = [{} for _ in uniques]
        taken = sorted(group.to_pylist(), key=lambda r: r["rv_nth"])
        for r in taken:
            record = {c: r[c] for c in columns}
            old = next((h[t] for keys, h in zip(uniques, held, strict=True) if (t := tuple(record[k] for k in keys)) in h), None) if r["rv_new"] else None
            if old is None:
                rows.append(record)
                old = record
            else:
                for keys, h in zip(uniques, held, strict=True):
                    if h.get(t := tuple(old[k] for k in keys)) is old:
                        del h[t]
                old.update(record)
            for keys, h in zip(uniques, held, strict=True):
                t = tuple(old[k] for k in keys)
                if h.get(t, old) is not old:
                    raise SinkError(f"a record takes unique values of two rows: {t}")
                if all(v is not None for v in t):
                    h[t] = old
        return pa.Table.from_pylist(rows, schema=schema)

    folded = grouped.select(*columns, "rv_new", order, "root").groupBy("root").applyInArrow(fold, target.schema)
    return free.unionByName(folded).unionByName(alone)
