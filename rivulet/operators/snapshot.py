"""Snapshots of tables in key order, resumable, as one plan a table.

A table's strategy follows from its sort keys: one key is a range scan, several
are a range scan over their struct (compared lexicographically), none is a scan
numbered by offset.  There is no loop over pages: the whole range is one scan
that Spark splits; pages are only a way to look at it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from . import envelope
from .ordering import with_row_number

FETCH_SIZE = 10_000


class KeyNotInTable(ValueError):
    """A key column is not in the table."""


@dataclass(frozen=True)
class ScanSpec:
    """What is read of a table: rows with start < key <= end (start itself too, unless it was read)."""

    table: str
    keys: tuple[str, ...]
    start: tuple | None = None
    end: tuple | None = None
    start_read: bool = False
    fetch_size: int = FETCH_SIZE

    @property
    def strategy(self) -> str:
        return ("offset", "single", "composite")[min(len(self.keys), 2)]


def check_keys(df: DataFrame, keys: tuple[str, ...]) -> None:
    if missing := [k for k in keys if k not in df.columns]:
        raise KeyNotInTable(f"no column {', '.join(missing)}")


def key_bounds(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row with ``min_k`` and ``max_k`` of each key, none if the table has no keyed row."""
    check_keys(df, keys)
    aggs = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("min", F.min), ("max", F.max))]
    return df.agg(*aggs).where(F.col(f"min_{keys[0]}").isNotNull())


def count_total(df: DataFrame) -> DataFrame:
    """One row with ``total``, none if the table is empty."""
    return df.agg(F.count("*").cast("long").alias("total")).where("total > 0")


def lexical_bounds(df: DataFrame, keys: tuple[str, ...]) -> tuple[tuple, tuple] | None:
    """The first and the last key, or None for a table without keyed rows."""
    check_keys(df, keys)
    key = F.struct(*keys)
    known = df.where(F.col(keys[0]).isNotNull())
    row = known.agg(F.min(key).alias("a"), F.max(key).alias("b")).first()
    return (tuple(row["a"]), tuple(row["b"])) if row["a"] is not None else None


def plan(df: DataFrame, table: str, keys: tuple[str, ...], position: list[envelope.KeyPosition] | None = None, fetch_size: int = FETCH_SIZE) -> ScanSpec | None:
    """The scan of a table, or None if it is empty.

    A stored position gives the start and keeps the end of the first run.  A
    position of other keys (another number of them, or other names) is ignored, so
    the table is read from its start; a single key stored without a name fits any.
    """
    if not keys:
        return ScanSpec(table, (), fetch_size=fetch_size or FETCH_SIZE) if df.take(1) else None
    if position and len(position) == len(keys) and all(p.key_name == k or (len(keys) == 1 and not p.key_name) for p, k in zip(position, keys, strict=True)):
        return ScanSpec(table, keys, tuple(p.last_read for p in position), tuple(p.snapshot_end for p in position), True, fetch_size or FETCH_SIZE)
    found = lexical_bounds(df, keys)
    return ScanSpec(table, keys, *found, fetch_size=fetch_size or FETCH_SIZE) if found else None


def literal_key(df: DataFrame, keys: tuple[str, ...], values: tuple) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(keys, values, strict=True)])


def after(df: DataFrame, keys: tuple[str, ...], values: tuple, inclusive: bool = False) -> Column:
    """Rows whose key comes after ``values``, written so that the first key's bound reaches the scan."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    lit = [F.lit(v).cast(kinds[k]) for k, v in zip(keys, values, strict=True)]
    if len(keys) == 1:
        return F.col(keys[0]) >= lit[0] if inclusive else F.col(keys[0]) > lit[0]
    key, bound = F.struct(*keys), literal_key(df, keys, values)
    return (F.col(keys[0]) >= lit[0]) & (key >= bound if inclusive else key > bound)


def upto(df: DataFrame, keys: tuple[str, ...], values: tuple) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if len(keys) == 1:
        return F.col(keys[0]) <= F.lit(values[0]).cast(kinds[keys[0]])
    return (F.col(keys[0]) <= F.lit(values[0]).cast(kinds[keys[0]])) & (F.struct(*keys) <= literal_key(df, keys, values))


def scan(df: DataFrame, spec: ScanSpec) -> DataFrame:
    """The rows of a scan, in no order."""
    check_keys(df, spec.keys)
    if not spec.keys:
        return df
    out = df.where(F.col(spec.keys[0]).isNotNull())
    if spec.start is not None:
        out = out.where(after(df, spec.keys, spec.start, inclusive=not spec.start_read))
    if spec.end is not None:
        out = out.where(upto(df, spec.keys, spec.end))
    return out


def page(df: DataFrame, spec: ScanSpec, ties: tuple[str, ...] = ()) -> DataFrame:
    """The scan's next ``fetch_size`` rows by key; ``ties`` orders rows of equal keys."""
    return scan(df, spec).orderBy(*spec.keys, *ties).limit(spec.fetch_size)


def offset_page(df: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(size)


def chunked(df: DataFrame, spec: ScanSpec, ties: tuple[str, ...] = ()) -> DataFrame:
    """The scan with ``chunk``, the number of the page that each row is on."""
    numbered = with_row_number(scan(df, spec), [*spec.keys, *ties], "rv_row")
    return numbered.select(*df.columns, F.floor(F.col("rv_row") / spec.fetch_size).cast("long").alias("chunk"))


def in_collation(df: DataFrame, column: str, ties: tuple[str, ...] = (), collation: str = "UNICODE_CI_AI") -> DataFrame:
    """``df`` in the order of a text column that ignores case and accents."""
    return df.orderBy(F.collate(F.col(column), collation), *ties)


def records(df: DataFrame, spec: ScanSpec, record_keys: tuple[str, ...] | None = None, order: list[str] | None = None) -> DataFrame:
    """Snapshot records: collection, operation, key, after, last_read and snapshot_end.

    With sort keys the key is a struct of ``record_keys`` and positions are
    structs of the sort keys; without, the key is ``table_offset`` in the order
    of ``order`` (all columns unless given) and there is no position.
    """
    rows = scan(df, spec)
    head = [F.lit(spec.table).alias("collection"), F.lit(envelope.SNAPSHOT).alias("operation")]
    row = F.struct(*[F.col(c) for c in df.columns]).alias("after")
    if not spec.keys:
        numbered = with_row_number(rows, order or df.columns, "rv_row")
        return numbered.select(*head, F.concat_ws("_", F.lit(spec.table), F.col("rv_row").cast("string")).alias("key"), row)
    check_keys(df, record_keys or spec.keys)
    end = literal_key(df, spec.keys, spec.end) if spec.end is not None else F.lit(None)
    return rows.select(*head, envelope.key_struct(record_keys or spec.keys).alias("key"), row, F.struct(*spec.keys).alias("last_read"), end.alias("snapshot_end"))


def next_page(df: DataFrame, spec: ScanSpec) -> tuple[DataFrame, ScanSpec] | None:
    """(the rows of the scan's next page, the scan that is left), or None at its end.

    A page has ``fetch_size`` rows and those that share its last row's key, so rows of
    equal keys are never parted.  Only the last key comes to the driver.
    """
    order = [F.col(k) for k in spec.keys]
    row = scan(df, spec).select(*order).orderBy(*order).limit(spec.fetch_size).agg(F.max(F.struct(*spec.keys)).alias("last")).first()
    if row["last"] is None:
        return None
    last = tuple(row["last"])
    return scan(df, replace(spec, end=last)), replace(spec, start=last, start_read=True)


def positions_after(spec: ScanSpec, last: tuple) -> list[envelope.KeyPosition]:
    """How far a scan is read when ``last`` is its last key."""
    return [envelope.KeyPosition(k, v, e) for k, v, e in zip(spec.keys, last, spec.end or last, strict=True)]


def key_positions(record: Row) -> list[envelope.KeyPosition]:
    """The position of a snapshot record, from its structs ``last_read`` and ``snapshot_end``."""
    last, end = record["last_read"].asDict(), record["snapshot_end"].asDict()
    return [envelope.KeyPosition(k, v, end[k]) for k, v in last.items()]


def with_position(found: DataFrame, spec: ScanSpec, done: Mapping[str, list[envelope.KeyPosition]] | None = None, mark: envelope.LogPosition | None = None) -> DataFrame:
    """Records with ``position``: the tables that are done, and this one up to the record, as JSON that ``parse_position`` reads."""
    kinds = {f.name: f.dataType for f in found.schema["last_read"].dataType.fields}
    one = [F.struct(F.lit(k).alias("key_name"), envelope.typed_column(F.col(f"last_read.{k}"), kinds[k]).alias("last_read"), envelope.typed_column(F.col(f"snapshot_end.{k}"), kinds[k]).alias("snapshot_end")) for k in spec.keys]
    own = F.to_json(one[0] if len(one) == 1 else F.array(*one), {"ignoreNullFields": "false"}) if len({str(kinds[k]) for k in spec.keys}) == 1 else F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(x, {"ignoreNullFields": "false"}) for x in one]), F.lit("]"))
    # The text is cut where this table's entry goes; the place holder cannot be part of a position.
    hole = "\x00"
    before, after = envelope.snapshot_position_json({**(done or {}), spec.table: [envelope.KeyPosition(hole, 0, 0)]}, mark).split(json.dumps({"key_name": hole, "last_read": 0, "snapshot_end": 0}, separators=(",", ":")))
    return found.withColumn("position", F.concat(F.lit(before), own, F.lit(after)))


def multi_table(tables: Mapping[str, tuple[DataFrame, ScanSpec | None]]) -> DataFrame:
    """Records of several tables with JSON keys and rows; empty tables add nothing."""
    out = None
    for name in sorted(tables):
        df, spec = tables[name]
        if spec is None:
            continue
        found = envelope.as_json(records(df, spec)).select("collection", "operation", "key", "after")
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no table has rows")
    return out
