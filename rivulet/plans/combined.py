"""Snapshot first, then the change log from the mark taken before it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import changes, envelope, snapshot
from ..operators.envelope import LogPosition
from ..sources.catalog import TableKeys


@dataclass(frozen=True)
class Plan:
    """What a run does: scans (none if the snapshot is off or done), and where the log goes on."""

    scans: Mapping[str, snapshot.ScanSpec]
    mark: LogPosition | None


def plan(tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys], log_head: LogPosition | None, position: str = "", with_snapshot: bool = True, fetch_size: int = snapshot.FETCH_SIZE) -> Plan:
    """Decide from a stored position.

    A log position means that the snapshot is done.  A snapshot position goes
    on with its tables and keeps its mark, so that changes to rows read before
    the restart are not lost.  The mark is taken before the bounds.
    """
    stored = envelope.parse_position(position)
    if isinstance(stored, LogPosition):
        return Plan({}, stored)
    done, mark = stored or ({}, None)
    mark = mark or log_head
    if not with_snapshot:
        return Plan({}, mark)
    scans = {}
    for name in sorted(tables):
        spec = snapshot.plan(tables[name], name, keys[name].sort, done.get(name), fetch_size)
        if spec is not None:
            scans[name] = spec
    return Plan(scans, mark)


def feed(tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys], logs: Mapping[str, DataFrame], run: Plan) -> DataFrame:
    """All records of a bounded run, JSON keys and images: stage 0 is the snapshot, stage 1 the log."""
    from pyspark.sql import functions as F

    out = None
    for name, spec in run.scans.items():
        found = envelope.as_json(snapshot.records(tables[name], spec, keys[name].record or None))
        part = found.select(F.lit(0).alias("stage"), "collection", "operation", F.col("key").cast("string").alias("key"), F.lit(None).cast("string").alias("before"), "after")
        out = part if out is None else out.unionByName(part)
    for name, log in sorted(logs.items()):
        found = envelope.as_json(changes.records(log, keys[name].record, run.mark))
        part = found.select(F.lit(1).alias("stage"), "collection", "operation", "key", "before", "after")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("nothing to read")
    return out
