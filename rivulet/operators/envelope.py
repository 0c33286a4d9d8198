"""Records: operation, collection, key, images before and after, position, metadata."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT, CREATE, UPDATE, DELETE = "snapshot", "create", "update", "delete"
#: Fixed value: metadata key of the server id.
SERVER_ID_KEY = "mysql.serverID"


@dataclass(frozen=True)
class LogPosition:
    """A place in the change log: row ``idx`` of the event that ends at ``pos`` of file ``name``."""

    name: str
    pos: int
    idx: int = 0
    prev: tuple[str, int] | None = None


@dataclass(frozen=True)
class KeyPosition:
    """How far a table was read by one key column."""

    key_name: str
    last_read: object
    snapshot_end: object


def log_position_json(p: LogPosition) -> str:
    out: dict = {"name": p.name, "pos": p.pos}
    if p.prev:
        out["prev"] = {"name": p.prev[0], "pos": p.prev[1]}
    if p.idx:
        out["idx"] = p.idx
    return json.dumps({"cdc_position": out}, separators=(",", ":"))


def snapshot_position_json(tables: dict[str, list[KeyPosition]], mark: LogPosition | None = None) -> str:
    """One key is an object, several are a list; the log mark taken before the snapshot rides along."""

    def one(keys: list[KeyPosition]) -> object:
        if len(keys) == 1:
            return {"key_name": keys[0].key_name, "last_read": typed(keys[0].last_read), "snapshot_end": typed(keys[0].snapshot_end)}
        return [{"key_name": k.key_name, "last_read": typed(k.last_read), "snapshot_end": typed(k.snapshot_end)} for k in keys]

    out: dict = {"snapshots": {t: one(k) for t, k in sorted(tables.items()) if k}}
    if mark:
        out["mark"] = {"name": mark.name, "pos": mark.pos, "idx": mark.idx}
    return json.dumps({"snapshot_position": out}, separators=(",", ":"))


def typed(value: object) -> object:
    """Numbers and texts as they are, other values with their type, so that they survive JSON."""
    import base64
    import datetime as dt
    import decimal

    if isinstance(value, bytes | bytearray):
        return {"type": "bytes", "value": base64.b64encode(bytes(value)).decode()}
    if isinstance(value, dt.datetime):
        return {"type": "timestamp", "value": value.isoformat()}
    if isinstance(value, dt.date):
        return {"type": "date", "value": value.isoformat()}
    if isinstance(value, decimal.Decimal):
        return {"type": "decimal", "value": str(value)}
    return value


def typed_column(value: Column, kind: T.DataType) -> Column:
    """The same as a column, to be made JSON."""
    named = lambda name, text: F.struct(F.lit(name).alias("type"), text.alias("value"))
    if isinstance(kind, T.BinaryType):
        return named("bytes", F.base64(value))
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return named("timestamp", F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if isinstance(kind, T.DateType):
        return named("date", value.cast("string"))
    if isinstance(kind, T.DecimalType):
        return named("decimal", value.cast("string"))
    return value


def untyped(value: object) -> object:
    import base64
    import datetime as dt
    import decimal

    if isinstance(value, dict) and set(value) == {"type", "value"}:
        read = {"bytes": base64.b64decode, "timestamp": dt.datetime.fromisoformat, "date": dt.date.fromisoformat, "decimal": decimal.Decimal}
        return read[value["type"]](value["value"])
    return value


def parse_position(text: str) -> LogPosition | tuple[dict[str, list[KeyPosition]], LogPosition | None] | None:
    """A log position, or the tables' key positions and the mark; None for an empty text."""
    if not text:
        return None
    data = json.loads(text)
    if found := data.get("cdc_position"):
        prev = found.get("prev")
        return LogPosition(found["name"], found["pos"], found.get("idx", 0), (prev["name"], prev["pos"]) if prev else None)
    snap = data["snapshot_position"]
    tables: dict[str, list[KeyPosition]] = {}
    for t, v in snap.get("snapshots", {}).items():
        entries = v if isinstance(v, list) else [v]
        tables[t] = [KeyPosition(e.get("key_name", ""), untyped(e["last_read"]), untyped(e["snapshot_end"])) for e in entries]
    mark = snap.get("mark")
    return tables, LogPosition(mark["name"], mark["pos"], mark.get("idx", 0)) if mark else None


def position_json(position: Column) -> Column:
    """The text of ``log_position_json`` for a position struct: name, pos, idx and prev."""
    place = [position["name"].alias("name"), position["pos"].alias("pos"), position["prev"].alias("prev"), F.nullif(position["idx"], F.lit(0)).alias("idx")]
    return F.to_json(F.struct(F.struct(*place).alias("cdc_position")))


def key_struct(keys: tuple[str, ...], source: str | None = None) -> Column:
    """The key as a struct of its columns (of the struct ``source`` if given)."""
    return F.struct(*[(F.col(f"{source}.{k}") if source else F.col(k)).alias(k) for k in keys])


def metadata(collection: Column, created_at: Column, server_id: Column, payload: tuple[str, int] | None = None, key: tuple[str, int] | None = None) -> Column:
    """A map of texts; ``created_at`` is in epoch seconds."""
    items = [F.lit("collection"), collection, F.lit("created_at"), F.date_format(F.timestamp_seconds(created_at), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(SERVER_ID_KEY), server_id.cast("string")]
    for name, found in (("payload_schema", payload), ("key_schema", key)):
        if found:
            items += [F.lit(f"{name}_subject"), F.lit(found[0]), F.lit(f"{name}_version"), F.lit(str(found[1]))]
    return F.create_map(*items)


def as_json(records: DataFrame) -> DataFrame:
    """Key and images as JSON texts, so that records of several tables have one schema."""
    kinds = dict(records.dtypes)
    return records.select(*[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if c in ("key", "before", "after", "position") and kinds[c].startswith("struct") else F.col(c) for c in records.columns])


def from_json_key(records: DataFrame, schema: str, column: str = "key") -> DataFrame:
    """Key columns parsed with their types, which keeps all digits of large integers; a key that lacks one fails."""
    parsed = F.from_json(column, schema)
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    checked = [F.when(F.col("rv_key").isNull() | F.col(f"rv_key.{n}").isNull(), F.raise_error(F.lit(f"key has no {n}"))).otherwise(F.col(f"rv_key.{n}")).alias(n) for n in names]
    return records.withColumn("rv_key", parsed).select(*records.columns, *checked)
