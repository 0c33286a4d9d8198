"""Which tables are read, and by which keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class RuleError(ValueError):
    """A table rule that cannot be read."""


class NoTablesError(ValueError):
    """No table matches the rules."""


class KeylessTableError(ValueError):
    """A table has neither primary key nor sorting column, and unsafe snapshots are off."""


def parse_rule(rule: str) -> tuple[bool, str]:
    """(include, pattern) of ``+pattern``, ``-pattern`` or ``pattern``."""
    if len(rule) < 2:
        raise RuleError(f"rule {rule!r} is too short")
    return (rule[0] != "-", rule[1:] if rule[0] in "+-" else rule)


def rules_of(rules: Iterable[str]) -> list[tuple[bool, str]]:
    """Rules in order; ``*`` includes every table."""
    return [(True, "") if r.strip() == "*" else parse_rule(r.strip()) for r in rules]


def included(tables: Iterable[str], rules: Iterable[str]) -> list[str]:
    """The tables whose last matching rule includes them, in order of name.

    Patterns are regular expressions that may match anywhere in a name.
    """
    parsed = [(keep, re.compile(pattern)) for keep, pattern in rules_of(rules)]
    return sorted(t for t in tables if next((keep for keep, p in reversed(parsed) if p.search(t)), False))


def rule_column(name: Column, rules: Iterable[str]) -> Column:
    """The same decision as a Boolean column."""
    out = F.lit(False)
    for keep, pattern in rules_of(rules):
        out = F.when(name.rlike(pattern) if pattern else F.lit(True), F.lit(keep)).otherwise(out)
    return out


def in_tables(log: DataFrame, database: str, tables: Iterable[str]) -> DataFrame:
    """Change-log rows of exactly these tables."""
    return log.where((F.col("database") == database) & F.col("collection").isin(*tables))


@dataclass(frozen=True)
class TableKeys:
    """``sort`` orders the snapshot, ``record`` identifies a row; both may be empty."""

    sort: tuple[str, ...]
    record: tuple[str, ...]


def resolve_keys(tables: Iterable[str], primary: Mapping[str, Iterable[str]], sorting: Mapping[str, str] | None = None, unsafe: bool = False) -> dict[str, TableKeys]:
    """Keys of each table: a configured sorting column sorts, else the primary key.

    Rows are always identified by the primary key if there is one.  A table
    without either is an error unless ``unsafe``.
    """
    out = {}
    for t in tables:
        record = tuple(primary.get(t, ()))
        column = (sorting or {}).get(t, "")
        sort = (column,) if column else record
        if not sort and not unsafe:
            raise KeylessTableError(f"table {t} has no primary key and no sorting column; allow unsafe snapshots to read it by offset")
        out[t] = TableKeys(sort, record or sort)
    return out


@dataclass
class KeyCache:
    """Primary keys by table, looked up once."""

    look_up: object
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def get(self, table: str) -> tuple[str, ...]:
        if table not in self.known:
            self.known[table] = tuple(self.look_up(table))
        return self.known[table]


def tables_of(spark: SparkSession, database: str) -> list[str]:
    """Tables of a database in Spark's catalog."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def tables_in(schema_tables: DataFrame, database: str) -> list[str]:
    """Table names of ``information_schema.tables``; a bounded list, one entry a table."""
    rows = schema_tables.where(F.col("table_schema") == database).select("table_name").distinct().collect()
    return sorted(r[0] for r in rows)


def primary_keys_in(key_usage: DataFrame, database: str) -> dict[str, tuple[str, ...]]:
    """Primary keys of ``information_schema.key_column_usage``, in ordinal order."""
    rows = key_usage.where((F.col("table_schema") == database) & (F.col("constraint_name") == "PRIMARY")).select("table_name", "column_name", "ordinal_position").distinct().collect()
    out: dict[str, tuple[str, ...]] = {}
    for r in sorted(rows, key=lambda r: (r["table_name"], r["ordinal_position"])):
        out[r["table_name"]] = (*out.get(r["table_name"], ()), r["column_name"])
    return out
