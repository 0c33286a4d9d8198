"""Databases over JDBC: partitioned reads, pushed-down bounds, and statements of a sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.snapshot import ScanSpec


@dataclass(frozen=True)
class Database:
    """How a database is reached; ``quote`` is put around identifiers."""

    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)
    quote: str = "`"
    #: What stands for a bound value in statements: ``?`` or ``%s``, as the Python driver has it.
    placeholder: str = "?"
    #: Whether a backslash in a text literal escapes; None: as is usual for the kind of database.
    backslash_escapes: bool | None = None
    #: Whether pages are told as in the SQL standard (OFFSET .. FETCH) rather than by LIMIT.
    standard_pages: bool = False

    @property
    def escapes(self) -> bool:
        return self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) if self.backslash_escapes is None else self.backslash_escapes

    def name(self, identifier: str) -> str:
        return self.quote + identifier.replace(self.quote, 2 * self.quote) + self.quote

    def page(self, first: int, size: int | None) -> str:
        """The clause that skips ``first`` rows and takes ``size``, or all that follow."""
        if self.standard_pages:
            return f"OFFSET {first} ROWS" + (f" FETCH NEXT {size} ROWS ONLY" if size is not None else "")
        return f"LIMIT {(1 << 63) - 1 if size is None else size} OFFSET {first}"

    def in_statement(self, identifier: str) -> str:
        """A name inside a statement with bound values; where ``%s`` binds, a per cent sign is written twice."""
        return self.name(identifier).replace("%", "%%") if self.placeholder == "%s" else self.name(identifier)

    def options(self, fetch_size: int | None = None) -> dict[str, str]:
        more = {"fetchsize": str(fetch_size)} if fetch_size else {}
        return {"url": self.url, "driver": self.driver, "preferTimestampNTZ": "true", **self.properties, **more}


def literal(value: object, escapes: bool = True) -> str:
    """A SQL literal of a key value; ``escapes`` says whether the database reads a backslash as an escape."""
    import datetime as dt

    if value is None:
        raise ValueError("a null is no bound")
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int | float):
        return repr(value)
    if isinstance(value, bytes | bytearray):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value).replace("'", "''")
    return "'" + (text.replace("\\", "\\\\") if escapes else text) + "'"


def after_sql(db: Database, keys: Sequence[str], values: Sequence, inclusive: bool) -> str:
    """Lexicographic comparison of several keys, spelt out for databases without row values."""
    out = []
    for i, k in enumerate(keys):
        same = [f"{db.name(a)} = {literal(b, db.escapes)}" for a, b in zip(keys[:i], values[:i], strict=True)]
        last = ">=" if inclusive and i == len(keys) - 1 else ">"
        out.append(" AND ".join([*same, f"{db.name(k)} {last} {literal(values[i], db.escapes)}"]))
    return "(" + " OR ".join(f"({x})" for x in out) + ")"


def upto_sql(db: Database, keys: Sequence[str], values: Sequence) -> str:
    out = []
    for i, k in enumerate(keys):
        same = [f"{db.name(a)} = {literal(b, db.escapes)}" for a, b in zip(keys[:i], values[:i], strict=True)]
        last = "<=" if i == len(keys) - 1 else "<"
        out.append(" AND ".join([*same, f"{db.name(k)} {last} {literal(values[i], db.escapes)}"]))
    return "(" + " OR ".join(f"({x})" for x in out) + ")"


def where_sql(db: Database, spec: ScanSpec) -> str:
    parts = [f"{db.name(spec.keys[0])} IS NOT NULL"] if spec.keys else []
    if spec.start is not None:
        parts.append(after_sql(db, spec.keys, spec.start, not spec.start_read))
    if spec.end is not None:
        parts.append(upto_sql(db, spec.keys, spec.end))
    return " AND ".join(parts) or "1 = 1"


def bounds(spark: SparkSession, db: Database, table: str, keys: Sequence[str]) -> DataFrame:
    """Least and greatest value of each key, computed by the database."""
    found = ", ".join(f"{f}({db.name(k)}) AS {db.name(f'{n}_{k}')}" for k in keys for f, n in (("MIN", "min"), ("MAX", "max")))
    return spark.read.format("jdbc").options(**db.options(), query=f"SELECT {found} FROM {db.name(table)}").load()


def count(spark: SparkSession, db: Database, table: str) -> int:
    return int(spark.read.format("jdbc").options(**db.options(), query=f"SELECT COUNT(*) AS {db.name('total')} FROM {db.name(table)}").load().first()[0])


def read(spark: SparkSession, db: Database, spec: ScanSpec, partitions: int = 1) -> DataFrame:
    """The rows of a scan, by several connections at once if its one key is an integer or it has none.

    Without a key, each connection reads a page of the table in the order of all its columns.
    """
    table, base = db.name(spec.table), where_sql(db, spec)
    options = db.options(spec.fetch_size)
    if not spec.keys and partitions > 1:
        whole = spark.read.format("jdbc").options(**options, query=f"SELECT * FROM {table}").load()
        order, size = ", ".join(map(db.name, whole.columns)), max(1, -(-count(spark, db, spec.table) // partitions))
        # Rows that are written meanwhile go to the last page, which has no end.
        limits = [db.page(i * size, size if i < partitions - 1 else None) for i in range(partitions)]
        pages = [spark.read.format("jdbc").options(**options, query=f"SELECT * FROM {table} ORDER BY {order} {limit}").load() for limit in limits]
        return reduce(DataFrame.unionByName, pages)
    single = len(spec.keys) == 1 and spec.start is not None and isinstance(spec.start[0], int) and isinstance(spec.end[0], int)
    if partitions < 2 or not single or spec.end[0] <= spec.start[0]:
        return spark.read.format("jdbc").options(**options, query=f"SELECT * FROM {table} WHERE {base}").load()
    a, b, k = spec.start[0], spec.end[0], db.name(spec.keys[0])
    n = min(partitions, b - a + 1)
    edges = [a + (b - a + 1) * i // n for i in range(n)] + [b + 1]
    predicates = [f"{base} AND {k} >= {x} AND {k} < {y}" for x, y in zip(edges, edges[1:], strict=False)]
    return spark.read.jdbc(db.url, table, predicates=predicates, properties={key: v for key, v in options.items() if key != "url"})


# Statements as the dialect with ON DUPLICATE KEY wants them; values are bound, not spelt.


def upsert_sql(db: Database, table: str, columns: Sequence[str], rows: int = 1) -> str:
    values = ", ".join("(" + ", ".join([db.placeholder] * len(columns)) + ")" for _ in range(rows))
    sets = ", ".join(f"{db.in_statement(c)} = VALUES({db.in_statement(c)})" for c in columns)
    return f"INSERT INTO {db.in_statement(table)} ({', '.join(map(db.in_statement, columns))}) VALUES {values} ON DUPLICATE KEY UPDATE {sets}"


def delete_sql(db: Database, table: str, keys: Sequence[str], rows: int = 1) -> str:
    if not keys:
        raise ValueError("a delete needs a key")
    if len(keys) == 1:
        return f"DELETE FROM {db.in_statement(table)} WHERE {db.in_statement(keys[0])} IN ({', '.join([db.placeholder] * rows)})"
    one = "(" + " AND ".join(f"{db.in_statement(k)} = {db.placeholder}" for k in keys) + ")"
    return f"DELETE FROM {db.in_statement(table)} WHERE " + " OR ".join([one] * rows)


def tables_sql() -> str:
    return "SELECT table_name FROM information_schema.tables WHERE table_schema = ?"


def primary_key_sql() -> str:
    return "SELECT column_name FROM information_schema.key_column_usage WHERE constraint_name = 'PRIMARY' AND table_schema = ? AND table_name = ? ORDER BY ordinal_position"


def server_id_sql() -> str:
    return "SELECT @@server_id AS server_id"


def lock_sql(db: Database, tables: Iterable[str]) -> tuple[str, str]:
    """Statements that hold the tables still while bounds and log position are taken, and let go."""
    names = ", ".join(db.name(t) for t in sorted(tables))
    if not names:
        raise ValueError("no table to lock")
    return f"FLUSH TABLES {names} WITH READ LOCK", "UNLOCK TABLES"


@contextmanager
def locked(connect: Callable[[], object], db: Database, tables: Iterable[str]) -> Iterator[None]:
    """Holds the tables still; the lock lives as long as the connection that took it."""
    lock, unlock = lock_sql(db, tables)
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(lock)
        try:
            yield
        finally:
            cursor.execute(unlock)
    finally:
        connection.close()


def server_id(spark: SparkSession, db: Database) -> str:
    return str(spark.read.format("jdbc").options(**db.options(), query=server_id_sql()).load().first()[0])


def information_schema(spark: SparkSession, db: Database, view: str) -> DataFrame:
    """``tables`` or ``key_column_usage`` with column names in lower case."""
    df = spark.read.format("jdbc").options(**db.options(), dbtable=f"information_schema.{view}").load()
    return df.toDF(*[c.lower() for c in df.columns])


def append(df: DataFrame, db: Database, table: str, batch_size: int = 1000) -> None:
    """Insert rows, many a statement, from all partitions."""
    df.write.format("jdbc").options(**db.options(), dbtable=db.name(table), batchsize=str(batch_size)).mode("append").save()
