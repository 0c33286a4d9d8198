"""Every registered engine query against its SQL, run by DuckDB on the same files."""

import math

import duckdb
import pytest

from rivulet.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(repr(one(r[i])) for i in order) for r in found), key=str)


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, data, db, name):
    df = QUERIES[name](spark, data)
    want = db.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_chunk_ties_numbers_across_buckets(spark, data, db, monkeypatch):
    """Every group is returned, and numbers go on from one bucket to the next."""
    from rivulet.operators import ordering
    from rivulet.plans import queries

    total, groups = db.execute("SELECT count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem").fetchone()
    assert groups > 500
    monkeypatch.setattr(queries, "with_row_number", lambda df, order, name: ordering.with_row_number(df, order, name, rows_per_bucket=total // 7))
    assert len(ordering.bounds(queries.read(spark, data, "lineitem"), ["l_orderkey", "l_linenumber"], total // 7)) > 3
    df = QUERIES["chunk_ties"](spark, data)
    want = db.execute(ORACLE_SQL["chunk_ties"])
    columns = [d[0] for d in want.description]
    found = [tuple(r) for r in df.collect()]
    assert len(found) == groups and max(r[df.columns.index("upto")] for r in found) == total
    assert rows(df.columns, found) == rows(columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).take(1)
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_llm(tmp_path):
    """The other queries are there when the training-data folders are not."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "rivulet", tmp_path / "rivulet", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'snapshot_single_key' in q and not [k for k in q if k.startswith('op')], q; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "HOME": str(tmp_path)}, check=True)
