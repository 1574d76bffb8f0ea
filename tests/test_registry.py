"""The driver contract, and every query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = Path(__file__).resolve().parents[1]
NAMES = sorted(__spark_entry__.registry.queries())
ORACLE = __spark_entry__.registry.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    out = __spark_entry__.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in out.collect()]
    if name not in ORACLE:
        assert rows
        return
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(out.columns)
    assert table(out.columns, rows) == table(names, result.fetchall())


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_works_without_the_optional_files(tmp_path):
    """A copy without the training-data folders still imports and lists the other queries."""
    import shutil

    shutil.copytree(ROOT / "tessella", tmp_path / "tessella", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'label_frequency' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
