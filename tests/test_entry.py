"""Every registered query against its SQL, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
entry = pytest.importorskip("__spark_entry__")
duckdb = pytest.importorskip("duckdb")

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="the tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


# The operators for training data have tests of their own.
NAMES = sorted(name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name))


def test_every_query_has_its_sql():
    assert set(NAMES) <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, str(TABLES))
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(repr(row) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in df.select(*names).collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["order_status", "cnt"]
