"""Every registered query against its SQL, run by DuckDB on the same files."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from oracle.sql import oracle_queries
from shelfwise.plans.catalog import CATALOG

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def ordered(found):
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_an_oracle():
    assert set(CATALOG) == set(oracle_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = ordered(tuple(r) for r in df.select(*columns).collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = ordered(tuple(r[i] for i in at) for r in cursor.fetchall())
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected, strict=True):
        assert a == b


def test_the_library_stands_without_the_training_data_operators(monkeypatch):
    """Also where one of the libraries they need is missing."""
    for missing in ("corpus_pipeline", "ahocorasick"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n.startswith("shelfwise.llm") or n == "corpus_pipeline"]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, missing, None)
            with pytest.warns(UserWarning, match="no training-data queries"):
                assert set(entry.queries()) == set(CATALOG)
            with pytest.warns(UserWarning, match="no training-data queries"):
                assert set(entry.oracle_sql()) == set(CATALOG)


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1
