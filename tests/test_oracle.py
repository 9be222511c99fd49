"""Every registered query against its SQL on an independent engine."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import survey
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# the training-data queries have tests of their own
OTHERS = set(entry.extra_queries())
QUERIES = {n: f for n, f in entry.queries().items() if n not in OTHERS}
EXPECTED = {n: f for n, f in entry.oracle_sql().items() if n not in OTHERS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_names_agree():
    assert survey.available() and set(EXPECTED) <= set(QUERIES)
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    found = duck.execute(EXPECTED[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
