"""Every query against its SQL in DuckDB, as multisets of rows."""

import math

import duckdb
import pytest

from linkscout.plans import catalog, oracle

TABLES = "region nation customer supplier part orders lineitem events".split()
@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else repr(float(value))
    return repr(float(value)) if hasattr(value, "as_tuple") else str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    found = [tuple(r) for r in df.collect()]
    cursor = duck.execute(oracle.all_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert multiset(df.columns, found) == multiset(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
