"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from linkscout.llm import catalog, oracle


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(float(r[i]) if isinstance(r[i], (int, float)) else r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    cursor = duck.execute(oracle.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())


def test_names():
    numbers = {int(n[2:].split("_")[0]) for n in catalog.QUERIES}
    assert numbers == set(range(1, 14)) and len(catalog.QUERIES) == 13
