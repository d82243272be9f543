"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from sievework.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, list | tuple):
        return "[" + ",".join(map(text, value)) + "]"
    return str(value)


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(text(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    want = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert lines(df.columns, df.collect()) == lines(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_gives_the_same_rows_again(spark, name):
    first, again = (catalog.QUERIES[name](spark, DIR) for _ in range(2))
    rows = lines(first.columns, first.collect())
    assert rows or name == "semantic_duplicates"  # no two vectors there are that near
    if name.startswith("semantic_"):  # sums of floats may come in another order
        assert len(rows) == again.count()
    else:
        assert rows == lines(again.columns, again.collect())


def test_entry(spark):
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
