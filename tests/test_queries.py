"""Every query with SQL equals it on the smallest tables."""

import duckdb
import pytest

from marketlake import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[k] for k in order)) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(answer.columns)
    assert found == rows_of(answer.columns, answer.fetchall())
