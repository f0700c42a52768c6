"""Every catalogue query against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from mapweave.plans import catalog, files  # noqa: F401  files registers its queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(row):
    return str(sorted((k, round(v, 6) if isinstance(v, float) else str(v)) for k, v in row.items()))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_duckdb(spark, duck, name):
    rows = catalog.QUERIES[name](spark, SF).collect()
    found = duck.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(plain(r.asDict()) for r in rows) == sorted(plain(dict(zip(columns, r, strict=True))) for r in found.fetchall())


def test_every_query_is_named_and_callable():
    assert len(catalog.QUERIES) > 60 and set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
