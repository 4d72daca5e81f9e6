"""Every query of the catalogue with an oracle, against DuckDB on the smallest data."""

import duckdb
import pytest

from sendero.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else str(v) if v is not None else None for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    frame = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    found = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    order = [found.columns.index(c) for c in columns]
    assert plain(tuple(r[c] for c in columns) for r in frame.collect()) == plain(tuple(r[i] for i in order) for r in found.fetchall())


def test_no_partner_without_oracle():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) == {"q_residual_duplicates"}
