"""Every query with SQL gives what DuckDB gives on the same tables."""

from __future__ import annotations

import duckdb
import pytest
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else str(round(r[i], 6)) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, duck, name):
    mine, theirs = registry.QUERIES[name](spark, SF), duck.sql(registry.SQL[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    kinds = dict(zip(theirs.columns, map(str, theirs.types), strict=True))
    assert {k: KINDS[v] for k, v in mine.dtypes} == kinds
    assert rows_of(mine.columns, mine.collect()) == rows_of(theirs.columns, theirs.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    """No SQL can express these: every row of their table comes out once (see test_operators for what is in them)."""
    rows = registry.QUERIES[name](spark, SF)
    if "page_id" in rows.columns:
        assert sorted(r["page_id"] for r in rows.collect()) == sorted(r["page_id"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect())
    else:
        assert rows.select(*rows.columns[:2]).distinct().count() == rows.count()


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
