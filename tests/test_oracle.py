"""Every registered query with an oracle equals DuckDB on sf0.001 (rows, columns, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from riskframe.sources.tables import TABLES, table_path
from scripts.check_oracle import rows_of

from conftest import SF_SMALL

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = table_path(SF_SMALL, t)
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# Spark simple type -> DuckDB type name
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    stypes = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert rows_of(df.columns, srows) == rows_of(rel.columns, rel.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["column", "value", "bad_rate", "n_loans"]
