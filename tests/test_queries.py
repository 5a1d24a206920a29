"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from formloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return "null"
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return repr(float(v))


def told(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(cell(v) for v in row) for row in df[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in registry.SQL:
        assert told(got) == told(duck.execute(registry.SQL[name]).df())


def test_entry_imports(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["doc_id", "row_ord", "key", "domain", "variable", "support", "rationale"]
