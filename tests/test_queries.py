"""Every query of the library against its SQL on the small tables."""

import duckdb
import pandas as pd
import pytest

from voxmill.plans import catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rows_of(df):
    def plain(v):
        if v is None or (not isinstance(v, str) and pd.isna(v)):
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    columns = sorted(df.columns)
    return columns, sorted(tuple(plain(v) for v in row) for row in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, name):
    got = catalog.QUERIES[name](spark, small).toPandas()
    if name not in catalog.ORACLE_SQL:
        assert len(got)
        return
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    want = con.sql(catalog.ORACLE_SQL[name]).df()
    (a, x), (b, y) = rows_of(got.astype({c: "float64" for c in got.columns if c in want.columns and str(want[c].dtype).startswith("Int")})), rows_of(want.astype({c: "float64" for c in want.columns if str(want[c].dtype).startswith("Int")}))
    assert a == b
    assert x == y


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
