"""Each query of the catalog against its SQL on the smallest tables."""

import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from hostsift.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def as_rows(df: pd.DataFrame):
    columns = sorted(df.columns)

    def clean(v):
        v = v.item() if isinstance(v, np.generic) else v  # columns with nulls give numpy scalars, which print as such
        return None if pd.isna(v) else int(v) if isinstance(v, float) and v.is_integer() else v

    return columns, sorted(str(tuple(clean(v) for v in r)) for r in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.SQL:
        assert as_rows(got) == as_rows(duck.sql(catalog.SQL[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
