"""Every query of the library against its SQL in DuckDB."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from recordspark.queries import ORACLE_SQL, QUERIES


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6) + 0.0
    rows = [tuple("null" if pd.isna(x) else (float(x) if isinstance(x, (int, float, np.number)) and not isinstance(x, bool) else str(x)) for x in r) for r in df.itertuples(index=False)]
    return list(df.columns), sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = duck.sql(ORACLE_SQL[name]).df()
    assert normal(got) == normal(want)
