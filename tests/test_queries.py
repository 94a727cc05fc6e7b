"""Every query against its SQL in DuckDB, over whole tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tallybrook.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, np.generic):
        return plain(v.item())
    if isinstance(v, float):
        return round(v, 6)
    return str(v)[:10] if hasattr(v, "isoformat") else v


def rows(df, columns):
    return sorted((tuple(plain(v) for v in r) for r in df[columns].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    ours = registry.QUERIES[name](spark, sf).toPandas()
    if name not in registry.SQL:
        assert len(ours)
        return
    theirs = duck.execute(registry.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert rows(ours, columns) == rows(theirs, columns)
