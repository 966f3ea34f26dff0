"""Every query of the catalogue against its SQL."""

import glob
import math
import os

import duckdb
import pytest

from loomwright.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def tidy(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows(spark, sf, duck, name):
    df, want = catalogue.QUERIES[name](spark, sf), duck.sql(catalogue.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = lambda all_, pick: sorted(repr(tuple(tidy(r[i]) for i in pick)) for r in all_)
    assert rows(df.select(*columns).collect(), range(len(columns))) == rows(want.fetchall(), at)
