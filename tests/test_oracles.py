"""Every query with a SQL form gives DuckDB's rows; the others run and keep their schema."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from scholarlens.plans import oracles, registry


def rows(frame):
    def value(v):
        if pd.isna(v):
            return None
        if isinstance(v, float) and not math.isinf(v):
            return round(v, 5)
        return int(v) if hasattr(v, "__index__") else str(v)

    frame = frame[sorted(frame.columns)]
    out = [tuple(value(v) for v in r) for r in frame.itertuples(index=False)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), 0 if x is None else x) for x in r))


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_oracle(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(oracles.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in oracles.ORACLES])
def test_runs(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
