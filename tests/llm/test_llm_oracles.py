import glob
import os

import duckdb
import pandas as pd
import pytest

from scholarlens.llm import registry


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_oracle(spark, sf_dir, name):
    """Every row of the query over the whole tables is DuckDB's."""
    duck = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want, got = duck.execute(registry.ORACLES[name]).df(), registry.QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert shown(got, columns) == shown(want, columns)


def shown(frame, columns):
    """Rows as text; pandas makes floats of integers beside nulls."""
    whole = lambda v: "-" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    return sorted(tuple(map(whole, r)) for r in frame[columns].astype(object).values.tolist())
