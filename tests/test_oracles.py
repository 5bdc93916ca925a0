"""Every query with SQL gives DuckDB's result over the smallest tables; every other one runs."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
CORE = entry.core
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def _rows(df):
    df = df[sorted(df.columns)]
    plain = lambda v: "null" if pd.isna(v) else f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(plain(v) for v in r) for r in df.astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(CORE.SQL))
def test_matches_duckdb(spark, duck, name):
    got, want = CORE.QUERIES[name](spark, FOLDER).toPandas(), duck.execute(CORE.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted({*CORE.QUERIES} - {*CORE.SQL}))
def test_runs(spark, name):
    assert CORE.QUERIES[name](spark, FOLDER).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_core_does_not_import_the_subpackage():
    import pathlib

    root = pathlib.Path(CORE.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "quern.llm" not in p.read_text(encoding="utf-8"), p
