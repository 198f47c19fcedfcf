"""Every query against its SQL twin in an independent engine, on whole tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from reportlens.plans.surveillance import WITHOUT_TWIN

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    for name in frame.columns:
        frame[name] = frame[name].map(lambda v: repr(pd.Timestamp(v)) if hasattr(v, "year") else v)
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def test_every_query_has_a_twin():
    """Optional queries that SQL can't express have tests of their own instead."""
    assert set(contract.QUERIES) - set(contract.ORACLE) == WITHOUT_TWIN
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLE[name]).df()
    assert len(set(result.columns)) == len(result.columns)
    assert sorted(result.columns) == sorted(expected.columns)
    actual = result.toPandas()
    assert len(actual) == len(expected) > 0
    pd.testing.assert_frame_equal(canonical(actual), canonical(expected), check_dtype=False)
    integers = {n for n, kind in result.dtypes if kind in ("int", "bigint")}
    assert {n for n in expected if expected[n].dtype.kind == "i"} <= integers
