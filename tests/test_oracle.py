"""Every registered query vs its DuckDB oracle on sf0.001 (the driver's check
runs the same comparison on sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from wardlake.plans import registry as R  # noqa: E402
from oracle_check import TABLES, digest, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["facility_name", "readmission_rate"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(R.oracle_sql()) == set(R.queries())
    assert set(R.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow", "FlatMapGroups", "BroadcastNestedLoopJoin", "CartesianProduct"]


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_matches_oracle(spark, con, name):
    df = R.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], f"{name}: Python UDF or nested-loop join in plan"
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(R.oracle_sql()[name])
    assert type_mismatches(df, cur) == []
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]
