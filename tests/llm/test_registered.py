"""Registered corpus queries against their DuckDB SQL, and the entry's guard."""

import duckdb
import pytest
from oracle_check import TABLES, digest, type_mismatches

from wardlake.llm import catalog

SF = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    names = list(catalog.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = catalog.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(catalog.oracle_sql()[name])
    assert type_mismatches(df, cur) == []
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(rows, df.columns)[1] == digest(cur.fetchall(), cols)[1]


@pytest.mark.parametrize("name", ["op1_surrogates", "op2_line_dedup", "op6_risk_rules", "op13_exact_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
