"""Run registered queries against their DuckDB oracle (like the driver).

usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    if t.startswith("array<"):
        return spark_type(t[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(t, t.upper())


def type_mismatches(df, cur):
    duck = {d[0]: str(d[1]).upper().replace(" ", "") for d in cur.description}
    out = []
    for name, t in df.dtypes:
        want = spark_type(t).replace(" ", "")
        if duck.get(name) != want:
            out.append(f"{name}: spark {want} vs duckdb {duck.get(name)}")
    return out


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest()[:16], keys


def main(argv):
    import duckdb

    import __spark_entry__ as E
    from wardlake.session import get_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        mism = type_mismatches(df, cur)
        if mism:
            print(f"TYPE {name}: {mism}")
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            bad += 1
            continue
        h1, k1 = digest(rows, cols)
        h2, k2 = digest(orows, ocols)
        if len(rows) != len(orows) or h1 != h2:
            diff1 = [k for k in k1 if k not in set(k2)][:3]
            diff2 = [k for k in k2 if k not in set(k1)][:3]
            print(f"FAIL {name}: rows {len(rows)} vs {len(orows)}; spark-only {diff1} oracle-only {diff2}")
            bad += 1
        else:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
