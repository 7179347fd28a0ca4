"""Compare registered queries with their SQL counterparts run by DuckDB on the same files.

``python -m tests.oracle [sf] [key-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

from lakeloom.queries import ORACLE, QUERIES
from lakeloom.queries.base import TABLES

DATA = "/root/testdata/sf{}"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


# With STRICT set, floating-point values must agree in all digits.
STRICT = bool(os.environ.get("STRICT"))


def value(x):
    if x is None:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return x + 0.0 if STRICT else float(f"{x:.9g}") + 0.0
    if isinstance(x, int):
        return x
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    return x


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(value(r[i]) for i in order) for r in rows), key=repr
    )


# Spark type name -> DuckDB type names that hold the same values.
KINDS = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "float": {"FLOAT"},
    "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def check(spark, con, key, folder, inspect=None):
    """(ok, message) for one query; ``inspect`` sees its frame first."""
    df = QUERIES[key](spark, folder)
    if inspect is not None:
        inspect(df)
    rows = [tuple(r) for r in df.collect()]
    cols, got = normal(df.columns, rows)
    if key not in ORACLE:
        return True, f"{len(got)} rows, no SQL"
    res = con.execute(ORACLE[key])
    wcols = [d[0] for d in res.description]
    wtypes = {d[0]: str(d[1]) for d in res.description}
    cols2, want = normal(wcols, res.fetchall())
    if cols != cols2:
        return False, f"columns {cols} != {cols2}"
    kinds = [
        f"{n}:{t}/{wtypes[n]}" for n, t in df.dtypes if wtypes[n] not in KINDS.get(t, {wtypes[n]})
    ]
    if kinds:
        return False, f"types {kinds}"
    if got != want:
        a, b = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} rows vs {len(want)}; only spark {a}; only sql {b}"
    return True, f"{len(got)} rows"


def main(args):
    from tests.conftest import session

    sf = args[0] if args else "0.01"
    keys = [k for k in QUERIES if not args[1:] or any(k.startswith(p) for p in args[1:])]
    spark, folder = session(), DATA.format(sf)
    con, bad = connect(folder), 0
    for key in keys:
        begin = time.time()
        try:
            ok, message = check(spark, con, key, folder)
        except Exception as error:  # report and go on with the next query
            ok, message = False, "".join(traceback.format_exception_only(error))[:900]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key:34s} {time.time() - begin:6.2f}s {message}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(keys) - bad}/{len(keys)} fine, {sum(k in ORACLE for k in keys)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
