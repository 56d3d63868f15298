"""Run registered queries beside their DuckDB twins: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    return str(v) if v is not None else None


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> tuple[bool, str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = df.collect()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    a, b = _bag(df.columns, got), _bag(names, expected)
    if a != b:
        extra, lacking = list((a - b).items())[:2], list((b - a).items())[:2]
        return False, f"rows {len(got)} / {len(expected)}; only Spark {extra}; only DuckDB {lacking}"
    return True, f"{len(got)} rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from strata.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    registered = queries()
    for name in sys.argv[2:] or registered:
        start = time.time()
        try:
            df = registered[name](spark, sf_dir)
            if name in sqls:
                ok, note = compare(df, con, sqls[name])
            else:
                ok, note = True, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:400]} ... {str(error)[-1500:]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
