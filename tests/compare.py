"""Run registered queries next to their oracles: ``python -m tests.compare SF_DIR [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, (int, str, bool, bytes)) or v is None:
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return "DECIMAL" + str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return "NESTED" + repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(cols)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, t, types[c]) for c, t in df.dtypes if kinds.get(t, t) != types[c]]
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return len(got), f"{len(got)} rows vs {len(want)}; only spark {str(extra)[:900]}; only sql {str(missing)[:900]}"
    return len(got), f"TYPES {odd}" if odd else ""


def main():
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from quern.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle=8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    qs, os_ = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            n, err = compare(spark, con, name, fn, os_.get(name), sf_dir)
        except Exception as x:  # noqa: BLE001
            n, err = -1, "".join(traceback.format_exception_only(x))[:1500]
        state = "rows-only" if err is None else "ok" if not err else "FAIL"
        bad += state == "FAIL"
        print(f"{state:9} {name:28} {n:7} {time.time() - t:6.2f}s {err or ''}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
