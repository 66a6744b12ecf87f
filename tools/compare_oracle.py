"""Run every registered query on Spark and its oracle SQL on DuckDB; compare the results.

    python tools/compare_oracle.py [sf_dir] [name ...]

Prints one line per query: row counts, column names/types and an order-insensitive value
comparison (exact, and with floats rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import REGISTRY  # noqa: E402
from eventide.session import get_session  # noqa: E402
from eventide.sources.tables import TABLES, table_path  # noqa: E402


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
            "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
            "smallint": "SMALLINT", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}


def _canon(v, approx: bool):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if approx:
            return f"{v:.9g}"
        return repr(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x, approx) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x, approx)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def _rows(records, cols, approx):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_canon(r[i], approx) for i in idx) for r in records)


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    import logging
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL + 1)
    logging.getLogger("pyspark").setLevel(logging.CRITICAL + 1)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    bad = 0
    for name in names:
        q = REGISTRY[name]
        t0 = time.time()
        try:
            df = q.fn(spark, sf_dir)
            s_cols = df.columns
            s_types = [f.dataType.simpleString() for f in df.schema.fields]
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not q.sql:
            print(f"rows  {name}: spark rows={len(s_rows)} ({dt:.1f}s) no oracle")
            continue
        try:
            res = con.execute(q.sql)
            o_cols = [c[0] for c in res.description]
            o_types = [str(c[1]) for c in res.description]
            o_rows = res.fetchall()
        except Exception as e:
            print(f"FAIL  {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        msgs = []
        if sorted(s_cols) != sorted(o_cols):
            msgs.append(f"cols spark={s_cols} duck={o_cols}")
        s_t = {c: TYPE_MAP.get(t, t) for c, t in zip(s_cols, s_types)}
        o_t = dict(zip(o_cols, o_types))
        bad_types = {c: (s_t[c], o_t.get(c)) for c in s_t if o_t.get(c) != s_t[c]}
        if bad_types:
            msgs.append(f"types {bad_types}")
        if len(s_rows) != len(o_rows):
            msgs.append(f"rows spark={len(s_rows)} duck={len(o_rows)}")
        exact = _rows(s_rows, s_cols, False) == _rows(o_rows, o_cols, False)
        approx = exact or _rows(s_rows, s_cols, True) == _rows(o_rows, o_cols, True)
        status = "OK   " if (exact and not msgs) else ("APPROX" if approx and not msgs else "DIFF ")
        if status != "OK   ":
            bad += 1
        types = ",".join(f"{c}:{t}" for c, t in zip(s_cols, s_types))
        dtypes = ",".join(f"{c}:{t}" for c, t in zip(o_cols, o_types))
        print(f"{status} {name}: rows={len(s_rows)} ({dt:.1f}s) {' '.join(msgs)}")
        print(f"       spark[{types}]\n       duck [{dtypes}]")
        if status == "DIFF " and not msgs:
            a = _rows(s_rows, s_cols, True)
            b = _rows(o_rows, o_cols, True)
            diff_a = [x for x in a if x not in set(b)][:3]
            diff_b = [x for x in b if x not in set(a)][:3]
            print(f"       spark-only {diff_a}\n       duck-only  {diff_b}")
    print(f"done: {bad} not exact")


if __name__ == "__main__":
    main(sys.argv[1:])
