"""Run registered checks against DuckDB on the same parquet tables.

Usable from pytest and as ``python -m tests.oracle [sf_dir] [name ...]``.
Comparison: column names sorted, row count, then rows sorted as strings.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return str(v)


def _rows(cols, records):
    return sorted("|".join(_cell(r[c]) for c in cols) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_tab = sdf.toArrow()
    t1 = time.time()
    out = {"name": name, "spark_s": round(t1 - t0, 2), "rows": s_tab.num_rows}
    if sql is None:
        out["status"] = "rows-only"
        return out
    d_tab = con.sql(sql).to_arrow_table()
    s_cols, d_cols = sorted(s_tab.column_names), sorted(d_tab.column_names)
    if s_cols != d_cols:
        out.update(status="schema", spark_cols=s_cols, duck_cols=d_cols)
        return out
    if s_tab.num_rows != d_tab.num_rows:
        out.update(status="count", duck_rows=d_tab.num_rows)
        return out
    a, b = _rows(s_cols, s_tab.to_pylist()), _rows(s_cols, d_tab.to_pylist())
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out.update(status="values", first_diffs=diff)
        return out
    out["status"] = "ok"
    return out


def main(argv):
    sys.path.insert(0, ".")
    from tempora.session import get_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": "error", "error": str(e).splitlines()[0][:300]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
