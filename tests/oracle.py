"""Runs registered queries on Spark and their check SQL on DuckDB and compares all values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from momentlake.adapters import TABLES

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(name, df, con, sql, verbose=True):
    """Returns (ok, rows, message)."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    want_types = [str(d[1]) for d in rel.description]
    want = _rows(want_cols, rel.fetchall())
    if sorted(df.columns) != sorted(want_cols):
        return False, len(got), f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    kinds = {c: t for c, t in zip(want_cols, want_types)}
    for c, t in df.dtypes:
        if TYPES.get(t) != kinds[c]:
            return False, len(got), f"column {c}: {t} against {kinds[c]}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 20000 else ""
        lost = [r for r in want if r not in set(got)][:3] if len(want) < 20000 else ""
        return False, len(got), f"rows {len(got)} != {len(want)}\n  only spark {extra}\n  only check {lost}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, len(got), f"{len(bad)} rows differ, e.g.\n  {str(bad[0][0])[:600]}\n  {str(bad[0][1])[:600]}"
    return True, len(got), ""


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from momentlake.runtime import build_session

    spark = build_session("local[8]")
    con = duck(sf_dir)
    queries, checks = e.queries(), e.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in checks:
                ok, n, msg = compare(name, df, con, checks[name])
            else:
                n, ok, msg = df.count(), True, "no check SQL"
        except Exception as exc:  # report and go on
            ok, n, msg = False, -1, f"{type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:45s} rows={n:<8d} {time.time() - t0:6.1f}s {msg}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(main(sys.argv[1], sys.argv[2:]))
