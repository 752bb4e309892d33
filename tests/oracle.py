"""Compare each registered Spark query with its DuckDB SQL on the same tables.

Usage: ``python -m tests.oracle [sf_dir] [query ...]``.  Prints one line per
query and exits non-zero on any mismatch.  Also used by ``tests/test_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    """A value as a sortable key: NULL, NaN and numbers apart, floats to twelve
    significant digits (sums may be added in another order)."""
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.12g}")
    if isinstance(v, dict):
        return (5, tuple((k, _norm(x)) for k, x in sorted(v.items())))
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if isinstance(v, dt.datetime):
        return (3, v.isoformat())
    if isinstance(v, dt.date):
        return (3, dt.datetime.combine(v, dt.time()).isoformat())
    return (4, str(v))


def rows_of(table) -> list[tuple]:
    """Rows of an Arrow table, columns by name."""
    cols = sorted(table.column_names)
    return sorted(tuple(_norm(r[c]) for c in cols) for r in table.select(cols).to_pylist())


def compare(spark, sf_dir: str, names=None, con=None) -> dict[str, dict]:
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    results = {}
    for name in names or qs:
        t = time.time()
        sdf = qs[name](spark, sf_dir).toArrow()
        secs = time.time() - t
        res = {"rows": sdf.num_rows, "sec": round(secs, 2)}
        if name in sqls:
            odf = con.execute(sqls[name]).to_arrow_table()
            res["oracle_rows"] = odf.num_rows
            res["cols_match"] = sorted(sdf.column_names) == sorted(odf.column_names)
            res["values_match"] = res["cols_match"] and rows_of(sdf) == rows_of(odf)
            if not res["cols_match"]:
                res["cols"] = (sorted(sdf.column_names), sorted(odf.column_names))
        results[name] = res
    return results


def main(argv: list[str]) -> int:
    from strata.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf_dir, argv[1:] or None)
    bad = 0
    for name, r in res.items():
        ok = r.get("values_match", True) and r["rows"] == r.get("oracle_rows", r["rows"])
        bad += not ok
        print(("OK  " if ok else "BAD ") + name, r)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
