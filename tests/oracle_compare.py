"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare.

Mirrors the driver's check: row count, column names, and an order-insensitive
hash of the values (columns sorted by name). Usage:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if v is None:
        return "null"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def type_mismatches(df, rel) -> list[tuple[str, str, str]]:
    """Columns whose Spark type and DuckDB type differ."""
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if SPARK_TO_DUCK.get(t, t) != duck.get(f.name):
            out.append((f.name, t, duck.get(f.name)))
    return out


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duckdb_con(sf_dir)
    out = {}
    for name in names or list(qs):
        if name not in sqls:
            continue
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        ok_cols = sorted(scols) == sorted(dcols) and not type_mismatches(df, con.sql(sqls[name]))
        ok_n = len(srows) == len(drows)
        ok_hash = ok_cols and digest(scols, srows) == digest(dcols, drows)
        out[name] = dict(cols=ok_cols, rows=ok_n, hash=ok_hash, n=len(srows), sec=round(t1 - t0, 2))
        if verbose:
            flag = "OK " if (ok_cols and ok_n and ok_hash) else "BAD"
            print(f"{flag} {name:32s} rows={len(srows):7d}/{len(drows):7d} cols={ok_cols} "
                  f"hash={ok_hash} {t1 - t0:6.2f}s", flush=True)
            if not (ok_cols and ok_n and ok_hash):
                print("   spark cols", scols, "\n   duck  cols", dcols)
                ss = sorted(map(str, srows))[:3]
                dd = sorted(map(str, drows))[:3]
                print("   spark", ss, "\n   duck ", dd)
    return out


if __name__ == "__main__":
    from foldwise.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not (v["cols"] and v["rows"] and v["hash"])]
    print(f"{len(res) - len(bad)}/{len(res)} match; bad: {bad}")
