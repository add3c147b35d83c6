"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/compare.py [name ...] [--sf 0.01]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canon(r[i]) for i in order) for r in rows]), sorted(columns)


def main(argv):
    import duckdb

    import __spark_entry__ as entry
    from evidence_spark.session import build_session

    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", shuffle=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    queries, oracle = entry.queries(), entry.oracle_sql()
    only_sql = "--sql" in argv
    argv = [a for a in argv if a != "--sql"]
    names = [n for n in queries if (not argv or any(a in n for a in argv)) and (n in oracle or not only_sql)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            got = [tuple(r) for r in df.collect()]
            spent = time.time() - start
            if name not in oracle:
                print(f"{'OK' if got else 'EMPTY'}   {name:42s} rows={len(got)} {spent:.1f}s (rows only)", flush=True)
                continue
            mid = time.time()
            res = con.execute(oracle[name])
            cols = [d[0] for d in res.description]
            want = res.fetchall()
            a, ca = rows_of(df.columns, got)
            b, cb = rows_of(cols, want)
            ok = a == b and ca == cb
            bad += not ok
            print(f"{'OK' if ok and got else 'EMPTY' if ok else 'DIFF'}   {name:42s} rows={len(a)}/{len(b)} {spent:.1f}s sql {time.time() - mid:.1f}s", flush=True)
            if not ok:
                print("   columns", ca, cb)
                sa, sb = set(a), set(b)
                for r in sorted(sa - sb)[:3]:
                    print("   spark", [x[:200] for x in r])
                for r in sorted(sb - sa)[:3]:
                    print("   duck ", [x[:200] for x in r])
        except Exception as exc:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name}: {type(exc).__name__} {str(exc)[:900]}", flush=True)
    print("problems:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
