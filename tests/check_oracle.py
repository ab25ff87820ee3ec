"""Run registered queries next to their SQL: ``python tests/check_oracle.py [folder] [name ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows), [columns[i] for i in order]


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    got, got_columns = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = con.execute(sql)
    want_columns = [d[0] for d in rel.description]
    want, want_columns = canonical(rel.fetchall(), want_columns)
    return got, got_columns, want, want_columns


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from edilake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            got, gc, want, wc = compare(spark, con, sf_dir, queries()[name], oracles[name])
            ok = got == want and gc == wc
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {str(e)[:1500]}")
            bad += 1
            continue
        print(f"{'ok  ' if ok else 'DIFF'} {name} rows={len(got)}/{len(want)} {time.time() - start:.1f}s", flush=True)
        if not ok:
            bad += 1
            print("   columns", gc, wc)
            print("   only spark", [r for r in got if r not in set(want)][:3])
            print("   only sql  ", [r for r in want if r not in set(got)][:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
