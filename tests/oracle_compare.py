"""Compare ``queries()`` with ``oracle_sql()`` the way the driver does:
row count, column names, and an order-insensitive hash of the values.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def spark_type_name(dt) -> str:
    return dt.simpleString().upper().replace("STRING", "VARCHAR").replace("TIMESTAMP_NTZ", "TIMESTAMP") \
        .replace("INT", "INTEGER").replace("BIGINTEGER", "BIGINT").replace("SMALLINTEGER", "SMALLINT")


def type_diffs(df, cur):
    st = {f.name: spark_type_name(f.dataType) for f in df.schema.fields}
    dt_ = {d[0]: str(d[1]).upper() for d in cur.description}
    return {c: (st[c], dt_.get(c)) for c in st if c in dt_ and st[c] != dt_[c]}


def duck_con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, ors = e.queries(), e.oracle_sql()
    con = duck_con(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as ex:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(ex)[:400])
            print(f"{name:32s} SPARK-ERROR {str(ex)[:400]}")
            continue
        if name not in ors:
            results[name] = ("ROWS-ONLY", len(srows))
            print(f"{name:32s} rows-only {len(srows)}")
            continue
        try:
            cur = con.execute(ors[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(ex)[:400])
            print(f"{name:32s} DUCK-ERROR {str(ex)[:600]}")
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        tdiff = type_diffs(df, cur)
        if tdiff:
            print(f"   types differ: {tdiff}")
        hs, ls = digest(srows, scols)
        hd, ld = digest(drows, dcols)
        ok = ok_cols and len(srows) == len(drows) and hs == hd
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:32s} {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
              f"cols={'ok' if ok_cols else 'DIFF'} {time.time() - t0:.1f}s")
        if not ok and verbose:
            if not ok_cols:
                print("   spark-only cols:", sorted(set(scols) - set(dcols)),
                      "duck-only cols:", sorted(set(dcols) - set(scols)))
            else:
                a, b = set(ls), set(ld)
                print("   cols:", sorted(scols))
                for x in sorted(a - b)[:3]:
                    print("   spark:", x[:600])
                for x in sorted(b - a)[:3]:
                    print("   duck :", x[:600])
    return results


if __name__ == "__main__":
    from ledgerline.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8, 8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if r[0] not in ("OK", "ROWS-ONLY")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
