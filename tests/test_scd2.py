import datetime as dt

from ledgerline.operators.scd2 import scd2_check

T1, T2, T3, T4 = (dt.datetime(2001, m, 1) for m in (1, 2, 3, 4))
SCHEMA = "k string, a string, b string"


def run(spark, batches):
    hist = None
    for ts, rows in batches:
        hist = scd2_check(hist, spark.createDataFrame(rows, SCHEMA), "k", ("a",), ts)
    return sorted(((r.k, r.a, r.dbt_valid_from, r.dbt_valid_to) for r in hist.collect()), key=repr)


def test_insert_change_delete_reappear(spark):
    got = run(spark, [
        (T1, [("1", "x", "p"), ("2", "y", "p"), ("3", None, "p")]),
        (T2, [("1", "x", "q"), ("2", "z", "p"), ("3", None, "p")]),   # 1: non-check change, 2: change
        (T3, [("1", "x", "q"), ("3", None, "p")]),                    # 2 deleted
        (T4, [("1", "x", "q"), ("2", "z", "p"), ("3", "w", "p")]),    # 2 back, 3: NULL -> value
    ])
    assert got == sorted([
        ("1", "x", T1, None),
        ("2", "y", T1, T2), ("2", "z", T2, T3), ("2", "z", T4, None),
        ("3", None, T1, T4), ("3", "w", T4, None),
    ], key=repr)


def test_rerun_is_idempotent(spark):
    rows = [("1", "x", "p"), ("2", None, "p")]
    once = run(spark, [(T1, rows)])
    twice = run(spark, [(T1, rows), (T2, rows)])
    assert once == twice
