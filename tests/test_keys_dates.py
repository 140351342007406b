import datetime as dt

from ledgerline.functions.dates import day_diff, month_diff
from ledgerline.functions.keys import hash_key, surrogate_key, ts_surrogate_key


def test_hash_key_null_semantics(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    r = df.select(hash_key("x").alias("h1"), hash_key("x", "y").alias("h2")).collect()
    assert r[0].h1 is not None and len(r[0].h1) == 64 and r[0].h1 == r[0].h1.upper()
    assert r[1].h1 is None                       # one NULL key -> NULL
    assert r[1].h2 is not None                   # several keys never NULL
    expect = spark.sql("select upper(sha2('a||^^', 256)) as h").first().h
    assert r[0].h2 == expect


def test_surrogate_key_placeholders(spark):
    df = spark.createDataFrame([(None,)], "x string")
    r = df.select(surrogate_key("x").alias("k")).first().k
    assert r == spark.sql("select md5('_dbt_utils_surrogate_key_null_') as k").first().k


def test_ts_surrogate_key_text(spark):
    df = spark.createDataFrame([("7", dt.datetime(2001, 8, 1))], "id string, ts timestamp_ntz")
    r = df.select(ts_surrogate_key("id", "ts").alias("k")).first().k
    assert r == spark.sql("select md5('7-2001-08-01 00:00:00.000') as k").first().k


def test_month_and_day_diff(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 31), dt.date(2001, 2, 1)),
                                (dt.date(2000, 12, 15), dt.date(2001, 1, 14))], "a date, b date")
    r = df.select(month_diff("a", "b").alias("m"), day_diff("a", "b").alias("d")).collect()
    assert [(x.m, x.d) for x in r] == [(1, 1), (1, 30)]
