"""Batches of the raw tables for incremental and history runs.

Each function returns the raw extract a source system would deliver at a
given run, derived from the full raw table by filters and column
rewrites (no new data is made up): a customer extract that loses and
regains keys and changes a segment, a subscription extract in which some
active subscriptions get cancelled, and event / invoice extracts split by
load time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_ts

# Run times and cut-offs of the batch fixtures.
CUSTOMER_RUNS = (dt.datetime(2001, 6, 1), dt.datetime(2001, 7, 1), dt.datetime(2001, 8, 1))
SUBSCRIPTION_RUNS = (dt.datetime(2001, 6, 1), dt.datetime(2001, 8, 1))
SUBSCRIPTION_CUTOFF = dt.datetime(1999, 1, 1)
SUBSCRIPTION_CHANGE_TS = dt.datetime(2001, 7, 15)
EVENT_CUTOFF = dt.datetime(2001, 1, 16)
INVOICE_CUTOFF = dt.datetime(1999, 1, 1)


def customers_batch(raw: DataFrame, n: int) -> DataFrame:
    """1: keys not divisible by 13; 2: all but keys divisible by 11, segment
    of keys divisible by 7 changed; 3: all keys, same segment change."""
    k = F.col("customer_id").cast("bigint")
    upgraded = F.when(k % 7 == 0, F.lit("UPGRADED")).otherwise(F.col("customer_segment"))
    if n == 1:
        return raw.filter(k % 13 != 0)
    if n == 2:
        return raw.filter(k % 11 != 0).withColumn("customer_segment", upgraded)
    if n == 3:
        return raw.withColumn("customer_segment", upgraded)
    raise ValueError(n)


def subscriptions_batch(raw: DataFrame, n: int) -> DataFrame:
    """1: rows loaded before 1999; 2: all rows, active ones with key divisible
    by 20 cancelled on 2001-07-15 (the raw row is replaced)."""
    if n == 1:
        return raw.filter(F.col("_loaded_at") < lit_ts(SUBSCRIPTION_CUTOFF))
    if n == 2:
        hit = (F.col("subscription_id").cast("bigint") % 20 == 0) & (F.col("status") == "Active")
        ts = lit_ts(SUBSCRIPTION_CHANGE_TS)
        return (raw.withColumn("_hit", hit)
                .withColumn("status", F.when(F.col("_hit"), F.lit("Cancelled")).otherwise(F.col("status")))
                .withColumn("cancelled_at", F.when(F.col("_hit"), ts).otherwise(F.col("cancelled_at")))
                .withColumn("updated_at", F.when(F.col("_hit"), ts).otherwise(F.col("updated_at")))
                .withColumn("_loaded_at", F.when(F.col("_hit"), ts).otherwise(F.col("_loaded_at")))
                .drop("_hit"))
    raise ValueError(n)


def split_by_load_time(raw: DataFrame, cutoff: dt.datetime, n: int, stale: str) -> DataFrame:
    """1: rows loaded before ``cutoff``; 2 and later: all rows, those loaded
    before it with another ``stale`` column -- changes without a new load time,
    which a load behind the high-water mark must not see."""
    old = F.col("_loaded_at") < lit_ts(cutoff)
    if n == 1:
        return raw.filter(old)
    return raw.withColumn(stale, F.when(old, F.lit("STALE")).otherwise(F.col(stale)))


def events_batch(raw: DataFrame, n: int) -> DataFrame:
    return split_by_load_time(raw, EVENT_CUTOFF, n, "platform")


def invoices_batch(raw: DataFrame, n: int) -> DataFrame:
    return split_by_load_time(raw, INVOICE_CUTOFF, n, "payment_method")


def subscriptions_split(raw: DataFrame, n: int) -> DataFrame:
    """``subscriptions_batch`` for a split load: in batch 2 old rows that were not
    cancelled carry another reason, without a new load time."""
    batch = subscriptions_batch(raw, n)
    if n == 1:
        return batch
    old = F.col("_loaded_at") < lit_ts(SUBSCRIPTION_CUTOFF)
    return batch.withColumn("cancellation_reason", F.when(old, F.lit("STALE")).otherwise(F.col("cancellation_reason")))


def customers_corrected(raw: DataFrame) -> DataFrame:
    """All customers, every fifth key with a corrected segment: a load repeated
    under the time of batch 2."""
    k = F.col("customer_id").cast("bigint")
    return customers_batch(raw, 2).unionByName(raw.filter(k % 11 == 0)).withColumn(
        "customer_segment", F.when(k % 5 == 0, F.lit("CORRECTED")).otherwise(F.col("customer_segment")))


def partition_batches(fct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of the subscription fact for a stored merge: the first has NULL
    months for every seventh key; the second moves every fifth key by a month (and
    every 35th out of NULL), sets every sixth to NULL, has a new column, a wider
    number and a flag that has turned to text."""
    k = F.col("subscription_id").cast("bigint")
    month = F.trunc("start_date_key", "month")
    first = fct.withColumn("partition_month", F.when(k % 7 != 0, month))
    second = (fct.filter((k % 5 == 0) | (k % 6 == 0))
              .withColumn("partition_month", F.when(k % 6 != 0, F.add_months(month, 1)))
              .withColumn("sales_channel", F.concat(F.lit("channel "), (k % 3).cast("string")))
              .withColumn("mrr_usd", F.col("mrr_usd").cast("decimal(22,4)"))
              .withColumn("is_churned", F.when(F.col("is_churned"), "true").otherwise("false")))
    return first, second


def odd_properties(raw: DataFrame) -> DataFrame:
    """Events of which every seventh has cut-off JSON, every eleventh a number as
    text, every thirteenth a list, and every seventeenth none."""
    e, p = F.col("event_id"), F.col("properties")
    k = F.get_json_object("properties", "$.k")
    return raw.withColumn("properties", F.when(e % 17 == 0, F.lit(None).cast("string"))
                          .when(e % 13 == 0, F.concat(F.lit("[1, "), k, F.lit("]")))
                          .when(e % 11 == 0, F.concat(F.lit('{"k": "'), k, F.lit('"}')))
                          .when(e % 7 == 0, F.expr("substring(properties, 1, length(properties) - 1)")).otherwise(p))


def dirty(raw: dict[str, DataFrame], table: str, load_ts: dt.datetime) -> dict[str, DataFrame]:
    """The raw tables with faults in one of them that a data check must find:
    repeated customers, an unknown subscription status, paid invoices below
    zero, products last loaded 18 hours before ``load_ts``."""
    df = raw[table]
    if table == "customers":
        df = df.unionByName(df.filter(F.col("customer_id") % 100 == 1))
    elif table == "subscriptions":
        df = df.withColumn("status", F.when(F.col("subscription_id") % 50 == 0, F.lit("Expired")).otherwise(F.col("status")))
    elif table == "invoices":
        df = df.withColumn("net_amount_usd", F.when((F.col("subscription_id") % 30 == 0) & (F.col("invoice_status") == "paid"), -F.col("net_amount_usd"))
                           .otherwise(F.col("net_amount_usd")).cast(df.schema["net_amount_usd"].dataType))
    elif table == "products":
        df = df.withColumn("_loaded_at", lit_ts(load_ts - dt.timedelta(hours=18)))
    else:
        raise ValueError(table)
    return {**raw, table: df}
