"""SN0-SN3: slowly changing history (type 2, "check" strategy).

``scd2_check(history, incoming, ...)`` is a pure function from the
current history and the incoming full extract to the new history:

* key new, or back after a hard delete  -> insert a version
* check columns differ (NULL-safe)      -> close the open version at
                                           ``run_ts`` and insert a new one
* key missing from the extract          -> close the open version
                                           (``close_missing``)
* otherwise                             -> keep

One full outer join of the *open* versions with the extract on the key;
each joined row emits 0-2 output rows through ``inline`` of a small
array (a narrow operator), so the join runs once.  Closed history rows
pass through untouched.  The join is keyed, so a key never holds more
than one open row and one incoming row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_ts
from ..functions.keys import TIMESTAMP_TEXT

SCD_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def scd_id(key_col, ts_col):
    return F.md5(F.concat_ws("|", F.coalesce(key_col.cast("string"), F.lit("")),
                             F.coalesce(F.date_format(ts_col, TIMESTAMP_TEXT), F.lit(""))))


def _first_versions(incoming: DataFrame, key: str, run_ts: dt.datetime) -> DataFrame:
    ts = lit_ts(run_ts)
    return incoming.select(*incoming.columns,
                           scd_id(F.col(key), ts).alias("dbt_scd_id"),
                           ts.alias("dbt_updated_at"), ts.alias("dbt_valid_from"),
                           F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))


def scd2_check(history: DataFrame | None, incoming: DataFrame, key: str,
               check_cols: tuple, run_ts: dt.datetime,
               close_missing: bool = True) -> DataFrame:
    """SN0: new full history after one snapshot run.

    ``history`` may also be just the open versions: the result is then the
    versions this run closes plus the new open set, which lets a store keep
    closed history append-only (``plans.warehouse.snapshot_run``).
    """
    payload = list(incoming.columns)
    if history is None:
        return _first_versions(incoming, key, run_ts)
    ts = lit_ts(run_ts)
    closed = history.filter(F.col("dbt_valid_to").isNotNull()).select(*payload, *SCD_COLUMNS)
    o = history.filter(F.col("dbt_valid_to").isNull()).select(
        *[F.col(c).alias("o_" + c) for c in payload + list(SCD_COLUMNS)])
    n = incoming.select(*[F.col(c).alias("n_" + c) for c in payload])
    j = o.join(n, F.col("o_" + key) == F.col("n_" + key), "full_outer")

    has_old = F.col("o_" + key).isNotNull()
    has_new = F.col("n_" + key).isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col("o_" + c).eqNullSafe(F.col("n_" + c))
    changed = has_old & has_new & ~same
    gone = has_old & ~has_new
    close_old = changed | gone if close_missing else changed

    fields = payload + list(SCD_COLUMNS)
    old_version = F.struct(
        *[F.col("o_" + c).alias(c) for c in payload],
        F.col("o_dbt_scd_id").alias("dbt_scd_id"),
        F.col("o_dbt_updated_at").alias("dbt_updated_at"),
        F.col("o_dbt_valid_from").alias("dbt_valid_from"),
        F.when(close_old, ts).otherwise(F.col("o_dbt_valid_to")).alias("dbt_valid_to"))
    new_version = F.struct(
        *[F.col("n_" + c).alias(c) for c in payload],
        scd_id(F.col("n_" + key), ts).alias("dbt_scd_id"),
        ts.alias("dbt_updated_at"), ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))
    emitted = F.array(F.when(has_old, old_version),
                      F.when(has_new & (~has_old | changed), new_version))
    current = (j.select(F.inline(F.filter(emitted, lambda x: x.isNotNull())))
               .select(*fields))
    return closed.unionByName(current)


# Snapshot declarations.
CUSTOMER_SNAPSHOT_COLUMNS = ("customer_id", "email", "customer_name", "first_name", "last_name",
                             "country_code", "company_name", "customer_segment",
                             "acquisition_channel", "created_at", "updated_at")
CUSTOMER_CHECK = ("email", "customer_name", "first_name", "last_name", "country_code",
                  "company_name", "customer_segment", "acquisition_channel")
SUBSCRIPTION_SNAPSHOT_COLUMNS = ("subscription_id", "customer_id", "product_id", "status",
                                 "billing_period", "plan_code", "mrr_usd", "arr_usd",
                                 "trial_start_date", "trial_end_date", "start_date", "end_date",
                                 "cancelled_at", "cancellation_reason", "created_at", "updated_at")
SUBSCRIPTION_CHECK = ("status", "billing_period", "plan_code", "mrr_usd", "arr_usd",
                      "start_date", "end_date", "cancelled_at", "cancellation_reason")


def snp_customers(history: DataFrame | None, stg_customers: DataFrame,
                  run_ts: dt.datetime) -> DataFrame:
    """SN1."""
    return scd2_check(history, stg_customers.select(*CUSTOMER_SNAPSHOT_COLUMNS),
                      "customer_id", CUSTOMER_CHECK, run_ts)


def snp_subscriptions(history: DataFrame | None, stg_subscriptions: DataFrame,
                      run_ts: dt.datetime) -> DataFrame:
    """SN2."""
    return scd2_check(history, stg_subscriptions.select(*SUBSCRIPTION_SNAPSHOT_COLUMNS),
                      "subscription_id", SUBSCRIPTION_CHECK, run_ts)
