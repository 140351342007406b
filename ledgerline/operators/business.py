"""BV1-BV8: business-vault tables (customer lifetime, subscription health).

Both tables pre-aggregate invoices per subscription before any join
(one row per subscription), then aggregate subscriptions per customer
before joining customers, so no join ever sees more than one row per
key on its build side and the per-customer group-by runs partial
aggregation map-side even when one customer owns a third of all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (day_diff, lit_date, lit_ts, month_diff,
                               month_start, quarter_start, year_start)
from ..functions.keys import hash_key
from .vault import current_rows

MONEY_SUM = "decimal(38,2)"


def dec_div(num, den, scale: int = 8) -> Column:
    """Exact decimal quotient rounded half-up to ``scale`` digits.

    Spark's default decimal division keeps only 6 digits once precision
    runs out; bounding the operand precision keeps 13+ digits before the
    final rounding.
    """
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return (num.cast("decimal(20,2)") / den.cast("decimal(10,0)")).cast(f"decimal(28,{scale})")


def current_customers(hub: DataFrame, sat: DataFrame) -> DataFrame:
    """BV1: hub joined to the open satellite row."""
    s = current_rows(sat)
    return (hub.join(s, "hash_key", "inner")
            .select(F.col("hash_key").alias("customer_hash_key"),
                    F.col("customer_bk").alias("customer_id"),
                    "email", "customer_name", "company_name", "customer_segment",
                    "acquisition_channel", "country_code",
                    F.col("created_at").alias("customer_created_at")))


def current_subscriptions(hub: DataFrame, sat: DataFrame, link: DataFrame) -> DataFrame:
    """BV2: hub, open satellite row and customer link (inner joins)."""
    s = current_rows(sat)
    lnk = link.select(F.col("hub_subscription_hash_key").alias("hash_key"),
                      F.col("hub_customer_hash_key").alias("customer_hash_key"))
    return (hub.join(s, "hash_key", "inner").join(lnk, "hash_key", "inner")
            .select(F.col("hash_key").alias("subscription_hash_key"),
                    "status", "mrr_usd", "arr_usd", "start_date", "end_date",
                    "cancelled_at", "customer_hash_key"))


def paid_invoice_totals(stg_invoices: DataFrame) -> DataFrame:
    """BV3: paid-invoice totals per subscription."""
    return (stg_invoices.filter(F.col("invoice_status") == "PAID")
            .groupBy("subscription_id")
            .agg(F.sum("net_amount_usd").alias("total_revenue_usd"),
                 F.count_distinct("invoice_id").alias("invoice_count"),
                 F.min("invoice_date").alias("first_invoice_date"),
                 F.max("invoice_date").alias("last_invoice_date")))


def bv_customer_lifetime(hub_customer: DataFrame, sat_customer: DataFrame,
                         hub_subscription: DataFrame, sat_subscription: DataFrame,
                         lnk_customer_subscription: DataFrame, stg_invoices: DataFrame,
                         as_of: dt.date, load_ts: dt.datetime) -> DataFrame:
    """BV5: lifetime, cohort and value metrics per current customer."""
    customers = current_customers(hub_customer, sat_customer)
    subs = current_subscriptions(hub_subscription, sat_subscription, lnk_customer_subscription)
    # BV4: join key computed on the (small, pre-aggregated) invoice side.
    revenue = (paid_invoice_totals(stg_invoices)
               .select(hash_key("subscription_id").alias("subscription_hash_key"),
                       "total_revenue_usd"))
    per_sub = subs.join(revenue, "subscription_hash_key", "left")
    active = (F.col("status") == "active").cast("int")
    per_customer = (per_sub.groupBy("customer_hash_key").agg(
        F.count_distinct("subscription_hash_key").alias("subscription_count"),
        F.sum(active).alias("active_subscription_count"),
        F.sum(F.coalesce("mrr_usd", F.lit(0))).alias("current_mrr_usd"),
        F.sum(F.coalesce("arr_usd", F.lit(0))).alias("current_arr_usd"),
        F.sum(F.coalesce("total_revenue_usd", F.lit(0))).alias("total_lifetime_revenue_usd"),
        F.max(active).alias("is_active_customer"),
        F.max((F.col("status") == "cancelled").cast("int")).alias("has_churned"),
        F.min("start_date").alias("first_subscription_date"),
        F.max(F.coalesce(F.col("cancelled_at").cast("date"), F.col("end_date"))).alias("last_subscription_end_date"),
    ))
    asof = lit_date(as_of)
    tenure_months = month_diff("customer_created_at", asof)
    revenue_total = F.coalesce(F.col("total_lifetime_revenue_usd"), F.lit(0)).cast(MONEY_SUM)
    return (customers.join(per_customer, "customer_hash_key", "left")
            .select(
                "customer_hash_key", "customer_id", "email", "customer_name", "company_name",
                "customer_segment", "acquisition_channel", "country_code", "customer_created_at",
                month_start("customer_created_at").alias("cohort_month"),
                quarter_start("customer_created_at").alias("cohort_quarter"),
                year_start("customer_created_at").alias("cohort_year"),
                day_diff("customer_created_at", asof).alias("tenure_days"),
                tenure_months.alias("tenure_months"),
                F.coalesce("subscription_count", F.lit(0)).cast("bigint").alias("subscription_count"),
                F.coalesce("active_subscription_count", F.lit(0)).cast("bigint").alias("active_subscription_count"),
                F.coalesce("current_mrr_usd", F.lit(0)).cast(MONEY_SUM).alias("current_mrr_usd"),
                F.coalesce("current_arr_usd", F.lit(0)).cast(MONEY_SUM).alias("current_arr_usd"),
                revenue_total.alias("total_lifetime_revenue_usd"),
                F.when(tenure_months > 0, dec_div(revenue_total, tenure_months) * F.lit(24).cast("decimal(2,0)"))
                 .otherwise(F.lit(0)).cast("decimal(28,8)").alias("clv_24mo_usd"),
                F.coalesce("is_active_customer", F.lit(0)).cast("int").alias("is_active_customer"),
                F.coalesce("has_churned", F.lit(0)).cast("int").alias("has_churned"),
                "first_subscription_date", "last_subscription_end_date",
                lit_ts(load_ts).alias("load_date")))


def invoice_metrics(stg_invoices: DataFrame) -> DataFrame:
    """BV7: invoice outcome counts and paid totals per subscription."""
    paid = F.col("invoice_status") == "PAID"
    return (stg_invoices.groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.count(F.when(paid, 1)).alias("paid_invoices"),
        F.count(F.when(F.col("invoice_status") == "FAILED", 1)).alias("failed_invoices"),
        F.sum(F.when(paid, F.col("net_amount_usd")).otherwise(F.lit(0))).alias("total_paid_usd"),
        F.max(F.when(paid, F.col("invoice_date"))).alias("last_paid_date")))


# Subscription status -> health status.
HEALTH_STATUS = [("active", "HEALTHY"), ("trialing", "TRIAL"), ("past_due", "AT_RISK"),
                 ("paused", "PAUSED"), ("cancelled", "CHURNED")]


def health_status(status: Column) -> Column:
    expr = None
    for s, h in HEALTH_STATUS:
        expr = (F.when(status == s, h) if expr is None else expr.when(status == s, h))
    return expr.otherwise("UNKNOWN")


def bv_subscription_health(hub_subscription: DataFrame, sat_subscription: DataFrame,
                           lnk_customer_subscription: DataFrame,
                           lnk_subscription_product: DataFrame, stg_invoices: DataFrame,
                           as_of: dt.date, load_ts: dt.datetime) -> DataFrame:
    """BV6-BV8: subscription age, payment health and churn risk."""
    s = current_rows(sat_subscription)
    lcs = lnk_customer_subscription.select(
        F.col("hub_subscription_hash_key").alias("hash_key"),
        F.col("hub_customer_hash_key").alias("customer_hash_key"))
    lsp = lnk_subscription_product.select(
        F.col("hub_subscription_hash_key").alias("hash_key"),
        F.col("hub_product_hash_key").alias("product_hash_key"))
    subs = (hub_subscription.join(s, "hash_key", "inner")
            .join(lcs, "hash_key", "left").join(lsp, "hash_key", "left")
            .select(F.col("hash_key").alias("subscription_hash_key"),
                    F.col("subscription_bk").alias("subscription_id"),
                    "customer_hash_key", "product_hash_key", "status", "billing_period",
                    "plan_code", "mrr_usd", "arr_usd", "start_date", "end_date",
                    "cancelled_at", "cancellation_reason"))
    # joined by a hash computed on the invoice side, which is narrow: the subscriptions stay where they are
    im = invoice_metrics(stg_invoices).withColumn("subscription_hash_key", hash_key("subscription_id")).drop("subscription_id")
    asof = lit_date(as_of)
    total = F.coalesce("total_invoices", F.lit(0))
    failed = F.coalesce("failed_invoices", F.lit(0))
    return (subs.join(im, "subscription_hash_key", "left")
            .select(
                "subscription_hash_key", "subscription_id", "customer_hash_key", "product_hash_key",
                "status", "billing_period", "plan_code", "mrr_usd", "arr_usd", "start_date",
                "end_date", "cancelled_at", "cancellation_reason",
                day_diff("start_date", asof).alias("age_days"),
                month_diff("start_date", asof).alias("age_months"),
                total.cast("bigint").alias("total_invoices"),
                F.coalesce("paid_invoices", F.lit(0)).cast("bigint").alias("paid_invoices"),
                failed.cast("bigint").alias("failed_invoices"),
                F.coalesce("total_paid_usd", F.lit(0)).cast(MONEY_SUM).alias("total_paid_usd"),
                "last_paid_date",
                (F.col("status").isin("cancelled", "past_due") | (failed > 0)).alias("is_churn_risk"),
                F.when(total == 0, F.lit(None).cast("double"))
                 .otherwise(F.round(F.col("paid_invoices").cast("double") / total.cast("double") * 100, 2))
                 .alias("payment_health_pct"),
                health_status(F.col("status")).alias("health_status"),
                lit_ts(load_ts).alias("load_date")))
