"""FC1-FC3: fact tables.

Each fact looks up the *current* version key of its dimensions by
natural id (``dim_customer`` / ``dim_subscription`` or the narrower
``customer_keys`` / ``subscription_keys``: any frame with the id, the
key and ``is_current``).  Lookups are left equi-joins: the 23-row event-type seed is
broadcast (fixed bound); customer/subscription/product dimensions are
left to Spark's size-checked join selection (broadcast under
``spark.sql.autoBroadcastJoinThreshold`` / AQE runtime size, sort-merge
otherwise; AQE splits a skewed fact key).  The ``'UNKNOWN'`` placeholder
is only produced after the join, so it never becomes a join key, and a
NULL natural id is replaced by a per-row non-matching key (``lookup_key``)
so NULL-key rows do not pile up in one reducer.

With ``target`` given, only source rows loaded after the target's
high-water mark are processed (IO8); the caller merges them (IO6).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key, ts_surrogate_key
from ..sources.merging import newer_than
from .business import dec_div
from .dimensions import current

UNKNOWN = "UNKNOWN"

# Engagement score per event type (else 1) and flag lists.
ENGAGEMENT_SCORES = [
    (("FEATURE_USED", "API_CALL", "EXPORT"), 3),
    (("PAGE_VIEW", "LOGIN"), 1),
    (("PLAN_UPGRADED", "TRIAL_CONVERTED"), 5),
    (("INVITE_SENT", "INVITE_ACCEPTED"), 4),
]
DEFAULT_ENGAGEMENT = 1
CONVERSION_EVENTS = ("PLAN_UPGRADED", "TRIAL_CONVERTED", "SUBSCRIPTION_CREATED")
CHURN_SIGNAL_EVENTS = ("SUBSCRIPTION_CANCELLED", "CHURN_RISK_FLAGGED")


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def engagement_score(event_type: Column) -> Column:
    """FC1a."""
    expr = None
    for types, score in ENGAGEMENT_SCORES:
        cond = event_type.isin(*types)
        expr = F.when(cond, score) if expr is None else expr.when(cond, score)
    return expr.otherwise(DEFAULT_ENGAGEMENT).cast("int")


def is_conversion(event_type: Column) -> Column:
    """FC1b."""
    return F.coalesce(event_type.isin(*CONVERSION_EVENTS), F.lit(False))


def is_churn_signal(event_type: Column) -> Column:
    """FC1b."""
    return F.coalesce(event_type.isin(*CHURN_SIGNAL_EVENTS), F.lit(False))


def lookup_key(key: str, row_id) -> Column:
    """Join key for a left lookup whose fact-side key may be NULL.

    NULL never matches an equi-join, but in a sort-merge join every NULL-key
    row hashes to the same reducer: with a quarter of all events lacking a
    subscription that is one hot partition.  A per-row unique value that
    cannot match any id (it starts with a NUL character) spreads those rows
    and still matches nothing, so the result is unchanged.
    """
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.coalesce(F.col(key), F.concat(F.lit("\x00null:"), rid.cast("string")))


def _customer_keys(dim_customer: DataFrame) -> DataFrame:
    return current(dim_customer).select(F.col("customer_id").alias("c_customer_id"), "customer_sk")


def fct_events(stg_events: DataFrame, event_types: DataFrame, dim_customer: DataFrame,
               dim_subscription: DataFrame, mark: DataFrame | dt.datetime | None = None) -> DataFrame:
    """FC1: one row per event."""
    e = newer_than(stg_events, mark)
    et = F.broadcast(event_types.select(
        F.col("event_type_code"), F.col("event_category").alias("seed_category"),
        F.col("event_name")))
    c = _customer_keys(dim_customer)
    s = current(dim_subscription).select(
        F.col("subscription_id").alias("s_subscription_id"), "subscription_sk")
    j = (e.join(et, e.event_type == et.event_type_code, "left")
         .join(c, lookup_key("customer_id", "event_id") == c.c_customer_id, "left")
         .join(s, lookup_key("subscription_id", "event_id") == s.s_subscription_id, "left"))
    etype = F.col("event_type")
    return j.select(
        surrogate_key("event_id").alias("event_sk"),
        "event_id",
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        F.coalesce("subscription_sk", F.lit(UNKNOWN)).alias("subscription_sk"),
        "customer_id", "subscription_id", "event_type",
        F.coalesce("seed_category", "event_category").alias("event_category"),
        F.coalesce("event_name", "event_type").alias("event_name"),
        "feature_name", "session_id", "device_type", "platform", "occurred_at",
        F.col("event_date").alias("event_date_key"),
        engagement_score(etype).alias("engagement_score"),
        is_conversion(etype).alias("is_conversion_event"),
        is_churn_signal(etype).alias("is_churn_signal"),
        "_loaded_at")


def fct_invoices(stg_invoices: DataFrame, dim_customer: DataFrame, dim_subscription: DataFrame,
                 dim_plan: DataFrame, mark: DataFrame | dt.datetime | None = None,
                 step: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """FC2: one row per invoice with MRR/ARR contribution.

    ``step`` (``TableStore.steps``) writes the rows before and between the lookups, so that a
    stored load holds the shuffle of one of them at a time."""
    i = step(newer_than(stg_invoices, mark))
    # NULL keys are spread by columns that every revenue table reads: the wide invoice id is
    # shuffled only where it is asked for
    spread = F.xxhash64("invoice_date", "net_amount_usd")
    c = _customer_keys(dim_customer)
    s = current(dim_subscription).select(
        F.col("subscription_id").alias("s_subscription_id"), "subscription_sk",
        F.col("plan_code").alias("s_plan_code"), F.col("billing_period").alias("s_billing_period"))
    pl = F.broadcast(dim_plan.select(F.col("plan_code").alias("pl_plan_code"), "plan_sk", "tier_level"))
    # subscriptions first: their invoices then lie side by side, and mostly go to one customer,
    # so the second shuffle finds what they share close together and packs it
    i = step(i.join(s, lookup_key("subscription_id", spread) == s.s_subscription_id, "left").drop("s_subscription_id"))
    j = (i.join(c, lookup_key("customer_id", spread) == c.c_customer_id, "left")
         .join(pl, F.col("s_plan_code") == F.col("pl_plan_code"), "left"))
    annual = F.coalesce(F.col("s_billing_period"), F.lit("monthly")) == "annual"
    net = F.col("net_amount_usd")
    status = F.col("invoice_status")
    return j.select(
        surrogate_key("invoice_id").alias("invoice_sk"),
        "invoice_id",
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        F.coalesce("subscription_sk", F.lit(UNKNOWN)).alias("subscription_sk"),
        F.coalesce("plan_sk", F.lit(UNKNOWN)).alias("plan_sk"),
        "customer_id", "subscription_id",
        F.coalesce("s_plan_code", F.lit(UNKNOWN)).alias("plan_code"),
        F.coalesce("tier_level", F.lit(0)).cast("int").alias("tier_level"),
        "invoice_status", "payment_method", "currency_code", "amount_usd", "tax_usd",
        "discount_usd", "net_amount_usd",
        F.when(annual, dec_div(net, F.lit(12), 8)).otherwise(net).cast("decimal(28,8)").alias("mrr_contribution_usd"),
        F.when(annual, net).otherwise(net * 12).cast("decimal(38,2)").alias("arr_contribution_usd"),
        flag(status == "PAID").alias("is_paid"),
        flag(status == "FAILED").alias("is_failed"),
        flag(status == "REFUNDED").alias("is_refunded"),
        F.col("invoice_date").alias("invoice_date_key"),
        F.col("due_date").alias("due_date_key"),
        F.col("paid_at").cast("date").alias("paid_date_key"),
        "invoice_date", "due_date", "paid_at", "created_at", "_loaded_at")


def fct_subscriptions(stg_subscriptions: DataFrame, dim_customer: DataFrame,
                      dim_product: DataFrame, dim_plan: DataFrame,
                      mark: DataFrame | dt.datetime | None = None) -> DataFrame:
    """FC3: one row per subscription state (subscription_id, updated_at)."""
    s = newer_than(stg_subscriptions, mark)
    c = _customer_keys(dim_customer)
    p = dim_product.select(F.col("product_id").alias("p_product_id"), "product_sk")
    pl = F.broadcast(dim_plan.select(F.col("plan_code").alias("pl_plan_code"), "plan_sk"))
    row_id = F.concat_ws("|", F.col("subscription_id"), F.col("updated_at").cast("string"))
    j = (s.join(c, lookup_key("customer_id", row_id) == c.c_customer_id, "left")
         .join(p, lookup_key("product_id", row_id) == p.p_product_id, "left")
         .join(pl, s.plan_code == pl.pl_plan_code, "left"))
    status = F.col("status")
    return j.select(
        ts_surrogate_key("subscription_id", "updated_at").alias("subscription_event_sk"),
        "subscription_id",
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        F.coalesce("product_sk", F.lit(UNKNOWN)).alias("product_sk"),
        F.coalesce("plan_sk", F.lit(UNKNOWN)).alias("plan_sk"),
        "customer_id", "product_id", "plan_code", "status", "billing_period", "mrr_usd",
        "arr_usd", "trial_start_date", "trial_end_date", "start_date", "end_date",
        "cancelled_at", "cancellation_reason",
        flag(status == "trialing").alias("is_trial"),
        flag(status == "active").alias("is_active"),
        flag(status == "cancelled").alias("is_churned"),
        flag(status == "past_due").alias("is_past_due"),
        F.col("trial_start_date").isNotNull().alias("is_trial_eligible"),
        F.col("start_date").alias("start_date_key"),
        F.col("end_date").alias("end_date_key"),
        F.col("cancelled_at").cast("date").alias("cancelled_date_key"),
        "created_at", "updated_at", "_loaded_at")
