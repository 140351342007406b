"""OB1-OB5: one row per current customer per month, with revenue, usage
and subscriptions of that month.

The customer x month grid is an explode of each customer's own month
range (cohort month .. as_of), not a cross join with the calendar.  The
three monthly aggregates are keyed by (report_month, customer_sk), one
row per key, so the left joins are one-to-one; the grid is the only side
that grows with customers x months.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_diff, month_start
from ..session import materialize
from .dimensions import current

MONEY = "decimal(38,2)"
MONEY8 = "decimal(28,8)"


def _one_month():
    return F.expr("interval 1 month")


def first_month_start_on_or_after(d: dt.date) -> dt.date:
    return d if d.day == 1 else (d.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


# Customer attributes of the grid and the wide table.
ATTRIBUTES = ("customer_id", "customer_name", "email", "company_name", "customer_segment", "acquisition_channel",
              "country_code", "cohort_month", "cohort_quarter", "cohort_year", "first_subscription_date",
              "is_active_customer", "has_churned")


def month_grid(dim_customer: DataFrame, calendar_start: dt.date, as_of: dt.date) -> DataFrame:
    """``(report_month, customer_sk)``: month starts from the cohort month up to
    ``as_of``, per current customer."""
    return customer_starts(dim_customer, calendar_start, as_of).select(grid_months(as_of).alias("report_month"), "customer_sk")


def grid_months(as_of: dt.date):
    """The months of a customer's row of ``customer_starts``, one row each."""
    return F.explode(F.sequence(F.col("_first"), lit_date(as_of.replace(day=1)), _one_month()))


def customer_starts(dim_customer: DataFrame, calendar_start: dt.date, as_of: dt.date) -> DataFrame:
    """``(customer_sk, _first)``: the first month of the grid, of current customers that have one."""
    lo = lit_date(first_month_start_on_or_after(calendar_start))
    hi = lit_date(as_of.replace(day=1))
    c = current(dim_customer)
    first = F.greatest(F.col("cohort_month"), lo)
    # a cohort month that is not itself a 1st starts at the next 1st
    first = F.when(first == month_start(first), first).otherwise(F.add_months(month_start(first), 1))
    # NULL cohort month: no rows (``greatest`` would skip the NULL)
    return (c.filter(F.col("cohort_month").isNotNull())
            .select("customer_sk", first.alias("_first"))
            .filter(F.col("_first") <= hi))


def months_of_customers(monthly: DataFrame, name: str) -> DataFrame:
    """A table of one row a customer and month as one row a customer, with a map from month to the rest."""
    rest = [c for c in monthly.columns if c not in ("report_month", "customer_sk")]
    return (monthly.filter(F.col("report_month").isNotNull()).groupBy("customer_sk")
            .agg(F.map_from_entries(F.collect_list(F.struct("report_month", F.struct(*rest)))).alias(name)))


def customer_months(dim_customer: DataFrame, calendar_start: dt.date, as_of: dt.date) -> DataFrame:
    """OB1: the grid with the customers' attributes."""
    grid = month_grid(dim_customer, calendar_start, as_of)
    return grid.join(current(dim_customer).select("customer_sk", *ATTRIBUTES), "customer_sk").select(
        "report_month", "customer_id", "customer_sk", *ATTRIBUTES[1:])


def customer_revenue(fct_invoices: DataFrame) -> DataFrame:
    """OB2."""
    paid, zero = F.col("is_paid"), F.lit(0)
    return (fct_invoices.groupBy(month_start("invoice_date").alias("report_month"), "customer_sk")
            .agg(F.sum(F.when(paid, F.col("mrr_contribution_usd")).otherwise(zero)).cast(MONEY8).alias("mrr_usd"),
                 F.sum(F.when(paid, F.col("arr_contribution_usd")).otherwise(zero)).cast(MONEY).alias("arr_usd"),
                 F.sum(F.when(paid, F.col("net_amount_usd")).otherwise(zero)).cast(MONEY).alias("collected_usd"),
                 F.count(F.when(paid, 1)).alias("paid_invoices"),
                 F.count(F.when(F.col("is_failed"), 1)).alias("failed_invoices")))


def customer_usage(fct_events: DataFrame) -> DataFrame:
    """OB3: a month's active days are the bits of a number, so that features are the
    only distinct count and raw events are not expanded."""
    day = F.call_function("shiftleft", F.lit(1), F.dayofmonth("event_date_key") - 1)
    return (fct_events.groupBy(month_start("event_date_key").alias("report_month"), "customer_sk")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.coalesce(F.bit_count(F.bit_or(day)), F.lit(0)).cast("bigint").alias("active_days"),
                 F.count_distinct("feature_name").alias("features_used"),
                 F.sum("engagement_score").cast("bigint").alias("total_engagement_score"),
                 F.count(F.when(F.col("is_conversion_event"), 1)).alias("conversion_events"),
                 F.count(F.when(F.col("is_churn_signal"), 1)).alias("churn_signal_events")))


def started_subscriptions(fct_subscriptions: DataFrame, plan_tiers: DataFrame | None = None) -> DataFrame:
    """OB4: subscriptions *started* in the month.

    The highest plan is the alphabetical maximum of ``plan_code``, as in the
    reference.  With ``plan_tiers`` (the 5-row seed, broadcast) it is the plan
    of the highest tier instead; plans without a tier rank lowest.
    """
    f = fct_subscriptions
    highest = F.max("plan_code")
    if plan_tiers is not None:
        tiers = F.broadcast(plan_tiers.select(F.col("plan_code").alias("_tier_plan"), "tier_level"))
        f = f.join(tiers, f.plan_code == tiers._tier_plan, "left")
        highest = F.max_by("plan_code", F.struct(F.coalesce("tier_level", F.lit(-1)), F.col("plan_code")))
    return (f.groupBy(month_start("start_date").alias("report_month"), "customer_sk")
            .agg(F.count_distinct("subscription_id").alias("subscription_count"),
                 highest.alias("highest_plan_code"),
                 F.sum("mrr_usd").cast(MONEY).alias("subscription_mrr_usd"),
                 F.max(F.col("is_churned").cast("int")).alias("churned_this_month")))


def obt_saas_metrics(dim_customer: DataFrame, fct_invoices: DataFrame, fct_events: DataFrame,
                     fct_subscriptions: DataFrame, calendar_start: dt.date,
                     as_of: dt.date) -> DataFrame:
    """OB5: the monthly aggregates, as maps from month to values (a customer has a bounded
    number of months), meet the customers on the customer alone; the grid is exploded last.

    Each fact is dealt by customer before it is grouped, and the grid, by far the largest
    side, is never shuffled.  The customers and the maps of invoices and events, one row a
    customer, are written one after the other, so the shuffles behind one fact are gone
    before those of the next; these narrow tables meet the subscriptions in the end.  Facts
    without a customer match no grid row and are left out first."""
    dim_customer = materialize(dim_customer.select("customer_sk", "is_current", *ATTRIBUTES), "obt-customers")
    by_customer = lambda fct: fct.filter(F.col("customer_sk") != "UNKNOWN").repartition("customer_sk")
    parts = {"_revenue": customer_revenue(by_customer(fct_invoices)), "_usage": customer_usage(by_customer(fct_events)),
             "_started": started_subscriptions(by_customer(fct_subscriptions))}
    j = customer_starts(dim_customer, calendar_start, as_of)
    for name, monthly in parts.items():
        months = months_of_customers(monthly, name)
        j = j.join(months if name == "_started" else materialize(months, f"obt{name}"), "customer_sk", "left")
    j = j.join(current(dim_customer).select("customer_sk", *ATTRIBUTES), "customer_sk")
    j = j.select("*", grid_months(as_of).alias("report_month"))
    j = j.select("report_month", *ATTRIBUTES, *[F.col(name)[F.col("report_month")][c].alias(c) for name, monthly in parts.items()
                                                for c in monthly.columns if c not in ("report_month", "customer_sk")])
    z = F.lit(0)
    active_days = F.coalesce("active_days", z)
    features = F.coalesce("features_used", z)
    signals = F.coalesce("churn_signal_events", z)
    score = (active_days * 3 + features * 5
             + F.when(F.col("mrr_usd") > 0, 20).otherwise(0) - signals * 10)
    return j.select(
        "report_month", *ATTRIBUTES,
        F.coalesce("mrr_usd", z).cast(MONEY8).alias("mrr_usd"),
        F.coalesce("arr_usd", z).cast(MONEY).alias("arr_usd"),
        F.coalesce("collected_usd", z).cast(MONEY).alias("collected_usd"),
        F.coalesce("paid_invoices", z).cast("bigint").alias("paid_invoices"),
        F.coalesce("failed_invoices", z).cast("bigint").alias("failed_invoices"),
        F.coalesce("total_events", z).cast("bigint").alias("total_events"),
        active_days.cast("bigint").alias("active_days"),
        features.cast("bigint").alias("features_used"),
        F.coalesce("total_engagement_score", z).cast("bigint").alias("total_engagement_score"),
        F.coalesce("conversion_events", z).cast("bigint").alias("conversion_events"),
        signals.cast("bigint").alias("churn_signal_events"),
        F.coalesce("subscription_count", z).cast("bigint").alias("subscription_count"),
        F.coalesce("highest_plan_code", F.lit("FREE")).alias("plan_code"),
        F.coalesce("subscription_mrr_usd", z).cast(MONEY).alias("subscription_mrr_usd"),
        F.coalesce("churned_this_month", z).cast("int").alias("churned_this_month"),
        month_diff("cohort_month", "report_month").alias("cohort_age_months"),
        F.least(F.lit(100), F.greatest(F.lit(0), score)).cast("bigint").alias("health_score"))
