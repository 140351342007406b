"""MR1-MR4: monthly revenue, MRR movements, NRR/GRR.

MR1 aggregates invoices to one row per (month, plan, tier, customer,
subscription).  MR2 compares each subscription's month with its previous
calendar month (a keyed window, see ``mrr_movements``).  MR4's
window partitions by plan (a handful of groups over month rows, i.e.
tiny after aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.keys import short_key

MONEY = "decimal(38,2)"
MONEY8 = "decimal(28,8)"


def monthly_invoices(fct_invoices: DataFrame) -> DataFrame:
    """MR1.

    The rows are dealt by (customer_sk, subscription_sk), which serves this grouping and
    the window of MR2: one shuffle for both.  A key has about one invoice a month, so
    there is little that a map-side aggregate would save.
    """
    paid, refunded = F.col("is_paid"), F.col("is_refunded")
    zero = F.lit(0)
    return (fct_invoices.repartition("customer_sk", "subscription_sk")
            .groupBy(month_start("invoice_date").alias("revenue_month"), "plan_code",
                     "tier_level", "customer_sk", "subscription_sk")
            .agg(F.sum(F.when(paid, F.col("mrr_contribution_usd")).otherwise(zero)).cast(MONEY8).alias("mrr_usd"),
                 F.sum(F.when(paid, F.col("arr_contribution_usd")).otherwise(zero)).cast(MONEY).alias("arr_usd"),
                 F.sum(F.when(paid, F.col("net_amount_usd")).otherwise(zero)).cast(MONEY).alias("collected_usd"),
                 F.sum(F.when(refunded, F.col("net_amount_usd")).otherwise(zero)).cast(MONEY).alias("refunded_usd"),
                 F.count(F.when(paid, 1)).alias("paid_count"),
                 F.count(F.when(F.col("is_failed"), 1)).alias("failed_count")))


def mrr_movements(monthly: DataFrame) -> DataFrame:
    """MR2: new / expansion / contraction / churned MRR vs the previous month.

    A key's (customer_sk, subscription_sk) months are compared as sums: the
    previous calendar month is a range of one month over the key's months, and
    where a month has several rows, as after an edit of a plan's tier, the
    movement of their sum is booked once, on the row of the highest MRR (ties by
    tier, then plan).  One shuffle on the key, MR1's own where it is computed here; MR1 is computed once.
    The windows go from the finest order to the coarsest, so one sort serves all.  A key
    holds few rows a month, so even the ``'UNKNOWN'`` key is a short window.
    """
    key = Window.partitionBy("customer_sk", "subscription_sk")
    of_month = Window.partitionBy("customer_sk", "subscription_sk", "_month")
    zero = F.lit(0).cast(MONEY8)
    j = monthly.withColumn("_month", F.year("revenue_month") * 12 + F.month("revenue_month"))
    j = j.withColumn("books", F.row_number().over(of_month.orderBy(F.desc("mrr_usd"), F.desc("tier_level"), F.desc("plan_code"))) == 1)
    j = j.withColumn("month_mrr", F.sum("mrr_usd").over(of_month).cast(MONEY8))
    j = j.withColumn("p_mrr", F.sum(F.when(F.col("books"), F.col("month_mrr"))).over(key.orderBy("_month").rangeBetween(-1, -1)).cast(MONEY8))
    cur, p, books = F.col("month_mrr"), F.col("p_mrr"), F.col("books")
    booked = lambda condition, amount: F.when(books & condition, amount).otherwise(zero).cast(MONEY8)
    return j.select(
        "revenue_month", "plan_code", "tier_level", "customer_sk", "subscription_sk",
        F.col("mrr_usd").alias("current_mrr"),
        booked(p.isNotNull(), p).alias("prior_mrr"),
        booked(F.lit(True), cur - F.coalesce(p, zero)).alias("mrr_change"),
        booked(p.isNull() & (cur > 0), cur).alias("new_mrr"),
        booked((p > 0) & (cur > p), cur - p).alias("expansion_mrr"),
        booked((p > 0) & (cur < p) & (cur > 0), p - cur).alias("contraction_mrr"),
        booked((p > 0) & (cur == 0), p).alias("churned_mrr"),
        "collected_usd", "refunded_usd", "paid_count", "failed_count")


def revenue_by_plan(movements: DataFrame) -> DataFrame:
    """MR3."""
    m = movements
    return (m.groupBy("revenue_month", "plan_code", "tier_level").agg(
        F.sum("current_mrr").cast(MONEY8).alias("total_mrr_usd"),
        (F.sum("current_mrr").cast(MONEY8) * F.lit(12).cast("decimal(2,0)")).cast(MONEY8).alias("total_arr_usd"),
        F.sum("new_mrr").cast(MONEY8).alias("new_mrr_usd"),
        F.sum("expansion_mrr").cast(MONEY8).alias("expansion_mrr_usd"),
        F.sum("contraction_mrr").cast(MONEY8).alias("contraction_mrr_usd"),
        F.sum("churned_mrr").cast(MONEY8).alias("churned_mrr_usd"),
        F.sum(F.col("new_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr")
              - F.col("churned_mrr")).cast(MONEY8).alias("net_new_mrr_usd"),
        F.sum("collected_usd").cast(MONEY).alias("total_collected_usd"),
        F.sum("refunded_usd").cast(MONEY).alias("total_refunded_usd"),
        F.sum("paid_count").cast("bigint").alias("total_paid_invoices"),
        F.sum("failed_count").cast("bigint").alias("total_failed_invoices"),
        F.count_distinct(short_key("customer_sk")).alias("paying_customers"),
        F.count_distinct(short_key("subscription_sk")).alias("active_subscriptions")))


def _pct(num, den):
    return F.round(num.cast("double") / den.cast("double") * 100, 4)


def mart_revenue(fct_invoices: DataFrame) -> DataFrame:
    """MR4: revenue by month and plan with NRR / GRR against the previous row."""
    return revenue_rates(revenue_by_plan(mrr_movements(monthly_invoices(fct_invoices))))


def revenue_rates(by_plan: DataFrame) -> DataFrame:
    """NRR and GRR of the plans' months.

    ``lag`` is the previous row of the plan (months without invoices are
    skipped); ``tier_level`` breaks ties in the ordering.
    """
    w = Window.partitionBy("plan_code").orderBy("revenue_month", "tier_level")
    out = by_plan.withColumn("_prev", F.lag("total_mrr_usd").over(w))
    prev = F.col("_prev")
    exp, con, chu = F.col("expansion_mrr_usd"), F.col("contraction_mrr_usd"), F.col("churned_mrr_usd")
    return (out.withColumn("nrr_pct", F.when(prev > 0, _pct(prev + exp - con - chu, prev)))
               .withColumn("grr_pct", F.when(prev > 0, _pct(prev - con - chu, prev)))
               .drop("_prev"))
