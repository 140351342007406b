"""CR1-CR3: cohort retention (share of a cohort paying N months later).

Paid invoices are pre-aggregated per (customer_sk, month) before the
join to the current customer rows (one row per ``customer_sk``), and the
retention matrix is one group per (cohort, month offset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_diff, month_start
from .dimensions import current


def cohort_sizes(dim_customer: DataFrame) -> DataFrame:
    """CR1: current customers with a first subscription, per cohort month."""
    return (current(dim_customer).filter(F.col("first_subscription_date").isNotNull())
            .groupBy("cohort_month")
            .agg(F.count_distinct("customer_id").alias("cohort_size")))


def paid_activity(fct_invoices: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """CR2: paid MRR per current customer and month."""
    paid = (fct_invoices.filter(F.col("is_paid"))
            .groupBy("customer_sk", month_start("invoice_date").alias("active_month"))
            .agg(F.sum("mrr_contribution_usd").alias("mrr_usd")))
    dc = current(dim_customer).select("customer_sk", "customer_id", "cohort_month")
    return paid.join(dc, "customer_sk", "inner")


def cohort_retention(fct_invoices: DataFrame, dim_customer: DataFrame,
                     max_months: int = 24) -> DataFrame:
    """CR3: retention matrix for months 0..max_months since acquisition."""
    act = paid_activity(fct_invoices, dim_customer)
    offset = month_diff("cohort_month", "active_month")
    rd = (act.groupBy("cohort_month", offset.alias("months_since_acquisition"))
          .agg(F.count_distinct("customer_id").alias("retained_customers"),
               F.sum("mrr_usd").cast("decimal(28,8)").alias("cohort_mrr_usd"))
          .filter(F.col("months_since_acquisition").between(0, max_months)))
    cs = cohort_sizes(dim_customer)
    j = rd.join(cs, "cohort_month", "inner")
    size = F.col("cohort_size").cast("double")
    return j.select(
        "cohort_month", "cohort_size", "months_since_acquisition", "retained_customers",
        F.round(F.col("retained_customers").cast("double") / size * 100, 2).alias("retention_rate_pct"),
        "cohort_mrr_usd",
        F.round(F.col("cohort_mrr_usd").cast("double") / size, 2).alias("mrr_per_cohort_customer"))
