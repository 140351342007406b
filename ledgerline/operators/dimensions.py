"""DM1-DM7: dimensions.

``dim_customer`` / ``dim_subscription`` turn snapshot versions into
SCD2 dimension rows keyed per version, enriched with business-vault
metrics on the *current* version only.  ``dim_product`` / ``dim_plan``
look up the 5-row plan-tier seed (broadcast: a fixed size bound).
``dim_date`` and ``time_spine`` are exploded date sequences.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_start, quarter_start, year_start
from ..functions.keys import surrogate_key, ts_surrogate_key

MONEY_SUM = "decimal(38,2)"


def dim_customer(snapshot: DataFrame, lifetime: DataFrame) -> DataFrame:
    """DM1: one row per customer version; lifetime metrics on the current one."""
    s = snapshot.select(
        ts_surrogate_key("customer_id", "dbt_updated_at").alias("customer_sk"),
        "customer_id", "email", "customer_name", "first_name", "last_name", "country_code",
        "company_name", "customer_segment", "acquisition_channel",
        F.col("created_at").alias("customer_created_at"),
        F.col("dbt_valid_from").alias("valid_from"),
        F.col("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"))
    c = lifetime.select(
        F.col("customer_id").alias("c_customer_id"), "cohort_month", "cohort_quarter",
        "cohort_year", "tenure_days", "tenure_months", "current_mrr_usd", "current_arr_usd",
        "total_lifetime_revenue_usd", "clv_24mo_usd", "is_active_customer", "has_churned",
        "first_subscription_date")
    j = s.join(c, (s.customer_id == c.c_customer_id) & s.is_current, "left")
    return j.select(
        "customer_sk", "customer_id", "email", "customer_name", "first_name", "last_name",
        "country_code", "company_name", "customer_segment", "acquisition_channel",
        "customer_created_at",
        F.coalesce("cohort_month", month_start("customer_created_at")).alias("cohort_month"),
        F.coalesce("cohort_quarter", quarter_start("customer_created_at")).alias("cohort_quarter"),
        F.coalesce("cohort_year", year_start("customer_created_at")).alias("cohort_year"),
        F.coalesce("tenure_days", F.lit(0)).cast("bigint").alias("tenure_days"),
        F.coalesce("tenure_months", F.lit(0)).cast("bigint").alias("tenure_months"),
        F.coalesce("current_mrr_usd", F.lit(0)).cast(MONEY_SUM).alias("current_mrr_usd"),
        F.coalesce("current_arr_usd", F.lit(0)).cast(MONEY_SUM).alias("current_arr_usd"),
        F.coalesce("total_lifetime_revenue_usd", F.lit(0)).cast(MONEY_SUM).alias("total_lifetime_revenue_usd"),
        F.coalesce("clv_24mo_usd", F.lit(0)).cast("decimal(28,8)").alias("clv_24mo_usd"),
        F.coalesce("is_active_customer", F.lit(0)).cast("int").alias("is_active_customer"),
        F.coalesce("has_churned", F.lit(0)).cast("int").alias("has_churned"),
        "first_subscription_date", "valid_from", "valid_to", "is_current")


def customer_keys(snapshot: DataFrame) -> DataFrame:
    """Version keys of ``dim_customer`` straight from the snapshot.

    Fact lookups need only (customer_id, customer_sk, is_current); taking
    them from the snapshot keeps the business-vault join of
    ``dim_customer`` (which Catalyst cannot prune from a left join) out of
    every fact's plan.
    """
    return snapshot.select(
        "customer_id",
        ts_surrogate_key("customer_id", "dbt_updated_at").alias("customer_sk"),
        F.col("dbt_valid_to").isNull().alias("is_current"))


def subscription_keys(snapshot: DataFrame) -> DataFrame:
    """Version keys and billing attributes of ``dim_subscription`` from the snapshot."""
    return snapshot.select(
        "subscription_id",
        ts_surrogate_key("subscription_id", "dbt_updated_at").alias("subscription_sk"),
        "plan_code", "billing_period",
        F.col("dbt_valid_to").isNull().alias("is_current"))


def dim_subscription(snapshot: DataFrame, health: DataFrame) -> DataFrame:
    """DM2: one row per subscription version; health on the current one."""
    s = snapshot.select(
        ts_surrogate_key("subscription_id", "dbt_updated_at").alias("subscription_sk"),
        "subscription_id", "customer_id", "product_id", "status", "billing_period", "plan_code",
        "mrr_usd", "arr_usd", "trial_start_date", "trial_end_date", "start_date", "end_date",
        "cancelled_at", "cancellation_reason",
        F.col("dbt_valid_from").alias("valid_from"),
        F.col("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"))
    h = health.select(F.col("subscription_id").alias("h_subscription_id"), "age_days",
                      "age_months", "payment_health_pct", "is_churn_risk", "health_status")
    j = s.join(h, (s.subscription_id == h.h_subscription_id) & s.is_current, "left")
    return j.select(
        "subscription_sk", "subscription_id", "customer_id", "product_id", "status",
        "billing_period", "plan_code", "mrr_usd", "arr_usd", "trial_start_date",
        "trial_end_date", "start_date", "end_date", "cancelled_at", "cancellation_reason",
        F.coalesce("age_days", F.lit(0)).cast("bigint").alias("age_days"),
        F.coalesce("age_months", F.lit(0)).cast("bigint").alias("age_months"),
        F.coalesce("payment_health_pct", F.lit(100.0)).cast("double").alias("payment_health_pct"),
        F.coalesce("is_churn_risk", F.lit(False)).alias("is_churn_risk"),
        F.coalesce("health_status", F.lit("UNKNOWN")).alias("health_status"),
        "valid_from", "valid_to", "is_current")


def dim_product(stg_products: DataFrame, plan_tiers: DataFrame) -> DataFrame:
    """DM3: products with their list plan (left lookup on ``plan_code``)."""
    t = F.broadcast(plan_tiers.select(
        F.col("plan_code").alias("t_plan_code"), "plan_name", "tier_level",
        F.col("monthly_price_usd").alias("list_price_monthly_usd"),
        F.col("annual_price_usd").alias("list_price_annual_usd"),
        "max_users", "has_sla", "support_tier"))
    p = stg_products
    return (p.join(t, p.plan_code == t.t_plan_code, "left")
            .select(surrogate_key("product_id").alias("product_sk"),
                    "product_id", "product_name", "plan_code", "plan_name", "tier_level",
                    "product_category", "billing_model", "base_price_monthly_usd",
                    "base_price_annual_usd", "list_price_monthly_usd", "list_price_annual_usd",
                    "max_users", "has_sla", "support_tier", "is_active", "launched_at",
                    "deprecated_at", "created_at", "updated_at"))


def dim_plan(plan_tiers: DataFrame) -> DataFrame:
    """DM4: plans with the annual discount implied by list prices."""
    monthly = F.nullif(F.col("monthly_price_usd"), F.lit(0)).cast("double")
    factor = F.col("annual_price_usd").cast("double") / monthly / 12
    return plan_tiers.select(
        surrogate_key("plan_code").alias("plan_sk"),
        "plan_tier_id", "plan_code", "plan_name", "tier_level", "monthly_price_usd",
        "annual_price_usd", "max_users", "max_api_calls_per_month", "has_sla", "support_tier",
        "is_active",
        F.round(factor, 8).alias("annual_discount_factor"),
        F.round((1 - factor) * 100, 6).alias("annual_discount_pct"))


def _days(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    n = (end_exclusive - start).days
    return spark.range(0, max(n, 0)).select(
        F.date_add(lit_date(start), F.col("id").cast("int")).alias("date_day"))


def calendar_end(as_of: dt.date, years_ahead: int = 3) -> dt.date:
    try:
        return as_of.replace(year=as_of.year + years_ahead)
    except ValueError:          # Feb 29 -> Feb 28
        return as_of.replace(year=as_of.year + years_ahead, day=28)


def dim_date(spark: SparkSession, start: dt.date, as_of: dt.date, years_ahead: int = 3) -> DataFrame:
    """DM5: one row per day in [start, as_of + years); flags relative to ``as_of``.

    Sunday is day 0 and day/month names are three letters.
    """
    d = F.col("date_day")
    today = lit_date(as_of)
    dow = F.dayofweek(d) - 1
    return _days(spark, start, calendar_end(as_of, years_ahead)).select(
        d.alias("date_key"), d,
        dow.alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_of_week_name"),
        F.substring(F.date_format(d, "EEE"), 1, 3).alias("day_of_week_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_of_year"),
        F.date_format(d, "MMM").alias("month_name"),
        F.substring(F.date_format(d, "MMM"), 1, 3).alias("month_name_short"),
        F.quarter(d).alias("quarter_of_year"),
        F.year(d).alias("year_number"),
        (F.year(d) * 100 + F.month(d)).alias("year_month_key"),
        (F.year(d) * 10 + F.quarter(d)).alias("year_quarter_key"),
        F.trunc(d, "week").alias("first_day_of_week"),
        month_start(d).alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start(d).alias("first_day_of_quarter"),
        year_start(d).alias("first_day_of_year"),
        (d == today).alias("is_today"),
        (d <= today).alias("is_past_or_today"),
        (month_start(d) == month_start(today)).alias("is_current_month"),
        (quarter_start(d) == quarter_start(today)).alias("is_current_quarter"),
        (F.year(d) == F.year(today)).alias("is_current_year"),
        (~dow.isin(0, 6)).alias("is_weekday"))


def time_spine(spark: SparkSession, start: dt.date, as_of: dt.date, years_ahead: int = 3) -> DataFrame:
    """DM6: daily spine [start, as_of + years)."""
    return _days(spark, start, calendar_end(as_of, years_ahead))


def current(dim: DataFrame) -> DataFrame:
    """DM7: current versions only."""
    return dim.filter(F.col("is_current"))
