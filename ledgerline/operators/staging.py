"""ST1-ST5: staging views -- rename, cast, clean, filter.

Each is a narrow projection of its raw table (no shuffle); Catalyst
fuses it into the downstream stage and pushes its filter into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def stg_customers(raw: DataFrame) -> DataFrame:
    """ST1.  Keeps ``is_deleted = false`` only (NULL is dropped as well)."""
    return (raw
            .filter(F.col("is_deleted").cast("boolean") == F.lit(False))
            .select(
                F.col("customer_id").cast("string").alias("customer_id"),
                F.trim(F.lower("email")).alias("email"),
                F.trim(F.concat("first_name", F.lit(" "), "last_name")).alias("customer_name"),
                F.col("first_name").cast("string").alias("first_name"),
                F.col("last_name").cast("string").alias("last_name"),
                F.substring(F.upper("country_code"), 1, 2).alias("country_code"),
                F.coalesce("company_name", F.lit("Unknown")).cast("string").alias("company_name"),
                F.lower("customer_segment").alias("customer_segment"),
                F.lower("acquisition_channel").alias("acquisition_channel"),
                F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
                F.col("is_deleted").cast("boolean").alias("is_deleted"),
                F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
            ))


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    """ST2.  ``plan_code`` keeps its case."""
    return raw.select(
        F.col("subscription_id").cast("string").alias("subscription_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.lower("status").alias("status"),
        F.lower("billing_period").alias("billing_period"),
        F.col("plan_code").cast("string").alias("plan_code"),
        F.col("mrr_usd").cast(MONEY).alias("mrr_usd"),
        F.col("arr_usd").cast(MONEY).alias("arr_usd"),
        F.col("trial_start_date").cast("date").alias("trial_start_date"),
        F.col("trial_end_date").cast("date").alias("trial_end_date"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        F.col("cancelled_at").cast("timestamp_ntz").alias("cancelled_at"),
        F.col("cancellation_reason").cast("string").alias("cancellation_reason"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """ST3.  ``event_properties`` stays the text as it came; ``event_variants`` reads it."""
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("subscription_id").cast("string").alias("subscription_id"),
        F.upper("event_type").alias("event_type"),
        F.upper("event_category").alias("event_category"),
        F.col("feature_name").cast("string").alias("feature_name"),
        F.col("session_id").cast("string").alias("session_id"),
        F.col("device_type").cast("string").alias("device_type"),
        F.col("platform").cast("string").alias("platform"),
        F.col("occurred_at").cast("timestamp_ntz").alias("occurred_at"),
        F.col("occurred_at").cast("date").alias("event_date"),
        F.col("properties").cast("string").alias("event_properties"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def event_variants(stg: DataFrame) -> DataFrame:
    """ST3: events with their properties as a VARIANT, NULL where the text is no JSON."""
    return stg.withColumn("event_properties", F.try_parse_json("event_properties"))


def property_values(stg: DataFrame, paths: dict[str, tuple[str, str]], keys: tuple = ("event_id",)) -> DataFrame:
    """Typed values of event properties: ``paths`` maps a column to (path, type).

    The text is parsed once a row into a VARIANT; a value that is missing or doesn't
    cast to its type is NULL.  ``is_json`` tells malformed text, ``json_type`` the
    variant's own type.
    """
    v = F.col("event_properties")
    return event_variants(stg.select(*keys, "event_properties")).select(
        *keys, v.isNotNull().alias("is_json"), F.schema_of_variant(v).alias("json_type"),
        *[F.try_variant_get(v, path, kind).alias(name) for name, (path, kind) in paths.items()])


def stg_invoices(raw: DataFrame) -> DataFrame:
    """ST4."""
    return raw.select(
        F.col("invoice_id").cast("string").alias("invoice_id"),
        F.col("subscription_id").cast("string").alias("subscription_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.upper("invoice_status").alias("invoice_status"),
        F.upper("payment_method").alias("payment_method"),
        F.substring(F.upper("currency_code"), 1, 3).alias("currency_code"),
        F.col("amount_usd").cast(MONEY).alias("amount_usd"),
        F.col("tax_usd").cast(MONEY).alias("tax_usd"),
        F.col("discount_usd").cast(MONEY).alias("discount_usd"),
        F.col("net_amount_usd").cast(MONEY).alias("net_amount_usd"),
        F.col("invoice_date").cast("date").alias("invoice_date"),
        F.col("due_date").cast("date").alias("due_date"),
        F.col("paid_at").cast("timestamp_ntz").alias("paid_at"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """ST5.  ``plan_code`` folded to upper case."""
    return raw.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("product_name").cast("string").alias("product_name"),
        F.upper("plan_code").alias("plan_code"),
        F.lower("product_category").alias("product_category"),
        F.lower("billing_model").alias("billing_model"),
        F.col("base_price_monthly_usd").cast(MONEY).alias("base_price_monthly_usd"),
        F.col("base_price_annual_usd").cast(MONEY).alias("base_price_annual_usd"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("launched_at").cast("date").alias("launched_at"),
        F.col("deprecated_at").cast("date").alias("deprecated_at"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


STAGERS = {
    "customers": stg_customers,
    "subscriptions": stg_subscriptions,
    "events": stg_events,
    "invoices": stg_invoices,
    "products": stg_products,
}
