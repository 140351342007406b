"""IO1: reading the five landed raw tables.

In production the raw tables are landed parquet directories (one per
source) with a ``_loaded_at`` load-time column.  A fixed read schema keeps
file-footer inference off the driver and makes a streaming read possible
with the same schema.  Column types are the ones the staging casts
produce; staging casts again, so a source with looser types still works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t) for n, t in cols])


S, L, D, TS, B = StringType(), LongType(), DateType(), TimestampNTZType(), BooleanType()
M = DecimalType(18, 2)

RAW_SCHEMAS = {
    "customers": _schema(
        ("customer_id", L), ("email", S), ("first_name", S), ("last_name", S),
        ("country_code", S), ("company_name", S), ("customer_segment", S),
        ("acquisition_channel", S), ("created_at", TS), ("updated_at", TS),
        ("is_deleted", B), ("_loaded_at", TS)),
    "subscriptions": _schema(
        ("subscription_id", L), ("customer_id", L), ("product_id", L), ("status", S),
        ("billing_period", S), ("plan_code", S), ("mrr_usd", M), ("arr_usd", M),
        ("trial_start_date", D), ("trial_end_date", D), ("start_date", D), ("end_date", D),
        ("cancelled_at", TS), ("cancellation_reason", S), ("created_at", TS),
        ("updated_at", TS), ("_loaded_at", TS)),
    "events": _schema(
        ("event_id", L), ("customer_id", L), ("subscription_id", L), ("event_type", S),
        ("event_category", S), ("feature_name", S), ("session_id", S), ("device_type", S),
        ("platform", S), ("occurred_at", TS), ("properties", S), ("_loaded_at", TS)),
    "invoices": _schema(
        ("invoice_id", S), ("subscription_id", L), ("customer_id", L), ("invoice_status", S),
        ("payment_method", S), ("currency_code", S), ("amount_usd", M), ("tax_usd", M),
        ("discount_usd", M), ("net_amount_usd", M), ("invoice_date", D), ("due_date", D),
        ("paid_at", TS), ("created_at", TS), ("_loaded_at", TS)),
    "products": _schema(
        ("product_id", L), ("product_name", S), ("plan_code", S), ("product_category", S),
        ("billing_model", S), ("base_price_monthly_usd", M), ("base_price_annual_usd", M),
        ("is_active", B), ("launched_at", D), ("deprecated_at", D), ("created_at", TS),
        ("updated_at", TS), ("_loaded_at", TS)),
}


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Batch read of one landed raw table with its fixed schema."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(path)


def land(df: DataFrame, path: str, files: int | None = None, group_bytes: int | None = None) -> None:
    """Append a delivery to a landed table, clustered by load time.

    Rows are range-partitioned and sorted on ``_loaded_at``, stored as a TIMESTAMP in
    microseconds, so each file and row group holds a narrow range of load times
    and a scan behind a high-water mark (``merging.newer_than``) skips the others.
    Spark prunes neither INT96 nor TIMESTAMP_NTZ, so the session must write
    ``spark.sql.parquet.outputTimestampType=TIMESTAMP_MICROS``.
    """
    if df.sparkSession.conf.get("spark.sql.parquet.outputTimestampType") != "TIMESTAMP_MICROS":
        raise ValueError("set spark.sql.parquet.outputTimestampType to TIMESTAMP_MICROS, or no load mark can skip anything")
    timed = df.withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp"))
    by = timed.repartitionByRange(files, "_loaded_at") if files else timed.repartitionByRange("_loaded_at")
    out = by.sortWithinPartitions("_loaded_at").write.mode("append")
    if group_bytes:
        out = out.option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", 5000)
    out.parquet(path)


def read_landed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Batch read of a table written by ``land``."""
    fields = [StructField(f.name, TimestampType()) if f.name == "_loaded_at" else f for f in RAW_SCHEMAS[name].fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def read_raw_stream(spark: SparkSession, path: str, name: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of one landed raw table (new files as they land)."""
    reader = spark.readStream.schema(RAW_SCHEMAS[name])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
