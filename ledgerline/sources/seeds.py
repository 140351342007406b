"""Reference data (seeds): event types and plan tiers.

Small, fixed lookup tables.  They are created as DataFrames with an
explicit schema; joins against them are broadcast (23 and 5 rows, a
size bound that does not grow with the data).  ``read_seed_csv`` reads
the same tables from CSV files for deployments that keep them on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (BooleanType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType)

EVENT_TYPES_SCHEMA = StructType([
    StructField("event_type_id", IntegerType()),
    StructField("event_type_code", StringType()),
    StructField("event_category", StringType()),
    StructField("event_name", StringType()),
    StructField("is_active", BooleanType()),
])

PLAN_TIERS_SCHEMA = StructType([
    StructField("plan_tier_id", IntegerType()),
    StructField("plan_code", StringType()),
    StructField("plan_name", StringType()),
    StructField("tier_level", IntegerType()),
    StructField("monthly_price_usd", DecimalType(18, 2)),
    StructField("annual_price_usd", DecimalType(18, 2)),
    StructField("max_users", LongType()),
    StructField("max_api_calls_per_month", LongType()),
    StructField("has_sla", BooleanType()),
    StructField("support_tier", StringType()),
    StructField("is_active", BooleanType()),
])

# The event-type catalogue
# (id, code, category, name, is_active).
EVENT_TYPES = [
    (1, "LOGIN", "AUTHENTICATION", "User Login", True),
    (2, "LOGOUT", "AUTHENTICATION", "User Logout", True),
    (3, "PASSWORD_RESET", "AUTHENTICATION", "Password Reset", True),
    (4, "FEATURE_USED", "ENGAGEMENT", "Feature Used", True),
    (5, "PAGE_VIEW", "ENGAGEMENT", "Page View", True),
    (6, "API_CALL", "ENGAGEMENT", "API Call", True),
    (7, "EXPORT", "ENGAGEMENT", "Data Export", True),
    (8, "INVITE_SENT", "GROWTH", "Invite Sent", True),
    (9, "INVITE_ACCEPTED", "GROWTH", "Invite Accepted", True),
    (10, "UPGRADE_CLICKED", "CONVERSION", "Upgrade CTA Clicked", True),
    (11, "PLAN_UPGRADED", "CONVERSION", "Plan Upgraded", True),
    (12, "PLAN_DOWNGRADED", "CONVERSION", "Plan Downgraded", True),
    (13, "TRIAL_STARTED", "LIFECYCLE", "Trial Started", True),
    (14, "TRIAL_CONVERTED", "LIFECYCLE", "Trial Converted", True),
    (15, "TRIAL_EXPIRED", "LIFECYCLE", "Trial Expired", True),
    (16, "SUBSCRIPTION_CREATED", "LIFECYCLE", "Subscription Created", True),
    (17, "SUBSCRIPTION_RENEWED", "LIFECYCLE", "Subscription Renewed", True),
    (18, "SUBSCRIPTION_CANCELLED", "LIFECYCLE", "Subscription Cancelled", True),
    (19, "PAYMENT_SUCCESS", "BILLING", "Payment Success", True),
    (20, "PAYMENT_FAILED", "BILLING", "Payment Failed", True),
    (21, "CHURN_RISK_FLAGGED", "RETENTION", "Churn Risk Flagged", True),
    (22, "SUPPORT_TICKET", "SUPPORT", "Support Ticket Created", True),
    (23, "NPS_SUBMITTED", "FEEDBACK", "NPS Survey Submitted", True),
]

# The plan tiers
# (id, code, name, tier, monthly, annual, max users, max api calls/month,
#  has_sla, support tier, is_active).
PLAN_TIERS = [
    (1, "FREE", "Free", 1, "0.00", "0.00", 3, 1000, False, "community", True),
    (2, "STARTER", "Starter", 2, "29.00", "290.00", 10, 10000, False, "email", True),
    (3, "PRO", "Pro", 3, "99.00", "990.00", 50, 100000, True, "priority", True),
    (4, "ENTERPRISE", "Enterprise", 4, "499.00", "4990.00", 999999, 999999999, True, "dedicated", True),
    (5, "ENTERPRISE_PLUS", "Enterprise Plus", 5, "999.00", "9990.00", 999999, 999999999, True, "white_glove", True),
]


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _local_table(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """A literal table as a ``VALUES`` relation (a local scan the optimizer can
    fold, not an RDD), cast to the declared schema."""
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(f.name for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def event_types(spark: SparkSession) -> DataFrame:
    """IO2: event-type seed (23 rows)."""
    return _local_table(spark, EVENT_TYPES, EVENT_TYPES_SCHEMA)


def plan_tiers(spark: SparkSession) -> DataFrame:
    """IO3: plan-tier seed (5 rows)."""
    return _local_table(spark, PLAN_TIERS, PLAN_TIERS_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a seed from a CSV file with its declared schema."""
    schema = {"event_types": EVENT_TYPES_SCHEMA, "plan_tiers": PLAN_TIERS_SCHEMA}[name]
    return spark.read.csv(path, header=True, schema=schema)


def read_seed(spark: SparkSession, name: str) -> DataFrame:
    return {"event_types": event_types, "plan_tiers": plan_tiers}[name](spark)
