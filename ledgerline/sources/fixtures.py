"""Raw source tables derived from the driver's TPC-H-like tables.

The warehouse reads five raw tables (customers, subscriptions, events,
invoices, products).  The test data ships ``customer``, ``orders``,
``lineitem``, ``events`` and ``part``; each raw table is a projection
(``invoices`` a join) of one of them, so raw tables grow with the test
data and every mapping is a narrow transformation Spark pipelines into
the scan.  Events are shifted back 23 years so that one reporting date
(2001-08-01) covers orders and events alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _size(df: DataFrame) -> Column:
    """The rows of a table, as a scalar in another table's query: keys that point
    into it then cover it at every scale factor."""
    return df.select(F.count(F.lit(1))).scalar()


def raw_customers(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _scan
    c = read(spark, sf_dir, "customer")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 360).cast("int"))
    ts = day.cast("timestamp_ntz")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.COM ")).alias("email"),
        F.substring("c_name", 1, 8).alias("first_name"),
        F.expr("substring(c_name, 10)").alias("last_name"),
        F.lower(F.expr("substring('USDEFRGBCA', 1 + 2 * (c_nationkey % 5), 2)")).alias("country_code"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Company "), F.col("c_nationkey").cast("string"))).alias("company_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.element_at(F.array(F.lit("Organic"), F.lit("Paid"), F.lit("Referral"), F.lit("Partner")),
                     (F.col("c_custkey") % 4 + 1).cast("int")).alias("acquisition_channel"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        (F.col("c_custkey") % 50 == 49).alias("is_deleted"),
        ts.alias("_loaded_at"),
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _scan
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    finished = F.col("o_orderstatus") == "F"
    prio = F.substring("o_orderpriority", 1, 1)
    mrr = F.col("o_totalprice").cast("decimal(18,2)")
    trial = key % 5 == 0
    return o.select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        (key % _size(read(spark, sf_dir, "part"))).alias("product_id"),
        F.when(F.col("o_orderstatus") == "O", "Active")
         .when(finished, "Cancelled")
         .when(key % 3 == 0, "Paused").when(key % 3 == 1, "Trialing")
         .otherwise("Past_Due").alias("status"),
        F.when(key % 4 == 0, "Annual").otherwise("Monthly").alias("billing_period"),
        F.when(key % 97 == 0, "LEGACY")
         .when(prio == "5", "FREE").when(prio == "4", "STARTER").when(prio == "3", "PRO")
         .when(prio == "2", "ENTERPRISE").otherwise("ENTERPRISE_PLUS").alias("plan_code"),
        mrr.alias("mrr_usd"),
        (mrr * 12).cast("decimal(18,2)").alias("arr_usd"),
        F.when(trial, F.date_sub(odate, 14)).alias("trial_start_date"),
        F.when(trial, odate).alias("trial_end_date"),
        odate.alias("start_date"),
        F.when(finished, F.date_add(odate, 365)).alias("end_date"),
        F.when(finished, F.date_add(odate, (30 + key % 300).cast("int")).cast("timestamp_ntz")).alias("cancelled_at"),
        F.when(finished, F.when(key % 2 == 0, "price").otherwise("features")).alias("cancellation_reason"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_invoices(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    """One invoice per line item, dated ``linenumber - 1`` months after the order."""
    read = read or _scan
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = (amount * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)")
    disc = (amount * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    inv_date = F.add_months(F.col("o_orderdate").cast("date"), (F.col("l_linenumber") - 1).cast("int"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    ln = F.col("l_linenumber")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    F.col("l_shipdate").cast("date").cast("string")).alias("invoice_id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when((rf == "R") & (ls == "F"), "refunded")
         .when((rf == "N") & (ls == "F"), "failed").otherwise("paid").alias("invoice_status"),
        F.when(ln % 3 == 0, "card").when(ln % 3 == 1, "ach").otherwise("wire").alias("payment_method"),
        F.lit("usd").alias("currency_code"),
        amount.alias("amount_usd"),
        tax.alias("tax_usd"),
        disc.alias("discount_usd"),
        (amount + tax - disc).cast("decimal(18,2)").alias("net_amount_usd"),
        inv_date.alias("invoice_date"),
        F.date_add(inv_date, 30).alias("due_date"),
        F.when(~((ls == "F") & rf.isin("R", "N")),
               F.date_add(inv_date, ln.cast("int")).cast("timestamp_ntz")).alias("paid_at"),
        inv_date.cast("timestamp_ntz").alias("created_at"),
        inv_date.cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_events(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _scan
    e = read(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    mapped = (F.when(et == "view", "page_view")
              .when(et == "click", F.when(eid % 3 == 0, "feature_used").when(eid % 3 == 1, "api_call").otherwise("export"))
              .when(et == "purchase", F.when(eid % 2 == 0, "plan_upgraded").otherwise("invite_sent"))
              .when(et == "signup", F.when(eid % 3 == 0, "trial_converted").when(eid % 3 == 1, "subscription_created").otherwise("login"))
              .otherwise(F.when(eid % 4 == 0, "churn_risk_flagged").when(eid % 4 == 1, "subscription_cancelled").otherwise("error")))
    shifted = (F.col("ts") - F.expr("interval 23 years")).cast("timestamp_ntz")
    return (e.select("*", mapped.alias("mapped_type"))
            .select(
                eid.alias("event_id"),
                F.col("user_id").alias("customer_id"),
                F.when(eid % 4 == 0, F.lit(None).cast("bigint")).otherwise(
                    eid % _size(read(spark, sf_dir, "orders"))).alias("subscription_id"),
                F.col("mapped_type").alias("event_type"),
                F.when(et == "error", "diagnostics").otherwise("product").alias("event_category"),
                F.when(eid % 10 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("feature_"),
                                     (F.get_json_object("props", "$.k").cast("int") % 10).cast("string"))).alias("feature_name"),
                F.concat_ws("-", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string")).alias("session_id"),
                F.when(eid % 3 == 0, "mobile").when(eid % 3 == 1, "desktop").otherwise("tablet").alias("device_type"),
                F.when(eid % 2 == 0, "web").otherwise("ios").alias("platform"),
                shifted.alias("occurred_at"),
                F.col("props").alias("properties"),
                shifted.alias("_loaded_at"),
            ))


def raw_products(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _scan
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    base = F.lit("1995-01-01").cast("timestamp_ntz")
    return p.select(
        k.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.element_at(F.array(*[F.lit(x) for x in ("free", "starter", "pro", "enterprise", "enterprise_plus", "legacy")]),
                     (k % 6 + 1).cast("int")).alias("plan_code"),
        F.col("p_type").alias("product_category"),
        F.when(k % 2 == 0, "Flat").otherwise("Usage").alias("billing_model"),
        price.alias("base_price_monthly_usd"),
        (price * 10).cast("decimal(18,2)").alias("base_price_annual_usd"),
        (F.col("p_size") <= 40).alias("is_active"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size").cast("int")).alias("launched_at"),
        F.when(F.col("p_size") > 40, F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size").cast("int"))).alias("deprecated_at"),
        base.alias("created_at"),
        base.alias("updated_at"),
        base.alias("_loaded_at"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "subscriptions": raw_subscriptions,
    "events": raw_events,
    "invoices": raw_invoices,
    "products": raw_products,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five raw tables, lazily derived from the driver's parquet files.

    Each driver table is scanned through one shared DataFrame (``orders``
    feeds both subscriptions and invoices).
    """
    scans: dict[str, DataFrame] = {}

    def shared(spark_: SparkSession, sf_dir_: str, name: str) -> DataFrame:
        if name not in scans:
            scans[name] = _scan(spark_, sf_dir_, name)
        return scans[name]

    return {name: build(spark, sf_dir, shared) for name, build in RAW_BUILDERS.items()}
