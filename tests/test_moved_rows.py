"""What is shuffled, and what a task holds: findings of round 3."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.keys import short_key
from ledgerline.operators import business, facts, obt, quality, revenue, vault
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import store as stores
from ledgerline.sources.merging import latest_per_key
from ledgerline.sources.store import TableStore

TS = dt.datetime(2001, 8, 1)


@pytest.fixture()
def sorted_joins(spark):
    """Joins as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def invoice_fact(spark):
    stg = spark.createDataFrame(
        [("i1", "s1", "c1", "PAID"), ("i2", None, None, "PAID"), ("i3", "s9", "c1", "FAILED")],
        "invoice_id string, subscription_id string, customer_id string, invoice_status string").select(
        "*", F.lit("CARD").alias("payment_method"), F.lit("USD").alias("currency_code"),
        *[F.lit(12).cast("decimal(18,2)").alias(c) for c in ("amount_usd", "tax_usd", "discount_usd", "net_amount_usd")],
        *[F.lit("2001-01-05").cast("date").alias(c) for c in ("invoice_date", "due_date")],
        *[F.lit(TS).cast("timestamp_ntz").alias(c) for c in ("paid_at", "created_at", "_loaded_at")])
    customers = spark.createDataFrame([("c1", "ck1", True)], "customer_id string, customer_sk string, is_current boolean")
    subs = spark.createDataFrame([("s1", "sk1", "PRO", "annual", True)],
                                 "subscription_id string, subscription_sk string, plan_code string, billing_period string, is_current boolean")
    plans = spark.createDataFrame([("PRO", "pk", 3)], "plan_code string, plan_sk string, tier_level int")
    return facts.fct_invoices(stg, customers, subs, plans)


def test_invoice_lookups_do_not_carry_the_invoice_id(sorted_joins):
    fct = invoice_fact(sorted_joins)
    got = {r.invoice_id: (r.customer_sk, r.subscription_sk, r.customer_id) for r in fct.collect()}
    assert got == {"i1": ("ck1", "sk1", "c1"), "i2": ("UNKNOWN", "UNKNOWN", None), "i3": ("ck1", "UNKNOWN", "c1")}
    assert "_customer" not in fct.columns
    assert plan(fct.groupBy("payment_method").agg(F.sum("net_amount_usd"))).count("invoice_id") == 1     # the scan's


def test_movements_take_one_shuffle_and_one_sort_of_monthly_revenue(sorted_joins):
    spark = sorted_joins
    fct = spark.createDataFrame([("c1", "s1", "2001-01-05", 10), ("c1", "s1", "2001-02-07", 15), ("c1", "s1", "2001-02-09", 1)],
                                "customer_sk string, subscription_sk string, d string, v int").select(
        "customer_sk", "subscription_sk", F.col("d").cast("date").alias("invoice_date"), F.lit("PRO").alias("plan_code"),
        (F.col("v") % 2).alias("tier_level"), F.lit(True).alias("is_paid"), F.lit(False).alias("is_refunded"), F.lit(False).alias("is_failed"),
        *[F.col("v").cast(t).alias(c) for c, t in (("mrr_contribution_usd", "decimal(28,8)"), ("arr_contribution_usd", "decimal(38,2)"), ("net_amount_usd", "decimal(18,2)"))])
    moved = revenue.mrr_movements(revenue.monthly_invoices(fct))
    assert exchanges(moved) == 1 and plan(moved).count("Sort [") == 1
    rows = sorted(tuple(map(str, (r.revenue_month, r.current_mrr + 0, r.prior_mrr, r.expansion_mrr, r.new_mrr))) for r in moved.collect())
    assert [tuple(float(x) for x in r[1:]) for r in rows] == [(10, 0, 0, 10), (16, 10, 6, 0)]


def test_short_keys_tell_all_texts_apart(spark):
    texts = ["UNKNOWN", "unknown", "", "0" * 32, "0" * 31 + "g", "A" * 32, "0123456789abcdef", "\0" * 16]
    df = spark.createDataFrame([(t,) for t in texts] * 2 + [(None,)], "k string").withColumn("s", short_key("k"))
    assert df.agg(F.count_distinct("s")).first()[0] == len(texts)
    assert df.where("k is null and s is not null").isEmpty()
    assert df.where(F.col("k") == "0" * 32).agg(F.max(F.length("s"))).first()[0] == 16


def subscriptions(spark):
    return spark.createDataFrame([("s1", "c1", "p1", 1), ("s1", "c1", "p1", 2), ("s2", None, "p1", 1), (None, None, None, 1)],
                                 "subscription_id string, customer_id string, product_id string, v int").select(
        "*", *[F.lit("x").alias(c) for c in ("status", "billing_period", "plan_code", "cancellation_reason")],
        *[F.col("v").cast("decimal(18,2)").alias(c) for c in ("mrr_usd", "arr_usd")],
        *[F.lit(TS).cast("date").alias(c) for c in ("trial_start_date", "trial_end_date", "start_date", "end_date")],
        F.lit(TS).cast("timestamp_ntz").alias("cancelled_at"), F.lit(TS).cast("timestamp_ntz").alias("_loaded_at"))


def test_a_first_satellite_load_and_its_current_rows_take_one_shuffle(sorted_joins):
    sat = vault.load_satellite(subscriptions(sorted_joins), vault.SATELLITES["sat_subscription_details"], TS)
    assert exchanges(vault.current_rows(sat)) == 1
    assert sorted(float(r.mrr_usd) for r in sat.collect()) == [1, 1, 2]


def test_links_are_told_apart_before_they_are_hashed(spark):
    link = vault.load_link(subscriptions(spark), vault.LINKS["lnk_customer_subscription"], TS)
    p = plan(link)
    assert "sha2" not in p[p.index("Exchange hashpartitioning"):]
    assert link.count() == 3 and link.where("hub_customer_hash_key is null").count() == 2


def test_health_joins_invoices_without_moving_the_subscriptions(sorted_joins):
    spark, subs = sorted_joins, subscriptions(sorted_joins)
    invoices = spark.createDataFrame([("s1", "PAID"), ("s1", "FAILED"), (None, "PAID")], "subscription_id string, invoice_status string").select(
        "*", F.lit(5).cast("decimal(18,2)").alias("net_amount_usd"), F.lit(TS).cast("date").alias("invoice_date"))
    health = business.bv_subscription_health(
        vault.load_hub(subs, vault.HUBS["hub_subscription"], TS), vault.load_satellite(subs, vault.SATELLITES["sat_subscription_details"], TS),
        vault.load_link(subs, vault.LINKS["lnk_customer_subscription"], TS), vault.load_link(subs, vault.LINKS["lnk_subscription_product"], TS),
        invoices, TS.date(), TS)
    assert plan(health).count("Exchange hashpartitioning(subscription_id#") == 1     # that of the invoices
    assert sorted((r.subscription_id, r.total_invoices, r.failed_invoices) for r in health.collect()) == [("s1", 2, 1), ("s2", 0, 0)]


def test_the_grid_of_the_wide_table_is_not_shuffled(sorted_joins):
    from ledgerline.config import Config
    from ledgerline.plans.warehouse import Warehouse
    from tests.conftest import SF_SMALL
    p = plan(Warehouse.from_testdata(sorted_joins, SF_SMALL, Config.fixtures()).t("obt_saas_metrics"))
    assert "Exchange hashpartitioning(report_month" not in p
    assert "Exchange" not in p[:p.index("Generate explode")].split("Final Plan")[-1]


def test_months_of_customers_leaves_null_months_out(spark):
    rows = spark.createDataFrame([("2001-01-01", "c1", 5), (None, "c1", 7)], "m string, customer_sk string, v int").select(
        F.col("m").cast("date").alias("report_month"), "customer_sk", "v")
    assert [(r.customer_sk, {k: v.v for k, v in r.x.items()}) for r in obt.months_of_customers(rows, "x").collect()] == [("c1", {dt.date(2001, 1, 1): 5})]


def test_unique_groups_only_values_seen_before(spark):
    found = quality.unique(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int"), "k")
    p = plan(found)
    assert p.count("Exchange") == 1 and "Aggregate" not in p[p.index("Window"):]
    assert [tuple(r) for r in found.collect()] == [("a", 2)] and dict(found.dtypes)["n_records"] == "bigint"


@pytest.mark.parametrize("few", [0, 100])
def test_a_merge_reduces_repeated_keys_only(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(stores, "FEW", few)
    store, made = TableStore(spark, str(tmp_path)), "k string, v int, part string, _loaded_at timestamp_ntz"
    first = [("a", 1, "p", TS), ("a", 2, "p", TS + dt.timedelta(1)), ("b", 3, "q", TS), (None, 4, "q", TS), (None, 5, "q", TS)]
    store.merge("facts", "t", spark.createDataFrame(first, made), ["k"], ["part"])
    assert sorted(tuple(map(str, r)) for r in store.read("facts", "t").select("k", "v").collect()) == [("None", "5"), ("a", "2"), ("b", "3")]
    store.merge("facts", "t", spark.createDataFrame([("a", 9, "p", TS), ("a", 8, "p", TS), ("c", 7, "q", TS)], made), ["k"], ["part"])
    want = {"a": 9, "b": 3, "c": 7, None: 5}
    assert {r.k: r.v for r in store.read("facts", "t").collect()} == want


def test_rows_of_unique_keys_are_not_shuffled_by_a_merge(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("string").alias("k")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert "Exchange" not in plan(TableStore(spark, str(tmp_path))._reduced(rows, "t", ["k"]))
    assert "Exchange" in plan(latest_per_key(rows.withColumn("v", F.lit(1)), ["k"], []))


def test_a_written_increment_is_not_written_again(spark, tmp_path):
    spark.createDataFrame([("a", "p")], "k string, part string").write.parquet(f"{tmp_path}/rows")
    copies = lambda: len(glob.glob(os.path.join(ensure_checkpoint_dir(spark), "ledgerline-once-increment-*")))
    store = TableStore(spark, f"{tmp_path}/store")
    store.merge("facts", "once", spark.read.parquet(f"{tmp_path}/rows"), ["k"], ["part"], written=True)
    assert copies() == 0 and store.read("facts", "once").count() == 1
