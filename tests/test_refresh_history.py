"""Marts refreshed from changes = full builds; snapshots as a stream = the batch chain."""
import datetime as dt
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import refresh, revenue, scd2, staging
from ledgerline.plans import batches
from ledgerline.sources.fixtures import raw_tables
from ledgerline.sources.store import TableStore
from ledgerline.streaming import history

from conftest import SF_SMALL
from test_store import scanned

D = lambda m: dt.date(2001 + (m - 1) // 12, (m - 1) % 12 + 1, 5)
SCHEMA = ("invoice_sk string, invoice_date date, plan_code string, tier_level int, customer_sk string, subscription_sk string, is_paid boolean, "
          "is_refunded boolean, is_failed boolean, mrr_contribution_usd decimal(28,8), arr_contribution_usd decimal(38,2), net_amount_usd decimal(18,2)")


def invoices(spark, rows):
    full = [(f"{s}-{m}", D(m), "PRO", 3, s, s, True, False, False, Decimal(v), Decimal(12 * v), Decimal(v)) for s, m, v in rows]
    return spark.createDataFrame(full, SCHEMA).withColumn("partition_month", F.trunc("invoice_date", "month"))


def test_refreshed_revenue_equals_a_full_build(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="ll-refresh-") + "/wh")
    deliveries = [[(s, m, 10 + m) for s in ("a", "b") for m in range(1, 20)], [("a", 5, 90), ("c", 6, 7), ("b", 20, 5)], [("d", 30, 1)], [("a", 30, 2), ("a", 19, 3)]]
    for rows in deliveries:
        new = invoices(spark, rows)
        store.merge("facts", "fct_invoices", new, ["invoice_sk"], ["partition_month"], mark_col=None)
        got = refresh.refresh_revenue(store, refresh.touched_months(new))
        want = revenue.mart_revenue(store.read("facts", "fct_invoices").drop("partition_month"))
        assert got.count() == want.count() and got.select(want.columns).exceptAll(want).count() == 0
    touched = store.read("facts", "fct_invoices").where(refresh.one_of("partition_month", [dt.date(2001, 5, 1)]))
    assert scanned(touched) == 2                             # one month of the fact is read for one month of changes


def test_a_month_that_lost_its_rows(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="ll-refresh-") + "/wh")
    store.write("facts", "fct_invoices", invoices(spark, [("a", 1, 5), ("a", 2, 6), ("b", 4, 7)]), ["partition_month"])
    refresh.refresh_revenue(store, {dt.date(2001, m, 1) for m in (1, 2, 4)})
    store.write("facts", "fct_invoices", invoices(spark, [("a", 1, 5), ("b", 4, 7)]), ["partition_month"])
    got = refresh.refresh_revenue(store, {dt.date(2001, 2, 1)})
    assert sorted(r.revenue_month.month for r in got.collect()) == [1, 4]


def test_streamed_snapshots_equal_the_batch_chain(spark):
    raw = raw_tables(spark, SF_SMALL)["customers"]
    scratch = tempfile.mkdtemp(prefix="ll-scd-")
    chain, schema = None, None
    payload, check = scd2.CUSTOMER_SNAPSHOT_COLUMNS, scd2.CUSTOMER_CHECK
    extracts = []
    for n, run_ts in enumerate(batches.CUSTOMER_RUNS, start=1):
        stg = staging.stg_customers(batches.customers_batch(raw, n))
        chain = scd2.snp_customers(chain, stg, run_ts)
        extracts.append(stg.select(*payload).withColumn("run_ts", F.lit(run_ts).cast("timestamp")))
        schema = extracts[-1].schema
    landing = f"{scratch}/landing"
    spark.createDataFrame([], schema).write.parquet(landing)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    query = (history.version_events(spark.readStream.schema(schema).parquet(landing), "customer_id", payload, check)
             .writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck").outputMode("append").start(f"{scratch}/out"))
    try:
        for extract in extracts:
            extract.coalesce(1).write.mode("append").parquet(landing)
            query.processAllAvailable()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == chain.where("dbt_valid_to is null").count()
    finally:
        query.stop()
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = history.latest_versions(spark.read.parquet(f"{scratch}/out"))
    assert got.count() == chain.count()
    assert got.select(chain.columns).exceptAll(chain).count() == 0
