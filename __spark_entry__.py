"""

``entry(spark)`` runs the flagship query (``mart_usage``) on sf0.001.
``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; every query
derives the five raw tables from the driver's parquet files and runs the
warehouse graph up to the requested table, so its work grows with the data.
``oracle_sql()`` gives, per query, the same table written as plain SQL for
DuckDB over the driver's views (see ``duck_oracle.py``).
"""

from __future__ import annotations

import datetime as dt
import importlib
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duck_oracle as duck  # noqa: E402
from ledgerline.config import Config  # noqa: E402
from ledgerline.operators import (bitmaps, business, churn, cohorts, metrics,  # noqa: E402
                                  obt, quality, refresh, revenue, scd2, staging, usage, vault)
from ledgerline.sources.merging import as_view, newer_than  # noqa: E402
from ledgerline.sources.store import TableStore  # noqa: E402
from ledgerline.plans import batches  # noqa: E402
from ledgerline.plans.warehouse import FACTS, LOAD_MONTH, PARTITION, Warehouse, fact_rows, load_vault  # noqa: E402
from ledgerline.session import ensure_checkpoint_dir, materialize  # noqa: E402

# The training-data operators are an optional subpackage: without it, or without
# the pipeline over it, their queries are left out.  Any other missing module is an error.
OPTIONAL = ("ledgerline.llm", "corpus_pipeline")


def _optional(name: str):
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if not missing.name or not any(missing.name == o or missing.name.startswith(o + ".") for o in OPTIONAL):
            raise
        return None


llm = _optional("ledgerline.llm.queries")
corpus_pipeline = _optional("corpus_pipeline") if llm else None

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_testdata(spark, sf_dir, Config.fixtures())


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the usage mart (DAU/WAU/MAU) on sf0.001."""
    return _wh(spark, FLAGSHIP_DIR).t("mart_usage")


# Tables of the graph registered as they are (query name = table name).
GRAPH_TABLES = [
    "stg_customers", "stg_subscriptions", "stg_events", "stg_invoices", "stg_products",
    "hub_customer", "hub_subscription", "hub_product", "hub_event",
    "lnk_customer_subscription", "lnk_subscription_product", "lnk_subscription_event",
    "sat_customer_details", "sat_subscription_details", "sat_product_details", "sat_event_details",
    "bv_customer_lifetime", "bv_subscription_health",
    "snp_customers", "snp_subscriptions",
    "dim_customer", "dim_subscription", "dim_product",
    "fct_events", "fct_invoices", "fct_subscriptions",
    "mart_revenue", "mart_churn", "mart_usage", "obt_saas_metrics", "cohort_retention",
]


def _graph(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _wh(spark, sf_dir).t(name)


def _cfg() -> Config:
    return Config.fixtures()


def _sub_operators() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    c = _cfg()

    def q(fn):
        return lambda spark, sf_dir: fn(_wh(spark, sf_dir))

    def events_recent(w):
        return usage.recent_events(w.t("fct_events"), c.as_of, c.usage_years_back)

    def rolling(w, days, name):
        ev = events_recent(w)
        return usage.rolling_actives(usage.customer_days(ev), usage.daily_usage(ev), days, name)

    return {
        "bv_paid_invoices": q(lambda w: business.paid_invoice_totals(w.t("stg_invoices"))
                              .withColumn("total_revenue_usd", F.col("total_revenue_usd").cast("decimal(38,2)"))),
        "bv_invoice_metrics": q(lambda w: business.invoice_metrics(w.t("stg_invoices"))
                                .withColumn("total_paid_usd", F.col("total_paid_usd").cast("decimal(38,2)"))),
        "rev_monthly": q(lambda w: revenue.monthly_invoices(w.t("fct_invoices"))),
        "rev_movements": q(lambda w: revenue.mrr_movements(revenue.monthly_invoices(w.t("fct_invoices")))),
        "rev_by_plan": q(lambda w: revenue.revenue_by_plan(
            revenue.mrr_movements(revenue.monthly_invoices(w.t("fct_invoices"))))),
        "churn_counts": q(lambda w: churn.churn_counts(w.t("fct_subscriptions"), c.as_of,
                                                       c.churn_years_back, c.start_date)),
        "usage_customer_days": q(lambda w: usage.customer_days(events_recent(w))),
        "usage_daily": q(lambda w: usage.daily_usage(events_recent(w))),
        "usage_wau": q(lambda w: rolling(w, 7, "wau_7d")),
        "usage_mau": q(lambda w: rolling(w, 28, "mau_28d")),
        "obt_customer_months": q(lambda w: obt.customer_months(w.t("dim_customer"), c.start_date, c.as_of)
                                 .drop("customer_sk")),
        "obt_revenue": q(lambda w: obt.customer_revenue(w.t("fct_invoices"))),
        "obt_usage": q(lambda w: obt.customer_usage(w.t("fct_events"))),
        "obt_subscriptions": q(lambda w: obt.started_subscriptions(w.t("fct_subscriptions"))),
        "cohort_sizes": q(lambda w: cohorts.cohort_sizes(w.t("dim_customer"))),
    }


# ---------------------------------------------------------------- multi-batch runs
def _snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SN1/SN3: customer history after three snapshot runs (changes, deletes, returns)."""
    w = _wh(spark, sf_dir)
    hist = None
    for n, run_ts in enumerate(batches.CUSTOMER_RUNS, start=1):
        stg = staging.stg_customers(batches.customers_batch(w.raw["customers"], n))
        hist = scd2.snp_customers(hist, stg, run_ts)
    return hist


def _subscription_snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SN2: subscription history after two runs (some subscriptions cancelled)."""
    w = _wh(spark, sf_dir)
    hist = None
    for n, run_ts in enumerate(batches.SUBSCRIPTION_RUNS, start=1):
        stg = staging.stg_subscriptions(batches.subscriptions_batch(w.raw["subscriptions"], n))
        hist = scd2.snp_subscriptions(hist, stg, run_ts)
    return hist


def _satellite_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SA0 incremental + SA5: subscription satellite after two loads, with end dates."""
    w = _wh(spark, sf_dir)
    spec = vault.SATELLITES["sat_subscription_details"]
    sat = None
    for n, run_ts in enumerate(batches.SUBSCRIPTION_RUNS, start=1):
        stg = staging.stg_subscriptions(batches.subscriptions_batch(w.raw["subscriptions"], n))
        new = vault.load_satellite(stg, spec, run_ts, sat)
        sat = vault.merge_satellite(sat, new)
    return vault.with_end_dates(sat)


def _customer_satellite_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SA0 merge: customer satellite after three loads, the third under the
    second one's load time: its rows replace those of the same key and time."""
    raw = _wh(spark, sf_dir).raw["customers"]
    first, second = batches.CUSTOMER_RUNS[:2]
    spec = vault.SATELLITES["sat_customer_details"]
    sat = None
    for batch, run_ts in ((batches.customers_batch(raw, 1), first), (batches.customers_batch(raw, 2), second),
                          (batches.customers_corrected(raw), second)):
        sat = vault.merge_satellite(sat, vault.load_satellite(staging.stg_customers(batch), spec, run_ts, sat))
    return vault.with_end_dates(sat)


def _event_history(name: str):
    """HB4, LK3 incremental: two loads, the second only of rows newer than the mark."""
    load, spec = ((vault.load_hub, vault.HUBS[name]) if name in vault.HUBS else (vault.load_link, vault.LINKS[name]))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _wh(spark, sf_dir).raw["events"]
        old, every = (staging.stg_events(batches.events_batch(raw, n)) for n in (1, 2))
        first = load(old, spec, batches.CUSTOMER_RUNS[0])
        return first.unionByName(load(newer_than(every, old), spec, batches.CUSTOMER_RUNS[1], first))
    return run


def _scratch(spark: SparkSession, label: str) -> TableStore:
    return TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")


def _partition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO6, IO9 on disk: a fact in partitions of its key, merged with a batch of
    moved and NULL months, a new column and changed types."""
    store = _scratch(spark, "partition-merge")
    part = F.concat(F.lit("p"), F.pmod(F.xxhash64("subscription_event_sk"), F.lit(16)))
    for batch in batches.partition_batches(_wh(spark, sf_dir).t("fct_subscriptions")):
        store.merge("facts", "fct_subscriptions", batch.withColumn("key_part", part), ["subscription_event_sk"], ["key_part"])
    return store.read("facts", "fct_subscriptions").drop("key_part")


def _satellite_event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SA4 stored: the event satellite loaded in two increments behind the mark, the
    second one twice, with end dates."""
    store, raw = _scratch(spark, "event-satellite"), _wh(spark, sf_dir).raw["events"]
    old, every = (staging.stg_events(batches.events_batch(raw, n)) for n in (1, 2))
    load_vault(store, "sat_event_details", old, batches.CUSTOMER_RUNS[0])
    for _ in range(2):
        load_vault(store, "sat_event_details", newer_than(every, old), batches.CUSTOMER_RUNS[1])
    return vault.with_end_dates(store.read("raw_vault", "sat_event_details").drop(vault.KEY_PART, LOAD_MONTH))


def _usage_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MU3-MU5 from stored day bitmaps: all days, then the last days once more, as
    after late events; daily, weekly and monthly actives by OR."""
    store, w, c = _scratch(spark, "bitmaps"), _wh(spark, sf_dir), _cfg()
    events = materialize(usage.recent_events(w.t("fct_events"), c.as_of, c.usage_years_back).select("event_date", "customer_sk"), "recent-events")
    numbers = materialize(bitmaps.dense_numbers(events), "customer-numbers")
    cut = F.lit(batches.EVENT_CUTOFF).cast("date")
    bitmaps.refresh_days(store, bitmaps.day_bitmaps(events.where((F.col("event_date") <= cut) | (F.hash("customer_sk") % 2 == 0)), numbers))
    days = bitmaps.refresh_days(store, bitmaps.day_bitmaps(events.where(F.col("event_date") > cut), numbers))
    return bitmaps.rolling_actives(days)


def _monthly_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME11 by month from day bitmaps."""
    events = _wh(spark, sf_dir).t("fct_events").select(F.col("event_date_key").alias("event_date"), "customer_sk")
    events = materialize(events, "events")
    days = bitmaps.day_bitmaps(events, bitmaps.dense_numbers(events))
    return bitmaps.actives(days, F.trunc("event_date", "month"), "metric_time__month", "active_users")


def _event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: typed values of event properties, some of them malformed."""
    raw = batches.odd_properties(_wh(spark, sf_dir).raw["events"])
    return staging.property_values(staging.stg_events(raw), {"k_number": ("$.k", "int"), "k_text": ("$.k", "string"), "second": ("$[1]", "bigint")})


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO4: staged subscriptions as a view, read with SQL."""
    name = f"stg_subscriptions_{uuid.uuid4().hex}"
    as_view(_wh(spark, sf_dir).t("stg_subscriptions"), name)
    return spark.sql(f"select status, billing_period, count(*) as subscriptions, cast(sum(mrr_usd) as decimal(28,2)) as mrr_usd from {name} group by all")


def _stored_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO7, HK4: the event hub stored by a first load and by an incremental one, each
    under a load time of its own; the incremental one is run twice."""
    store, raw = _scratch(spark, "event-hub"), _wh(spark, sf_dir).raw["events"]
    old, every = (staging.stg_events(batches.events_batch(raw, n)) for n in (1, 2))
    load_vault(store, "hub_event", old, batches.CUSTOMER_RUNS[0], key_digits=2)
    for _ in range(2):
        load_vault(store, "hub_event", newer_than(every, old), batches.CUSTOMER_RUNS[1], key_digits=2)
    return store.read("raw_vault", "hub_event").drop(vault.KEY_PART)


LATE_START = dt.date(1999, 6, 15)


def _late_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO11: the customers' months of a calendar that starts later, within a month."""
    w = _wh(spark, sf_dir)
    return obt.customer_months(w.t("dim_customer"), LATE_START, w.cfg.as_of).select("report_month", "customer_id", "cohort_month")


def _revenue_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MR1-MR4 after two loads of the invoice fact, each followed by a refresh of the
    months it touched."""
    store, w = _scratch(spark, "revenue"), _wh(spark, sf_dir)
    for dim in ("customer_keys", "subscription_keys"):
        w.put(dim, materialize(w.t(dim), dim))
    out = None
    for n in (1, 2):
        w.put("stg_invoices", staging.stg_invoices(batches.invoices_batch(w.raw["invoices"], n)))
        new = store.increment("facts", "fct_invoices", fact_rows(w, "fct_invoices", store.mark("facts", "fct_invoices"), store))
        months = refresh.touched_months(new)
        store.merge("facts", "fct_invoices", new, ["invoice_sk"], [PARTITION], written=True)
        store.merged("facts", "fct_invoices")
        out = refresh.refresh_revenue(store, months)
    return out


def _hub_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HB0 incremental: customer hub after three loads (a key keeps its first load date)."""
    w = _wh(spark, sf_dir)
    spec = vault.HUBS["hub_customer"]
    hub = None
    for n, run_ts in enumerate(batches.CUSTOMER_RUNS, start=1):
        stg = staging.stg_customers(batches.customers_batch(w.raw["customers"], n))
        new = vault.load_hub(stg, spec, run_ts, hub)
        hub = new if hub is None else hub.unionByName(new)
    return hub


def _split_load(table: str, batch_fn, n_batches: int):
    """IO6 + IO8: a stored fact loaded in batches (high-water mark, merge on its key)."""
    raw_name, key, _ = FACTS[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = _scratch(spark, "split-load")
        w = _wh(spark, sf_dir)
        # the dimensions a fact load looks up are written before the loads (as in a run)
        for dim in ("customer_keys", "subscription_keys", "dim_product"):
            w.put(dim, materialize(w.t(dim), dim))
        for n in range(1, n_batches + 1):
            w.put(f"stg_{raw_name}", staging.STAGERS[raw_name](batch_fn(w.raw[raw_name], n)))
            store.merge("facts", table, fact_rows(w, table, store.mark("facts", table), store), [key], [PARTITION])
        return store.read("facts", table).drop(PARTITION)
    return run


def _batch_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "snp_customers_history": _snapshot_history,
        "snp_subscriptions_history": _subscription_snapshot_history,
        "sat_subscription_history": _satellite_history,
        "sat_customer_history": _customer_satellite_history,
        "hub_event_history": _event_history("hub_event"),
        "lnk_subscription_event_history": _event_history("lnk_subscription_event"),
        "sat_event_history": _satellite_event_history,
        "stg_event_properties": _event_properties,
        "view_subscriptions": _view,
        "hub_event_stored": _stored_hub,
        "obt_months_late_start": _late_start,
        "mart_revenue_refreshed": _revenue_refreshed,
        "usage_bitmap_actives": _usage_bitmaps,
        "metric_monthly_active_users": _monthly_actives,
        "fct_subscriptions_partition_merge": _partition_merge,
        "hub_customer_history": _hub_history,
        "fct_events_split_load": _split_load("fct_events", batches.events_batch, 3),
        "fct_invoices_split_load": _split_load("fct_invoices", batches.invoices_batch, 3),
        "fct_subscriptions_split_load": _split_load("fct_subscriptions", batches.subscriptions_split, 2),
    }


# ---------------------------------------------------------------- metric layer
METRIC_QUERIES = {
    # name: (metric, by, grain)
    "metric_mrr": ("mrr", ("plan_code",), "month"),
    "metric_arr": ("arr", (), "month"),
    "metric_total_collected_revenue": ("total_collected_revenue", ("payment_method",), "quarter"),
    "metric_new_customers": ("new_customers", ("customer_segment",), "month"),
    "metric_active_subscriptions": ("active_subscriptions", ("status",), "year"),
    "metric_dau": ("dau", (), "day"),
    "metric_total_events": ("total_events", ("platform",), "week"),
    "measure_invoice_count": ("invoice_count", ("payment_method",), "month"),
    "measure_subscription_mrr": ("subscription_mrr", ("status",), "quarter"),
}


def _metric(metric: str, by: tuple, grain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = _wh(spark, sf_dir)
        named = metrics.METRICS.get(metric)
        sm, _ = metrics.measure_model(named.measure if named else metric)
        return metrics.metric_query({sm.table: w.t(sm.table)}, metric, by, grain)
    return run


def _events_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME13: daily event counts over the whole time spine, gaps filled with 0."""
    w = _wh(spark, sf_dir)
    daily = metrics.metric_query({"fct_events": w.t("fct_events")}, "total_events", (), "day")
    return metrics.fill_spine(daily, w.t("time_spine"), "metric_time__day", ["total_events"])


def _metrics_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME5: metrics of two models side by side, one of them filtered."""
    w = _wh(spark, sf_dir)
    tables = {n: w.t(n) for n in ("fct_invoices", "fct_subscriptions")}
    return metrics.metrics_query(tables, ("mrr", "invoice_count", "active_subscriptions", "subscription_mrr"), ("plan_code",), "month",
                                 {"fct_invoices_sm": F.col("is_paid"), "fct_subscriptions_sm": F.col("status") != "cancelled"})


def _metric_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {n: _metric(*spec) for n, spec in METRIC_QUERIES.items()}
    out["metric_total_events_filled"] = _events_filled
    out["metrics_by_plan"] = _metrics_by_plan
    return out


# ---------------------------------------------------------------- data quality
def _dirty(spark: SparkSession, sf_dir: str, table: str) -> Warehouse:
    """The warehouse over raw tables with faults in one of them."""
    cfg = _cfg()
    return Warehouse(spark, batches.dirty(_wh(spark, sf_dir).raw, table, cfg.load_ts), cfg)


def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _dirty(spark, sf_dir, "customers")
    out = None
    for layer in ("raw", "stg"):
        for table, col in quality.UNIQUE_CHECKS:
            df = w.raw[table] if layer == "raw" else w.t("stg_" + table)
            v = quality.unique(df, col).select(
                F.lit(f"{layer}.{table}.{col}").alias("check_name"),
                F.col(col).cast("string").alias("key_value"), "n_records")
            out = v if out is None else out.unionByName(v)
    return out


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _wh(spark, sf_dir)
    out = None
    for layer, checks in (("raw", quality.NOT_NULL_SOURCE), ("stg", quality.NOT_NULL_STAGING)):
        for table, cols in checks.items():
            df = w.raw[table] if layer == "raw" else w.t("stg_" + table)
            v = quality.not_null_counts(df, cols, f"{layer}.{table}")
            out = v if out is None else out.unionByName(v)
    return out


DQ_FUTURE_AS_OF = dt.datetime(2001, 1, 15)


def _dq_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    c = _cfg()

    def q(fn):
        return lambda spark, sf_dir: fn(_wh(spark, sf_dir))

    def faulty(table, fn):
        return lambda spark, sf_dir: fn(_dirty(spark, sf_dir, table))

    return {
        "dq_unique": _dq_unique,
        "dq_not_null": _dq_not_null,
        "dq_accepted_values": faulty("subscriptions", lambda w: quality.accepted_values(
            w.t("stg_subscriptions"), "status", quality.ACCEPTED_STATUS)),
        "dq_relationships": q(lambda w: quality.relationships(
            w.t("stg_subscriptions"), "customer_id", w.t("stg_customers"), "customer_id")
            .select("subscription_id", "customer_id")),
        "dq_future_events": q(lambda w: quality.events_not_in_future(w.t("stg_events"), DQ_FUTURE_AS_OF)),
        "dq_mrr_non_negative": faulty("invoices", lambda w: quality.mrr_non_negative(w.t("fct_invoices"))),
        "dq_orphan_subscriptions": q(lambda w: quality.no_orphan_subscriptions(
            w.t("fct_subscriptions"), w.t("dim_customer").filter(F.col("customer_id").cast("bigint") % 10 != 3))),
        "dq_freshness": faulty("products", lambda w: quality.freshness(w.raw, c.load_ts)),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: _graph(n) for n in GRAPH_TABLES}
    out.update(_sub_operators())
    out.update(_batch_queries())
    out.update(_metric_queries())
    out.update(_dq_queries())
    if llm:
        out.update(llm.QUERIES)
    if corpus_pipeline:
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    names = GRAPH_TABLES + list(_sub_operators()) + list(_batch_queries()) + list(_metric_queries()) \
        + list(_dq_queries())
    out = {n: duck.dirty_table(n, duck.DIRTY[n]) if n in duck.DIRTY else duck.table(n) for n in names}
    out["obt_customer_months"] = duck.sql("select * exclude (customer_sk) from obt_customer_months")
    if llm:
        out.update(llm.ORACLE_SQL)
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
