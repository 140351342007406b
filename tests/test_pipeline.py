"""Materialised runs: a first run, then an incremental run on a larger extract."""
import dataclasses
import datetime as dt
import tempfile

import pytest

from ledgerline.config import Config
from ledgerline.plans import batches
from ledgerline.operators import quality
from ledgerline.plans.warehouse import FACTS, Warehouse, in_reading_order, read_snapshot, run
from ledgerline.sources.fixtures import raw_tables
from ledgerline.sources.store import TableStore

from ledgerline.session import ensure_checkpoint_dir

from conftest import SF_SMALL


def test_incremental_run_equals_full_build(spark):
    raw = raw_tables(spark, SF_SMALL)
    cfg1 = Config.fixtures()
    cfg2 = dataclasses.replace(cfg1, load_ts=dt.datetime(2001, 8, 2))
    first = dict(raw, events=batches.events_batch(raw["events"], 1),  # the rest arrives with the second run
                 invoices=batches.invoices_batch(raw["invoices"], 1))
    root = tempfile.mkdtemp(prefix="ll-run-") + "/wh"
    run(spark, first, cfg1, root)
    out = run(spark, raw, cfg2, root)
    full = Warehouse(spark, raw, cfg1)           # same dimension versions as the first run
    store = TableStore(spark, root)
    for name in FACTS:
        got = store.read("facts", name).drop("partition_month")
        want = full.t(name).select(got.columns)
        assert got.count() == want.count(), name
        assert got.exceptAll(want).count() == 0, name
    # unchanged customers: no new vault rows, no new snapshot versions
    for name in ("hub_customer", "sat_customer_details"):
        assert store.read("raw_vault", name).count() == full.t(name).count(), name
    assert read_snapshot(store, "snp_customers").count() == full.t("snp_customers").count()
    # events hub: keys of the second extract added once
    for name in ("hub_event", "lnk_subscription_event", "sat_event_details"):
        assert store.read("raw_vault", name).count() == full.t(name).count(), name
    assert store.read("marts", "mart_usage").count() == full.t("mart_usage").count()
    checks = {r.check_name: r.violations for r in spark.read.parquet(out["check_results"]).collect()}
    assert checks["unique.stg.events.event_id"] == 0 and checks["relationships.subscriptions.customer_id"] > 0


def test_checks_of_a_build_equal_separate_checks(spark):
    cfg = Config.fixtures()
    raw = raw_tables(spark, SF_SMALL)
    raw = dict(batches.dirty(batches.dirty(raw, "subscriptions", cfg.load_ts), "invoices", cfg.load_ts))
    out = run(spark, raw, cfg, tempfile.mkdtemp(prefix="ll-checks-") + "/wh")
    got = {r.check_name: r.violations for r in spark.read.parquet(out["check_results"]).collect()}
    w = Warehouse(spark, raw, cfg)
    want = {}
    for layer, checks in (("raw", quality.NOT_NULL_SOURCE), ("stg", quality.NOT_NULL_STAGING)):
        for table, cols in checks.items():
            df = w.raw[table] if layer == "raw" else w.t("stg_" + table)
            want |= {f"not_null.{layer}.{table}.{r.column_name}": r.null_count for r in quality.not_null_counts(df, cols, table).collect()}
            want |= {f"unique.{layer}.{table}.{c}": quality.unique(df, c).count() for t, c in quality.UNIQUE_CHECKS if t == table}
    want["accepted_values.subscriptions.status"] = quality.accepted_values(w.t("stg_subscriptions"), "status", quality.ACCEPTED_STATUS).count()
    want["relationships.subscriptions.customer_id"] = quality.relationships(w.t("stg_subscriptions"), "customer_id", w.t("stg_customers"), "customer_id").count()
    want["events_not_in_future"] = quality.events_not_in_future(w.t("stg_events"), cfg.load_ts).count()
    want["mrr_non_negative"] = quality.mrr_non_negative(w.t("fct_invoices")).count()
    want["no_orphan_subscriptions"] = quality.no_orphan_subscriptions(w.t("fct_subscriptions"), w.t("dim_customer")).count()
    assert got == want and got["accepted_values.subscriptions.status"] == 1 and got["mrr_non_negative"] > 0


def test_a_run_over_empty_tables(spark):
    raw = {n: df.limit(0) for n, df in raw_tables(spark, SF_SMALL).items()}
    root = tempfile.mkdtemp(prefix="ll-empty-") + "/wh"
    for day in (1, 2):
        out = run(spark, raw, dataclasses.replace(Config.fixtures(), load_ts=dt.datetime(2001, 8, day)), root)
    assert spark.read.parquet(out["mart_usage"]).count() == 0
    assert spark.read.parquet(out["check_results"]).where("violations > 0").count() == 0
    run(spark, raw_tables(spark, SF_SMALL), dataclasses.replace(Config.fixtures(), load_ts=dt.datetime(2001, 8, 3)), root)
    assert TableStore(spark, root).read("facts", "fct_events").count() == raw_tables(spark, SF_SMALL)["events"].count()


def test_reading_order(spark):
    df = spark.createDataFrame([(1, "b"), (2, "b"), (2, "a")], "report_month int, plan_code string")
    assert [tuple(r) for r in in_reading_order("mart_churn", df).collect()] == [(2, "a"), (2, "b"), (1, "b")]
    assert in_reading_order("other", df) is df


def test_run_times_are_required():
    with pytest.raises(TypeError):
        Config()


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("Context", (), {"master": "yarn"})()
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_violations_stop_a_run(spark):
    raw = raw_tables(spark, SF_SMALL)
    with pytest.raises(RuntimeError, match="relationships.subscriptions.customer_id"):
        run(spark, raw, Config.fixtures(), tempfile.mkdtemp(prefix="ll-strict-") + "/wh", stop_on_violation=True)
