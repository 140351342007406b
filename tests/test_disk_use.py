"""What stays on disk while a query runs: findings of round 4."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.keys import packed_digest, unpacked_digest
from ledgerline.operators import refresh, revenue
from ledgerline.session import RELEASE, materialize, shuffles_released
from ledgerline.sources import store as stores
from ledgerline.sources.store import TableStore
from tests.conftest import SF_SMALL
from tests.test_moved_rows import plan, sorted_joins  # noqa: F401

JAN, FEB, MAR, APR = (dt.date(2001, m, 1) for m in (1, 2, 3, 4))
TS = dt.datetime(2001, 8, 1)
SCHEMA = "k string, v int, month date, _loaded_at timestamp_ntz"


def merge(spark, store, *rows, **more):
    store.merge("facts", "f", spark.createDataFrame([(*r, TS) for r in rows], SCHEMA), ["k"], ["month"], **more)
    return held(store)


def held(store):
    return sorted(((r.k, r.v, r.month) for r in store.read("facts", "f").collect()), key=str)


def rows_in(store, kind):
    found = store._open(f"{kind}/", "facts", "f")
    return 0 if found is None else found.count()


def test_a_write_gives_its_shuffle_files_back(spark):
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    out = materialize(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("v")), "released")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and out.count() == 7


def test_the_setting_holds_for_writes_only_and_yields_to_the_sessions_own(spark):
    with shuffles_released(spark):
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "true"
        assert spark.conf.get(RELEASE) == "true"
    assert spark.conf.get(RELEASE, None) is None
    spark.conf.set(RELEASE, "false")
    try:
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "false"
        assert spark.conf.get(RELEASE) == "false"
    finally:
        spark.conf.unset(RELEASE)


def test_digests_are_packed_and_come_back(spark):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 4, "0123456789abcdef" * 4, "0123456789ABCDEF" * 2, "UNKNOWN", "", "g" * 32, "\0" * 16, "\0" * 32, None]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed_digest("k").alias("p"))
    got = df.select("k", unpacked_digest("p").alias("u"), F.length("p").alias("n")).collect()
    assert all(r.k == r.u for r in got)
    assert [r.n for r in got if r.k in texts[:2]] == [16, 32] and df.agg(F.count_distinct("p")).first()[0] == len(texts) - 1


def test_partitions_shuffle_digests_as_bytes(spark):
    df = spark.createDataFrame([("UNKNOWN", "p"), (None, "q")], "x_sk string, part string")
    p = plan(stores.rebalanced(df, ["part"]))
    assert "unhex" in p[p.index("Exchange"):] and stores.rebalanced(df, ["part"]).schema.names == ["x_sk", "part"]


def test_new_partitions_are_added_without_a_staged_copy(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    merge(spark, store, ("a", 1, JAN), ("n", 2, None))
    monkeypatch.setattr(TableStore, "overwrite", lambda *a: pytest.fail("staged"))
    assert merge(spark, store, ("b", 3, FEB), ("c", 4, MAR)) == [("a", 1, JAN), ("b", 3, FEB), ("c", 4, MAR), ("n", 2, None)]


def test_a_merge_into_old_and_new_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    merge(spark, store, ("a", 1, JAN), ("n", 2, None), (None, 0, JAN))
    got = merge(spark, store, ("a", 9, JAN), ("n", 8, None), ("b", 3, FEB), (None, 5, JAN))
    assert got == sorted([("a", 9, JAN), ("b", 3, FEB), ("n", 8, None), (None, 0, JAN), (None, 5, JAN)], key=str)
    assert [rows_in(store, kind) for kind in ("staged", "increment")] == [0, 0]


@pytest.mark.parametrize("lost_after", [False, True])
def test_a_merge_lost_before_or_after_its_new_partitions(spark, tmp_path, monkeypatch, lost_after):
    store = TableStore(spark, str(tmp_path))
    merge(spark, store, ("a", 1, JAN))
    step = [("a", 9, JAN), ("b", 3, FEB)]
    add = TableStore.append

    def lose(self, *args):
        if lost_after:
            add(self, *args)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(TableStore, "append", lose)
        with pytest.raises(OSError):
            merge(spark, store, *step)
    assert merge(spark, store, *step) == [("a", 9, JAN), ("b", 3, FEB)]


def test_many_new_partitions_are_written_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "SLICE_ROWS", 1)
    writes, save = [], TableStore._save
    monkeypatch.setattr(TableStore, "_save", lambda self, layer, table, *a, **k: (writes.append(table), save(self, layer, table, *a, **k)))
    rows = [(f"k{i}", i, month) for i, month in enumerate([JAN, FEB, MAR, APR, None] * 3)]
    store = TableStore(spark, str(tmp_path))
    assert merge(spark, store, *rows) == sorted(rows, key=str) and len(writes) == stores.SLICES
    assert sorted(sum(stores.slices([((m,), 3) for m in (JAN, FEB, MAR, APR, None)]), []), key=str) == sorted([(m,) for m in (JAN, FEB, MAR, APR, None)], key=str)


def test_steps_hold_one_copy_until_the_increment(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    step, rows = store.steps("facts", "f"), spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for _ in range(3):
        rows = step(rows)
        assert sorted([rows_in(store, "step0"), rows_in(store, "step1")]) == [0, 2]
    assert store.increment("facts", "f", rows).count() == 2
    assert [rows_in(store, kind) for kind in ("step0", "step1", "increment")] == [0, 0, 2]


def test_stored_months_are_dealt_once_for_their_movements(sorted_joins, tmp_path, monkeypatch):  # noqa: F811
    spark, store, staged = sorted_joins, TableStore(sorted_joins, str(tmp_path)), {}
    fct = spark.createDataFrame([("c1", "s1", JAN, 10), ("c1", "s1", FEB, 15), ("c2", "s2", FEB, 1)], "customer_sk string, subscription_sk string, invoice_date date, v int").select(
        "*", F.col("invoice_date").alias("partition_month"), F.lit("PRO").alias("plan_code"), F.lit(1).alias("tier_level"),
        F.lit(True).alias("is_paid"), F.lit(False).alias("is_refunded"), F.lit(False).alias("is_failed"),
        *[F.col("v").cast(t).alias(c) for c, t in (("mrr_contribution_usd", "decimal(28,8)"), ("arr_contribution_usd", "decimal(38,2)"), ("net_amount_usd", "decimal(18,2)"))])
    store.write("facts", "fct_invoices", fct, ["partition_month"])
    keep = TableStore.stage
    monkeypatch.setattr(TableStore, "stage", lambda self, layer, name, rows: (staged.setdefault(name, plan(rows)), keep(self, layer, name, rows))[1])
    out = refresh.refresh_revenue(store, {JAN, FEB})
    assert staged[refresh.BY_PLAN].count("Exchange hashpartitioning(customer_sk") == 1
    assert sorted((r.revenue_month, int(r.expansion_mrr_usd), int(r.new_mrr_usd)) for r in out.collect()) == [(JAN, 0, 10), (FEB, 5, 1)]
    assert sorted(map(str, out.collect())) == sorted(map(str, revenue.mart_revenue(fct).select(out.columns).collect()))


def test_a_stored_invoice_load_writes_between_its_lookups(spark):
    from ledgerline.config import Config
    from ledgerline.plans.warehouse import Warehouse, fact_rows

    w, calls = Warehouse.from_testdata(spark, SF_SMALL, Config.fixtures()), []

    class Store:
        def steps(self, layer, table):
            return lambda rows: (calls.append((layer, table)), rows)[1]
    rows = fact_rows(w, "fct_invoices", None, Store())
    assert calls == [("facts", "fct_invoices")] * 2
    assert rows.columns == fact_rows(w, "fct_invoices", None).columns


def test_the_wide_table_meets_written_maps(spark):
    from ledgerline.config import Config
    from ledgerline.plans.warehouse import Warehouse

    p = plan(Warehouse.from_testdata(spark, SF_SMALL, Config.fixtures()).t("obt_saas_metrics"))
    assert "lineitem.parquet" not in p and "events.parquet" not in p
