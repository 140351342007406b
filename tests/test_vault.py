import datetime as dt
import tempfile

from pyspark.sql import functions as F

from ledgerline.operators import staging, vault
from ledgerline.plans.warehouse import load_vault
from ledgerline.sources.fixtures import raw_tables
from ledgerline.sources.store import TableStore

from conftest import SF_SMALL
from test_store import scanned

T1, T2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1)


def stg(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, email string, customer_name string, "
                                       "first_name string, last_name string, country_code string, "
                                       "company_name string, customer_segment string, "
                                       "acquisition_channel string, created_at timestamp_ntz, "
                                       "updated_at timestamp_ntz")


def row(k, seg):
    return (k, f"{k}@x", "n", "f", "l", "US", "C", seg, "paid", T1, T1)


def test_hub_second_run_adds_only_new_keys(spark):
    spec = vault.HUBS["hub_customer"]
    h1 = vault.load_hub(stg(spark, [row("1", "a"), row("1", "a"), row("2", "a")]), spec, T1)
    assert h1.count() == 2                                  # deduplicated within the batch
    new = vault.load_hub(stg(spark, [row("2", "a"), row("3", "a")]), spec, T2, h1)
    assert [(r.customer_bk, r.load_date) for r in new.collect()] == [("3", T2)]


def test_satellite_compares_with_latest_row(spark):
    spec = vault.SATELLITES["sat_customer_details"]
    s1 = vault.load_satellite(stg(spark, [row("1", "a")]), spec, T1)
    changed = stg(spark, [row("1", "b")])
    s2 = s1.unionByName(vault.load_satellite(changed, spec, T2, s1))
    assert s2.count() == 2
    # the same extract again adds nothing (the open row is the latest one)
    assert vault.load_satellite(changed, spec, dt.datetime(2001, 3, 1), s2).count() == 0
    hist = sorted((r.customer_segment, r.load_end_date) for r in vault.with_end_dates(s2).collect())
    assert hist == [("a", T2), ("b", None)]
    cur = vault.current_rows(s2).collect()
    assert [r.customer_segment for r in cur] == ["b"]


def test_a_small_increment_reads_a_small_share_of_the_stored_tables(spark):
    raw = raw_tables(spark, SF_SMALL)["events"]
    store = TableStore(spark, tempfile.mkdtemp(prefix="ll-vault-") + "/wh")
    old, new = raw.where(F.col("event_id") > 3), raw.where(F.col("event_id") <= 3)
    for name in ("hub_event", "lnk_subscription_event", "sat_event_details"):
        load_vault(store, name, staging.stg_events(old), T1)
        stored = store.read("raw_vault", name)
        n = stored.count()
        spec = vault.HUBS.get(name) or vault.LINKS.get(name) or vault.SATELLITES[name]
        load = vault.load_hub if name in vault.HUBS else vault.load_link if name in vault.LINKS else vault.load_satellite
        rows = vault.with_key_part(load(staging.stg_events(new), spec, T2), 1)
        pruned = vault.stored_part(stored, rows)
        assert scanned(pruned) <= n * 0.4                  # at most 4 of 16 key partitions
        assert "key_part" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
        load_vault(store, name, staging.stg_events(new), T2)
        load_vault(store, name, staging.stg_events(new), T2)                  # the same load again
        got = store.read("raw_vault", name)
        assert got.count() == got.select("hash_key").distinct().count() == load(staging.stg_events(raw), spec, T1).count()
        added = got.where(F.col("load_date") == F.lit(T2)).count()
        assert 0 < added <= 4 and got.count() == n + added


def test_a_repeated_satellite_load_replaces_its_rows(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="ll-sat-") + "/wh")
    for rows, ts in (([row("1", "a"), row("2", "a")], T1), ([row("1", "b"), row("2", "a")], T2), ([row("1", "c"), row("2", "a")], T2)):
        load_vault(store, "sat_customer_details", stg(spark, rows), ts)
    got = sorted((r.customer_segment, r.load_date) for r in store.read("raw_vault", "sat_customer_details").collect())
    assert got == [("a", T1), ("a", T1), ("c", T2)]
