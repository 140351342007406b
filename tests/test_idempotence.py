"""Retried work must not duplicate: lookup keys for NULL ids, re-run micro-batches."""
import datetime as dt
import tempfile

from ledgerline.config import Config
from ledgerline.operators.facts import lookup_key
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources.store import TableStore
from ledgerline.streaming import incremental

from conftest import SF_SMALL


def test_lookup_key_never_matches_for_null_ids(spark):
    facts = spark.createDataFrame([("e1", "s1"), ("e2", None), ("e3", None)], "event_id string, sid string")
    dim = spark.createDataFrame([("s1", "K1"), ("\x00null:e2x", "BAD")], "sid_d string, sk string")
    j = facts.join(dim, lookup_key("sid", "event_id") == dim.sid_d, "left")
    assert sorted((r.event_id, r.sk) for r in j.collect()) == [("e1", "K1"), ("e2", None), ("e3", None)]


def test_vault_sink_rerun_appends_nothing(spark):
    w = Warehouse.from_testdata(spark, SF_SMALL, Config.fixtures())
    store = TableStore(spark, tempfile.mkdtemp(prefix="ll-idem-") + "/wh")
    sink = incremental.vault_sink(store, "customers", lambda i: dt.datetime(2001, 8, 1))
    batch = w.raw["customers"]
    sink(batch, 0)
    counts = {t: store.read("raw_vault", t).count() for t in ("hub_customer", "sat_customer_details")}
    sink(batch, 0)                                   # the same micro-batch retried
    assert {t: store.read("raw_vault", t).count() for t in counts} == counts
    assert counts["hub_customer"] == w.t("hub_customer").count()
