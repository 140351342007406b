"""The warehouse as a graph of table functions.

``Warehouse.t(name)`` returns any table of the dependency graph as a lazy
DataFrame built from the raw tables (one full build: first vault load,
first snapshot run).  ``run`` writes the same graph through a ``TableStore`` in
the order of its dependencies: reference tables, vault, snapshots, business
vault, dimensions, facts, marts.  Each table is written once and later ones read
the written files, which cuts lineage and lets a lost executor recompute at
most one table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import (business, churn, cohorts, dimensions, facts, obt,
                         quality, revenue, scd2, staging, usage, vault)
from ..sources import seeds
from ..sources.fixtures import raw_tables
from ..session import materialize
from ..sources.merging import newer_than
from ..sources.store import TableStore

VAULT_TABLES = list(vault.HUBS) + list(vault.LINKS) + list(vault.SATELLITES)
VAULT_SOURCE = {**vault.HUB_SOURCE, **vault.LINK_SOURCE, **vault.SATELLITE_SOURCE}


class Warehouse:
    """Lazy full build of every table from raw DataFrames.

    ``tables`` pre-seeds the graph with already-built tables (e.g. read
    back from a store); everything else is derived on first use.
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], cfg: Config,
                 tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.raw = raw
        self.cfg = cfg
        self._tables: dict[str, DataFrame] = dict(tables or {})

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> "Warehouse":
        return cls(spark, raw_tables(spark, sf_dir), cfg or Config.fixtures())

    def t(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._build(name)
        return self._tables[name]

    def put(self, name: str, df: DataFrame) -> None:
        self._tables[name] = df

    def _build(self, name: str) -> DataFrame:
        cfg, t = self.cfg, self.t
        if name.startswith("stg_"):
            entity = name[4:]
            return staging.STAGERS[entity](self.raw[entity])
        if name in vault.HUBS:
            return vault.load_hub(t("stg_" + VAULT_SOURCE[name]), vault.HUBS[name], cfg.load_ts)
        if name in vault.LINKS:
            return vault.load_link(t("stg_" + VAULT_SOURCE[name]), vault.LINKS[name], cfg.load_ts)
        if name in vault.SATELLITES:
            return vault.load_satellite(t("stg_" + VAULT_SOURCE[name]), vault.SATELLITES[name], cfg.load_ts)
        builders = {
            "event_types": lambda: seeds.event_types(self.spark),
            "plan_tiers": lambda: seeds.plan_tiers(self.spark),
            "snp_customers": lambda: scd2.snp_customers(None, t("stg_customers"), cfg.load_ts),
            "snp_subscriptions": lambda: scd2.snp_subscriptions(None, t("stg_subscriptions"), cfg.load_ts),
            "dim_plan": lambda: dimensions.dim_plan(t("plan_tiers")),
            "dim_product": lambda: dimensions.dim_product(t("stg_products"), t("plan_tiers")),
            "dim_date": lambda: dimensions.dim_date(self.spark, cfg.start_date, cfg.as_of,
                                                    cfg.calendar_years_ahead),
            "time_spine": lambda: dimensions.time_spine(self.spark, cfg.start_date, cfg.as_of,
                                                        cfg.calendar_years_ahead),
            "bv_customer_lifetime": lambda: business.bv_customer_lifetime(
                t("hub_customer"), t("sat_customer_details"), t("hub_subscription"),
                t("sat_subscription_details"), t("lnk_customer_subscription"),
                t("stg_invoices"), cfg.as_of, cfg.load_ts),
            "bv_subscription_health": lambda: business.bv_subscription_health(
                t("hub_subscription"), t("sat_subscription_details"), t("lnk_customer_subscription"),
                t("lnk_subscription_product"), t("stg_invoices"), cfg.as_of, cfg.load_ts),
            "dim_customer": lambda: dimensions.dim_customer(t("snp_customers"), t("bv_customer_lifetime")),
            "dim_subscription": lambda: dimensions.dim_subscription(t("snp_subscriptions"),
                                                                    t("bv_subscription_health")),
            "customer_keys": lambda: dimensions.customer_keys(t("snp_customers")),
            "subscription_keys": lambda: dimensions.subscription_keys(t("snp_subscriptions")),
            "fct_events": lambda: facts.fct_events(t("stg_events"), t("event_types"),
                                                   t("customer_keys"), t("subscription_keys")),
            "fct_invoices": lambda: facts.fct_invoices(t("stg_invoices"), t("customer_keys"),
                                                       t("subscription_keys"), t("dim_plan")),
            "fct_subscriptions": lambda: facts.fct_subscriptions(t("stg_subscriptions"), t("customer_keys"),
                                                                 t("dim_product"), t("dim_plan")),
            "mart_revenue": lambda: revenue.mart_revenue(t("fct_invoices")),
            "mart_churn": lambda: churn.mart_churn(t("fct_subscriptions"), cfg.as_of,
                                                   cfg.churn_years_back, cfg.start_date),
            "mart_usage": lambda: usage.mart_usage(t("fct_events"), cfg.as_of, cfg.usage_years_back),
            "obt_saas_metrics": lambda: obt.obt_saas_metrics(t("dim_customer"), t("fct_invoices"),
                                                             t("fct_events"), t("fct_subscriptions"),
                                                             cfg.start_date, cfg.as_of),
            "cohort_retention": lambda: cohorts.cohort_retention(t("fct_invoices"), t("dim_customer"),
                                                                 cfg.cohort_max_months),
        }
        if name not in builders:
            raise KeyError(f"unknown table {name}")
        return builders[name]()


# Tables per level with their layer.
REFERENCE_TABLES = [("ref_data", "dim_plan"), ("dimensions", "dim_product"), ("dimensions", "dim_date")]
SNAPSHOTS = {"snp_customers": ("customers", scd2.snp_customers),
             "snp_subscriptions": ("subscriptions", scd2.snp_subscriptions)}
FACTS = {  # name: (source entity, unique key, the date of its month partition, which never changes for a key)
    "fct_events": ("events", "event_sk", "event_date_key"),
    "fct_invoices": ("invoices", "invoice_sk", "invoice_date_key"),
    "fct_subscriptions": ("subscriptions", "subscription_event_sk", "updated_at"),
}
PARTITION, LOAD_MONTH = "partition_month", "load_month"
# The order in which published results are read (descending: "-").
READING_ORDER = {
    "mart_revenue": ("-revenue_month", "-tier_level"),
    "mart_churn": ("-report_month", "plan_code"),
    "mart_usage": ("-event_date",),
    "cohort_retention": ("cohort_month", "months_since_acquisition"),
}
MARTS = ["mart_revenue", "mart_churn", "mart_usage", "obt_saas_metrics", "cohort_retention"]


def in_reading_order(name: str, df: DataFrame) -> DataFrame:
    """A published result sorted for its readers; stored tables are not sorted."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in READING_ORDER.get(name, ())]
    return df.orderBy(*order) if order else df


def load_vault(store: TableStore, name: str, stg: DataFrame, load_ts: dt.datetime, key_digits: int = 1) -> None:
    """Load the rows of one staged extract or increment into a stored vault table.

    Hubs and links append new keys; a satellite merges changed rows on (hash_key,
    load_date).  After the first load the extract's rows are written once, and of
    the stored table only the partitions that they fall into are read.
    """
    by = [vault.KEY_PART] + ([LOAD_MONTH] if name in vault.SATELLITES else [])
    if name in vault.SATELLITES:
        if store.read("raw_vault", name) is not None:
            store.finish("raw_vault", name)
        rows = vault.load_satellite(stg, vault.SATELLITES[name], load_ts).withColumn(LOAD_MONTH, F.trunc("load_date", "month"))
    else:
        rows = (vault.load_hub(stg, vault.HUBS[name], load_ts) if name in vault.HUBS
                else vault.load_link(stg, vault.LINKS[name], load_ts))
    rows = vault.with_key_part(rows, key_digits)
    stored = store.read("raw_vault", name)
    if stored is None:
        store.write("raw_vault", name, rows, by)
        return
    rows = materialize(rows, f"{name}-extract")
    stored = vault.stored_part(stored, rows)
    if name in vault.SATELLITES:
        store.merge("raw_vault", name, vault.changed(rows, stored), ["hash_key", "load_date"], by, mark_col=None)
    else:
        store.append("raw_vault", name, vault.not_stored(rows, stored), by)


def fact_rows(wh: Warehouse, name: str, mark: dt.datetime | None, store: TableStore | None = None) -> DataFrame:
    """A fact's rows loaded after ``mark``, with their month partition.  With the ``store`` of
    their merge, invoices are written between the lookups (``TableStore.steps``)."""
    t = wh.t
    step = {"step": store.steps("facts", name)} if store else {}
    if name == "fct_events":
        rows = facts.fct_events(t("stg_events"), t("event_types"), t("customer_keys"), t("subscription_keys"), mark)
    elif name == "fct_invoices":
        rows = facts.fct_invoices(t("stg_invoices"), t("customer_keys"), t("subscription_keys"), t("dim_plan"), mark, **step)
    else:
        rows = facts.fct_subscriptions(t("stg_subscriptions"), t("customer_keys"), t("dim_product"), t("dim_plan"), mark)
    return rows.withColumn(PARTITION, F.trunc(F.col(FACTS[name][2]), "month"))


CLOSED_RUN = "closed_run"


def snapshot_run(store: TableStore, name: str, fn, stg: DataFrame, run_ts: dt.datetime) -> None:
    """Merge one extract into a stored snapshot.

    Open versions are a table of their own, which a run reads and replaces; those
    that it closes are added to the closed ones, as a partition of the run's own.
    """
    store.finish("snapshots", f"{name}_open")
    current = store.read("snapshots", f"{name}_open")
    step = fn(current, stg, run_ts)
    if current is None:
        store.write("snapshots", f"{name}_open", step)
        return
    step = step.withColumn(CLOSED_RUN, F.when(F.col("dbt_valid_to").isNotNull(), F.lit(f"run-{uuid.uuid4().hex}")))
    store.overwrite("snapshots", step, {f"{name}_open": (f"{CLOSED_RUN} is null", [], True),
                                        f"{name}_closed": (f"{CLOSED_RUN} is not null", [CLOSED_RUN], False)})


def read_snapshot(store: TableStore, name: str) -> DataFrame | None:
    """All versions of a stored snapshot."""
    current, closed = (store.read("snapshots", f"{name}_{part}") for part in ("open", "closed"))
    if current is None or closed is None:
        return None if current is None else current.drop(CLOSED_RUN)
    return current.drop(CLOSED_RUN).unionByName(closed.drop(CLOSED_RUN))


def check_results(wh: Warehouse, counted: list[tuple[str, int]]) -> DataFrame:
    """``(check_name, violations)`` of every data-quality check on the built tables:
    those counted while the tables were written, and those that need a join or a group."""
    out = wh.spark.createDataFrame(counted, "check_name string, violations bigint").coalesce(1)
    found = []
    for layer in ("raw", "stg"):
        for n, c in quality.UNIQUE_CHECKS:
            found.append((f"unique.{layer}.{n}.{c}", quality.unique(wh.raw[n] if layer == "raw" else wh.t("stg_" + n), c)))
    found += [
        ("relationships.subscriptions.customer_id", quality.relationships(
            wh.t("stg_subscriptions"), "customer_id", wh.t("stg_customers"), "customer_id")),
        ("no_orphan_subscriptions", quality.no_orphan_subscriptions(wh.t("fct_subscriptions"), wh.t("dim_customer")))]
    for name, rows in found:
        out = out.unionByName(rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations"))
    return out


def together(*writes: Callable[[], None]) -> None:
    """Writes that don't read each other, submitted as concurrent Spark jobs."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda write: write(), writes))


def run(spark: SparkSession, raw: dict[str, DataFrame], cfg: Config, root: str, stop_on_violation: bool = False) -> dict[str, str]:
    """One warehouse run against the store at ``root`` (first run = full build).

    * reference tables, business vault, dimensions and marts are rebuilt;
    * hubs and links append the keys new in this extract, satellites the changed
      rows, each reading the stored partitions of its own keys only;
    * snapshots merge the extract into their history (SCD2);
    * facts load the rows after their high-water mark and merge them on
      their unique key, rewriting only the touched month partitions
      (``partition_month``; a month filter on a fact prunes files);
    * the data-quality checks are counted, those of single rows on the rows that this
      run reads while it writes them: the counts of violations are stored as
      ``check_results``, and with ``stop_on_violation`` any violation raises.

    Events are append-only: their vault tables look only at rows loaded after the
    last run's mark.  The other entities deliver full extracts.
    """
    store = TableStore(spark, root)
    wh = Warehouse(spark, raw, cfg)
    checks = quality.BuildChecks(cfg.load_ts)
    written: dict[str, str] = {}

    def done(layer: str, name: str) -> None:
        stored = store.read(layer, name)           # a partitioned table without rows has no files
        wh.put(name, wh.t(name).limit(0) if stored is None else stored.drop(vault.KEY_PART, LOAD_MONTH))
        written[name] = store.table_path(layer, name)

    def rebuild(*tables: tuple[str, str]) -> None:
        together(*[lambda l=layer, n=name, df=wh.t(name): store.write(l, n, df) for layer, name in tables])
        for layer, name in tables:
            done(layer, name)

    rebuild(*REFERENCE_TABLES)

    events = newer_than(raw["events"], store.mark("raw_vault", "events"))
    mark = events.agg(F.max("_loaded_at")).first()[0]
    loads = []
    for name in VAULT_TABLES:
        entity = VAULT_SOURCE[name]
        src = events if entity == "events" else raw[entity]
        if entity == "events" and mark is None and store.read("raw_vault", name) is not None:
            if name in vault.SATELLITES:
                checks.skipped(entity)
            continue
        stg = staging.STAGERS[entity](src)
        if name in vault.SATELLITES:          # reads every row and column of its entity once: the checks ride on it
            stg = checks.stg(entity, staging.STAGERS[entity](checks.raw(entity, src)))
        loads.append(lambda n=name, df=stg: load_vault(store, n, df, cfg.load_ts, cfg.vault_key_digits))
    together(*loads)
    for name in VAULT_TABLES:
        done("raw_vault", name)
    store.set_mark("raw_vault", "events", mark)

    together(*[lambda n=name, f=fn, df=wh.t("stg_" + entity): snapshot_run(store, n, f, df, cfg.load_ts) for name, (entity, fn) in SNAPSHOTS.items()])
    for name in SNAPSHOTS:
        wh.put(name, read_snapshot(store, name))
        written[name] = store.table_path("snapshots", f"{name}_open")
    rebuild(("business_vault", "bv_customer_lifetime"), ("business_vault", "bv_subscription_health"))
    rebuild(("dimensions", "dim_customer"), ("dimensions", "dim_subscription"))

    lazy, merges = wh.t("stg_invoices"), []
    for name, (entity, key, _) in FACTS.items():
        if entity == "invoices":                # its only table: the checks of its staging ride on the fact
            new = newer_than(raw["invoices"], store.mark("facts", name))
            wh.put("stg_invoices", checks.stg("invoices", staging.stg_invoices(checks.raw("invoices", new))))
            rows = checks.invoices(fact_rows(wh, name, None))
            wh.put("stg_invoices", lazy)
        else:
            rows = fact_rows(wh, name, store.mark("facts", name))
        merges.append(lambda n=name, df=rows, k=key: store.merge("facts", n, df, [k], [PARTITION]))
    together(*merges)
    for name in FACTS:
        done("facts", name)
    rebuild(*[("marts", name) for name in MARTS])
    store.write("marts", "check_results", check_results(wh, checks.counts()))
    written["check_results"] = store.table_path("marts", "check_results")
    if stop_on_violation:
        bad = store.read("marts", "check_results").where("violations > 0").orderBy("check_name").collect()
        if bad:
            raise RuntimeError("data checks failed: " + ", ".join(f"{r.check_name} ({r.violations})" for r in bad))
    return written
