"""HB*, LK*, SA*: Data Vault hubs, links and satellites.

Three generic loaders plus the per-entity declarations.  Each loader is
``(staged source, optional current target, load_ts) -> new rows``; the
caller appends the result (``sources.store``).  With ``target=None`` it is
the first load.

Scale notes
* Hubs/links deduplicate on ``hash_key`` (partial aggregation map-side)
  and anti-join the target on the same key; one column of the target is read.
  Append-only entities (events) hand in only the rows newer than the target's
  load mark (``sources.merging.newer_than``).
* Stored tables are partitioned by the head of the hash key (``key_part``); a load
  reads the partitions of its own keys only (``stored_part``), so a small increment
  reads a small share of a long history.
* Satellites reduce a batch to one row per key and compare it with the *latest*
  stored row per key, a per-key aggregate joined once -- not with every row of
  an open end date, which re-inserts changed keys on every run.  Rows are
  unique per (hash_key, load_date): a load repeated with the same time
  replaces its rows (``merge_satellite``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_ts
from ..functions.keys import hash_key, hash_text, hashdiff
from ..sources.merging import latest_per_key, upsert
from ..sources.store import one_of


KEY_PART = "key_part"


def with_key_part(rows: DataFrame, digits: int) -> DataFrame:
    """Rows with their partition, the first hex digits of the hash key."""
    return rows.withColumn(KEY_PART, F.concat(F.lit("k"), F.substring("hash_key", 1, digits)))


def stored_part(stored: DataFrame | None, rows: DataFrame) -> DataFrame | None:
    """The stored rows in the partitions of ``rows``; their names, 16 to the power of
    the digits at most, go to the driver, so the scan is pruned before it starts."""
    if stored is None:
        return None
    return stored.where(one_of(KEY_PART, [r[0] for r in rows.select(KEY_PART).distinct().collect()]))


def not_stored(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Rows of keys that the stored table doesn't have."""
    return rows if stored is None else rows.join(stored.select("hash_key"), "hash_key", "left_anti").select(rows.columns)


# ---------------------------------------------------------------- hubs
@dataclass(frozen=True)
class HubSpec:
    name: str
    business_key: str      # column of the staged source
    bk_column: str         # output column name
    record_source: str


def load_hub(src: DataFrame, spec: HubSpec, load_ts: dt.datetime,
             target: DataFrame | None = None) -> DataFrame:
    """HB0: one row per new business key."""
    rows = (src.select(
                hash_key(spec.business_key).alias("hash_key"),
                F.col(spec.business_key).alias(spec.bk_column),
                lit_ts(load_ts).alias("load_date"),
                F.lit(spec.record_source).alias("record_source"))
            .dropDuplicates(["hash_key"]))
    return not_stored(rows, target)


# Hub declarations (business key, record source).
HUBS = {
    "hub_customer": HubSpec("hub_customer", "customer_id", "customer_bk", "CRM"),
    "hub_subscription": HubSpec("hub_subscription", "subscription_id", "subscription_bk", "CRM"),
    "hub_product": HubSpec("hub_product", "product_id", "product_bk", "PRODUCT_CATALOG"),
    "hub_event": HubSpec("hub_event", "event_id", "event_bk", "EVENT_TRACKING"),
}
HUB_SOURCE = {"hub_customer": "customers", "hub_subscription": "subscriptions",
              "hub_product": "products", "hub_event": "events"}


# ---------------------------------------------------------------- links
@dataclass(frozen=True)
class LinkSpec:
    name: str
    keys: tuple            # business key columns, in hash order
    hub_columns: tuple     # output FK column per key
    record_source: str
    require_not_null: tuple = ()


def load_link(src: DataFrame, spec: LinkSpec, load_ts: dt.datetime,
              target: DataFrame | None = None) -> DataFrame:
    """LK0: link hash of all keys plus one hub hash per key, new rows only."""
    for c in spec.require_not_null:
        src = src.filter(F.col(c).isNotNull())
    # rows are told apart by the text that the link hash is made of; they are hashed after that
    src = src.select(*spec.keys, hash_text(*spec.keys).alias("_keys")).dropDuplicates(["_keys"])
    rows = (src.select(
                hash_key(*spec.keys).alias("hash_key"),
                *[hash_key(k).alias(h) for k, h in zip(spec.keys, spec.hub_columns)],
                lit_ts(load_ts).alias("load_date"),
                F.lit(spec.record_source).alias("record_source")))
    return not_stored(rows, target)


# Link declarations.
LINKS = {
    "lnk_customer_subscription": LinkSpec(
        "lnk_customer_subscription", ("customer_id", "subscription_id"),
        ("hub_customer_hash_key", "hub_subscription_hash_key"), "CRM"),
    "lnk_subscription_product": LinkSpec(
        "lnk_subscription_product", ("subscription_id", "product_id"),
        ("hub_subscription_hash_key", "hub_product_hash_key"), "CRM"),
    "lnk_subscription_event": LinkSpec(
        "lnk_subscription_event", ("subscription_id", "event_id"),
        ("hub_subscription_hash_key", "hub_event_hash_key"), "EVENT_TRACKING",
        require_not_null=("subscription_id",)),
}
LINK_SOURCE = {"lnk_customer_subscription": "subscriptions",
               "lnk_subscription_product": "subscriptions",
               "lnk_subscription_event": "events"}


# ---------------------------------------------------------------- satellites
@dataclass(frozen=True)
class SatelliteSpec:
    name: str
    business_key: str
    diff_columns: tuple    # columns in the change digest
    attributes: tuple      # (source column, output column) in output order
    record_source: str


def satellite_rows(src: DataFrame, spec: SatelliteSpec, load_ts: dt.datetime) -> DataFrame:
    return src.select(
        "hash_key",
        lit_ts(load_ts).alias("load_date"),
        F.lit(None).cast("timestamp_ntz").alias("load_end_date"),
        hashdiff(src, spec.diff_columns).alias("hashdiff"),
        *[F.col(s).alias(o) for s, o in spec.attributes],
        F.lit(spec.record_source).alias("record_source"),
    )


def load_satellite(src: DataFrame, spec: SatelliteSpec, load_ts: dt.datetime,
                   target: DataFrame | None = None) -> DataFrame:
    """SA0: rows whose key is new or whose digest differs from the latest row.

    Rows of one key within the batch are reduced to the latest by
    ``updated_at``, else ``_loaded_at`` (ties by the other columns).
    """
    order = [c for c in ("updated_at", "_loaded_at") if c in src.columns]
    # one shuffle, by the hash: the rows' later joins and aggregates are keyed by it
    src = src.withColumn("hash_key", hash_key(spec.business_key)).drop(spec.business_key)
    return changed(satellite_rows(latest_per_key(src, ["hash_key"], order), spec, load_ts), target)


def changed(rows: DataFrame, target: DataFrame | None) -> DataFrame:
    """Satellite rows whose digest differs from the latest stored one of their key."""
    if target is None:
        return rows
    stored = (target.groupBy("hash_key").agg(F.max(F.struct("load_date", "hashdiff")).alias("t"))
              .select("hash_key", F.col("t.hashdiff").alias("_stored")))
    return (rows.join(stored, "hash_key", "left")
            .filter(F.col("_stored").isNull() | (F.col("hashdiff") != F.col("_stored")))
            .select(rows.columns))


def merge_satellite(sat: DataFrame | None, new: DataFrame) -> DataFrame:
    """``sat`` with new rows merged on (hash_key, load_date)."""
    return upsert(sat, new, ["hash_key", "load_date"])


def with_end_dates(sat: DataFrame) -> DataFrame:
    """SA5: history view -- ``load_end_date`` = next ``load_date`` of the key."""
    w = Window.partitionBy("hash_key").orderBy("load_date")
    return sat.withColumn("load_end_date", F.lead("load_date").over(w))


def current_rows(sat: DataFrame) -> DataFrame:
    """The latest satellite row per key, exactly one (ties by the other columns)."""
    return latest_per_key(sat, ["hash_key"], ["load_date"])


def _same(*names):
    return tuple((n, n) for n in names)


# Satellite declarations (digest columns and payload).
SATELLITES = {
    "sat_customer_details": SatelliteSpec(
        "sat_customer_details", "customer_id",
        ("email", "customer_name", "country_code", "company_name",
         "customer_segment", "acquisition_channel"),
        _same("email", "customer_name", "first_name", "last_name", "country_code",
              "company_name", "customer_segment", "acquisition_channel",
              "created_at", "updated_at"),
        "CRM"),
    "sat_subscription_details": SatelliteSpec(
        "sat_subscription_details", "subscription_id",
        ("status", "billing_period", "plan_code", "mrr_usd", "arr_usd",
         "start_date", "end_date"),
        _same("status", "billing_period", "plan_code", "mrr_usd", "arr_usd",
              "trial_start_date", "trial_end_date", "start_date", "end_date",
              "cancelled_at", "cancellation_reason"),
        "CRM"),
    "sat_product_details": SatelliteSpec(
        "sat_product_details", "product_id",
        ("product_name", "plan_code", "product_category", "billing_model",
         "base_price_monthly_usd", "is_active"),
        _same("product_name", "plan_code", "product_category", "billing_model",
              "base_price_monthly_usd", "base_price_annual_usd", "is_active",
              "launched_at", "deprecated_at"),
        "PRODUCT_CATALOG"),
    "sat_event_details": SatelliteSpec(
        "sat_event_details", "event_id",
        ("event_type", "event_category", "feature_name", "platform", "device_type"),
        _same("event_type", "event_category", "feature_name", "session_id",
              "device_type", "platform", "occurred_at", "event_date",
              "event_properties"),
        "EVENT_TRACKING"),
}
SATELLITE_SOURCE = {"sat_customer_details": "customers",
                    "sat_subscription_details": "subscriptions",
                    "sat_product_details": "products",
                    "sat_event_details": "events"}
