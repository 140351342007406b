"""Incremental loads as Structured Streaming micro-batches.

The reference loads incrementally with a high-water mark on
``_loaded_at``.  Here a file-source stream over the landed raw parquet
files replaces the mark: the stream's checkpoint records which files were
processed, so a batch is never skipped because an older file arrived late
(the strict ``>`` mark would skip it for good).

Every micro-batch runs the *same* table functions as a batch build:

* ``vault_sink``   hubs / links / satellites of one entity -- new rows are
  anti-joined (or digest-compared) against the stored partitions of their keys;
  hubs and links append, satellites merge on (hash_key, load_date).  Re-running a
  batch after a failure adds nothing twice.
* ``fact_sink``    a fact increment merged on its unique key, rewriting only
  the months it touches (``TableStore.merge``), into the same table
  that a batch run keeps; idempotent as well.

``daily_active_users`` is a watermarked event-time aggregate (chained
windowed aggregations, append mode): distinct customers per day, emitted
once the watermark passes the day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import facts, staging
from ..plans.warehouse import FACTS, PARTITION, load_vault
from ..sources.raw import read_raw_stream
from ..sources.store import TableStore

VAULT_TABLES_OF = {
    "customers": ["hub_customer", "sat_customer_details"],
    "subscriptions": ["hub_subscription", "lnk_customer_subscription", "lnk_subscription_product", "sat_subscription_details"],
    "products": ["hub_product", "sat_product_details"],
    "events": ["hub_event", "lnk_subscription_event", "sat_event_details"],
}


def vault_sink(store: TableStore, entity: str,
               load_ts: Callable[[int], dt.datetime], key_digits: int = 1) -> Callable[[DataFrame, int], None]:
    """foreachBatch function loading one entity's vault tables from a raw batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        stg = staging.STAGERS[entity](batch)
        for name in VAULT_TABLES_OF[entity]:
            load_vault(store, name, stg, load_ts(batch_id), key_digits)
    return run


def fact_sink(store: TableStore, fact: str, lookups: dict[str, DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function merging a fact increment into the stored fact.

    ``lookups`` holds the dimension frames the fact needs (``customer_keys``,
    ``subscription_keys``, ``dim_product``, ``dim_plan``, ``event_types``).
    """
    entity = FACTS[fact][0]

    def run(batch: DataFrame, batch_id: int) -> None:
        stg = staging.STAGERS[entity](batch)
        if fact == "fct_events":
            inc = facts.fct_events(stg, lookups["event_types"], lookups["customer_keys"],
                                   lookups["subscription_keys"])
        elif fact == "fct_invoices":
            inc = facts.fct_invoices(stg, lookups["customer_keys"], lookups["subscription_keys"],
                                     lookups["dim_plan"])
        else:
            inc = facts.fct_subscriptions(stg, lookups["customer_keys"], lookups["dim_product"],
                                          lookups["dim_plan"])
        _, key, date_col = FACTS[fact]
        store.merge("facts", fact, inc.withColumn(PARTITION, F.trunc(F.col(date_col), "month")), [key], [PARTITION])
    return run


def start(spark: SparkSession, landing_dir: str, entity: str, sink: Callable[[DataFrame, int], None],
          checkpoint: str, available_now: bool = True,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream one landed raw table through ``sink`` (a foreachBatch function)."""
    src = read_raw_stream(spark, landing_dir, entity, max_files_per_trigger)
    w = src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_active_users(events: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Distinct customers per event day of a (streaming) raw events frame.

    Two chained windowed aggregations: per (day, customer), then per day.
    State is bounded by the watermark; rows later than the watermark are
    dropped, as in any watermarked aggregation.
    """
    # watermarks need TIMESTAMP (session time zone), not TIMESTAMP_NTZ
    timed = events.withColumn("event_time", F.col("occurred_at").cast("timestamp"))
    per_customer = (timed.withWatermark("event_time", watermark)
                    .groupBy(F.window("event_time", "1 day").alias("day_window"), "customer_id")
                    .agg(F.count(F.lit(1)).alias("events")))
    return (per_customer
            .groupBy(F.window(F.window_time("day_window"), "1 day").alias("day_window"))
            .agg(F.count(F.lit(1)).alias("dau"), F.sum("events").alias("total_events"))
            .select(F.col("day_window.start").cast("date").alias("event_date"), "dau", "total_events"))

