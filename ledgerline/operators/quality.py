"""DQ1-DQ8: data-quality checks.  Each returns the violating rows
(empty DataFrame = pass), except ``not_null_counts`` and ``freshness``
which return one summary row per checked column / table.
"""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_ts


def unique(df: DataFrame, col: str) -> DataFrame:
    """DQ1: values occurring more than once (NULLs ignored).

    Nearly all values differ, so they are sorted and numbered, which spills where it must,
    and only those seen before are grouped: hash tables would hold every value, the
    map-side one in the same task as a join's sort buffers.
    """
    number = F.row_number().over(Window.partitionBy(col).orderBy(col))
    return (df.select(col).filter(F.col(col).isNotNull()).withColumn("_number", number)
            .filter(F.col("_number") > 1).groupBy(col).agg(F.max("_number").cast("bigint").alias("n_records")))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ2: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def not_null_counts(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """DQ2 in one pass: NULL count per column of one table."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(table).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) as (column_name, null_count)"))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """DQ3: distinct values outside the accepted list, with their counts (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """DQ4: child rows whose (non-NULL) key has no parent."""
    p = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    return (child.filter(F.col(col).isNotNull())
            .join(p, F.col(col) == F.col("_parent_key"), "left_anti"))


def events_not_in_future(stg_events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """DQ5."""
    return (stg_events.filter(F.col("occurred_at") > lit_ts(as_of))
            .select("event_id", "customer_id", "event_type", "occurred_at", "_loaded_at"))


def mrr_non_negative(fct_invoices: DataFrame) -> DataFrame:
    """DQ6: non-refunded invoices with negative MRR contribution."""
    return (fct_invoices.filter((F.col("mrr_contribution_usd") < 0) & (F.col("is_refunded") == F.lit(False)))
            .select("invoice_id", "customer_sk", "subscription_sk", "mrr_contribution_usd", "invoice_date"))


def no_orphan_subscriptions(fct_subscriptions: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """DQ7: subscription facts whose customer key is in no customer version."""
    dc = dim_customer.select(F.col("customer_sk").alias("_sk")).distinct()
    return (fct_subscriptions.filter(F.col("customer_sk") != "UNKNOWN")
            .join(dc, F.col("customer_sk") == F.col("_sk"), "left_anti")
            .select("subscription_id", "customer_id", "customer_sk"))


def freshness(tables: dict[str, DataFrame], as_of: dt.datetime, warn_hours: int = 12,
              error_hours: int = 24, col: str = "_loaded_at") -> DataFrame:
    """DQ8: per source, age of the newest row -> pass / warn / error."""
    out = None
    now = lit_ts(as_of)
    for name, df in tables.items():
        row = df.agg(F.max(col).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"), "max_loaded_at",
            (F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now).cast("double")
             / 3600000000.0).alias("age_hours"))
        out = row if out is None else out.unionByName(row)
    age = F.col("age_hours")
    return out.withColumn("status", F.when(age.isNull() | (age > error_hours), "error")
                          .when(age > warn_hours, "warn").otherwise("pass"))


# The declared column checks (table, column).
UNIQUE_CHECKS = [("customers", "customer_id"), ("subscriptions", "subscription_id"),
                 ("events", "event_id"), ("invoices", "invoice_id"), ("products", "product_id")]
NOT_NULL_SOURCE = {
    "customers": ["customer_id", "email", "created_at"],
    "subscriptions": ["subscription_id", "customer_id", "product_id"],
    "events": ["event_id", "customer_id", "event_type"],
    "invoices": ["invoice_id", "subscription_id"],
    "products": ["product_id"],
}
NOT_NULL_STAGING = {
    "customers": ["customer_id", "email", "customer_name", "country_code", "created_at"],
    "subscriptions": ["subscription_id", "customer_id", "product_id", "status"],
    "events": ["event_id", "customer_id", "event_type", "occurred_at"],
    "invoices": ["invoice_id", "subscription_id", "amount_usd", "invoice_date"],
    "products": ["product_id", "product_name", "plan_code"],
}
ACCEPTED_STATUS = ["active", "cancelled", "paused", "trialing", "past_due"]


class BuildChecks:
    """Row checks counted while a build writes its tables (``DataFrame.observe``).

    ``raw``, ``stg`` and ``rows`` return the frame with its checks attached; the
    counts are there when the first action on that frame, a write that reads all
    its rows, is done.  No row is read for a check alone.  ``skipped`` frames count 0.
    """

    def __init__(self, as_of: dt.datetime):
        self.as_of = as_of
        self._held: dict[str, tuple[Observation, list[str]]] = {}
        self._zero: list[str] = []

    def _checks(self, layer: str, table: str) -> dict[str, Column]:
        nulls = (NOT_NULL_SOURCE if layer == "raw" else NOT_NULL_STAGING)[table]
        out = {f"not_null.{layer}.{table}.{c}": F.count_if(F.col(c).isNull()) for c in nulls}
        if (layer, table) == ("stg", "events"):
            out["events_not_in_future"] = F.count_if(F.col("occurred_at") > lit_ts(self.as_of))
        if (layer, table) == ("stg", "subscriptions"):
            odd = F.when(~F.col("status").isin(*ACCEPTED_STATUS), F.col("status"))     # one violation a value
            out["accepted_values.subscriptions.status"] = F.size(F.collect_set(odd)).cast("bigint")
        return out

    def _observe(self, name: str, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        observation = Observation(name)
        self._held[name] = (observation, list(checks))
        return df.observe(observation, *[c.alias(f"c{i}") for i, c in enumerate(checks.values())])

    def raw(self, table: str, df: DataFrame) -> DataFrame:
        return self._observe(f"raw.{table}", df, self._checks("raw", table))

    def stg(self, table: str, df: DataFrame) -> DataFrame:
        return self._observe(f"stg.{table}", df, self._checks("stg", table))

    def invoices(self, fct_invoices: DataFrame) -> DataFrame:
        below = (F.col("mrr_contribution_usd") < 0) & (F.col("is_refunded") == F.lit(False))
        return self._observe("fct_invoices", fct_invoices, {"mrr_non_negative": F.count_if(below)})

    def skipped(self, table: str) -> None:
        self._zero += [*self._checks("raw", table), *self._checks("stg", table)]

    def counts(self) -> list[tuple[str, int]]:
        found = []
        for observation, names in self._held.values():
            try:
                values = observation.get
            except Py4JJavaError:      # Spark left an empty frame out of its plan, and the checks with it
                values = {}
            found += [(name, values.get(f"c{i}", 0)) for i, name in enumerate(names)]
        return found + [(name, 0) for name in self._zero]
