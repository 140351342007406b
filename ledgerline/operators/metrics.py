"""ME1-ME13: a small semantic layer -- models, measures, metrics.

A metric names a measure; a measure is an aggregate over a column of a
semantic model's table; a query groups by a time grain and any declared
dimensions.  ``metric_query`` returns one lazy ``groupBy().agg()``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str               # sum | count | count_distinct
    expr: str

    def column(self) -> Column:
        c = F.col(self.expr)
        if self.agg == "sum":
            return F.sum(c)
        if self.agg == "count":
            return F.count(c)
        if self.agg == "count_distinct":
            return F.count_distinct(c)
        raise ValueError(f"unknown aggregation {self.agg}")


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str             # which built table it reads
    time_dimension: str
    dimensions: tuple
    measures: tuple = field(default_factory=tuple)


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    measure: str


# Semantic models, measures and metrics.
SEMANTIC_MODELS = {
    "fct_invoices_sm": SemanticModel(
        "fct_invoices_sm", "fct_invoices", "invoice_date",
        ("plan_code", "tier_level", "payment_method", "currency_code", "is_paid"),
        (Measure("total_mrr", "sum", "mrr_contribution_usd"),
         Measure("total_arr", "sum", "arr_contribution_usd"),
         Measure("total_collected", "sum", "net_amount_usd"),
         Measure("invoice_count", "count", "invoice_sk"))),
    "dim_customer_sm": SemanticModel(
        "dim_customer_sm", "dim_customer", "customer_created_at",
        ("customer_segment", "acquisition_channel", "country_code"),
        (Measure("customer_count", "count_distinct", "customer_id"),)),
    "fct_events_sm": SemanticModel(
        "fct_events_sm", "fct_events", "event_date_key",
        ("event_type", "event_category", "platform"),
        (Measure("event_count", "count", "event_sk"),
         Measure("active_users", "count_distinct", "customer_sk"))),
    "fct_subscriptions_sm": SemanticModel(
        "fct_subscriptions_sm", "fct_subscriptions", "start_date",
        ("plan_code", "status", "is_active", "is_churned"),
        (Measure("subscription_count", "count_distinct", "subscription_id"),
         Measure("subscription_mrr", "sum", "mrr_usd"))),
}

METRICS = {
    "mrr": Metric("mrr", "Monthly Recurring Revenue", "total_mrr"),
    "arr": Metric("arr", "Annual Recurring Revenue", "total_arr"),
    "total_collected_revenue": Metric("total_collected_revenue", "Total Collected Revenue", "total_collected"),
    "new_customers": Metric("new_customers", "New Customers", "customer_count"),
    "active_subscriptions": Metric("active_subscriptions", "Active Subscriptions", "subscription_count"),
    "dau": Metric("dau", "Daily Active Users", "active_users"),
    "total_events": Metric("total_events", "Total Events", "event_count"),
}


def measure_model(measure: str) -> tuple[SemanticModel, Measure]:
    for sm in SEMANTIC_MODELS.values():
        for m in sm.measures:
            if m.name == measure:
                return sm, m
    raise KeyError(measure)


def time_bucket(col: str, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    d = F.col(col).cast("date")
    return d if grain == "day" else F.trunc(d, grain)


def metric_query(tables: dict[str, DataFrame], metric: str, by: tuple = (),
                 grain: str = "day", where: Column | None = None) -> DataFrame:
    """ME5: ``metric`` aggregated per ``<time>__<grain>`` and dimensions ``by``.

    A measure that no metric is built on is queried by its own name.
    """
    sm, measure = measure_model(METRICS[metric].measure if metric in METRICS else metric)
    for d in by:
        if d not in sm.dimensions:
            raise ValueError(f"{d} is not a dimension of {sm.name}")
    df = tables[sm.table]
    if where is not None:
        df = df.filter(where)
    tcol = f"metric_time__{grain}"
    agg = measure.column()
    return (df.groupBy(time_bucket(sm.time_dimension, grain).alias(tcol), *by)
            .agg(agg.alias(metric)))


def metrics_query(tables: dict[str, DataFrame], metrics: tuple, by: tuple = (), grain: str = "day",
                  where: dict[str, Column] | None = None) -> DataFrame:
    """ME5 over several metrics: one row per ``metric_time__<grain>`` and shared dimensions.

    Metrics (or measures by name) of one semantic model are one aggregation of its
    table, behind that model's filter in ``where`` (by model name).  The models'
    results, small by then, are stacked and folded by time and dimensions, which
    meets NULL dimensions as equal; a metric without rows is NULL.  Every
    dimension must be one of every model's.
    """
    per_model: dict[str, list[tuple[str, Measure]]] = {}
    for name in metrics:
        sm, measure = measure_model(METRICS[name].measure if name in METRICS else name)
        per_model.setdefault(sm.name, []).append((name, measure))
    unknown = set(where or {}) - set(per_model)
    if unknown:
        raise ValueError(f"filters for models that no metric reads: {sorted(unknown)}")
    time = f"metric_time__{grain}"
    stack = None
    for model, measures in per_model.items():
        sm = SEMANTIC_MODELS[model]
        for d in by:
            if d not in sm.dimensions:
                raise ValueError(f"{d} is not a dimension of {model}")
        rows = tables[sm.table]
        if where and model in where:
            rows = rows.filter(where[model])
        rows = rows.groupBy(time_bucket(sm.time_dimension, grain).alias(time), *by).agg(*[m.column().alias(n) for n, m in measures])
        stack = rows if stack is None else stack.unionByName(rows, allowMissingColumns=True)
    return stack.groupBy(time, *by).agg(*[F.max(n).alias(n) for n in metrics])


def fill_spine(df: DataFrame, spine: DataFrame, time_col: str, value_cols: list[str],
               spine_col: str = "date_day") -> DataFrame:
    """ME13: one row per spine day, missing values filled with 0."""
    s = spine.select(F.col(spine_col).alias(time_col))
    j = s.join(df, time_col, "left")
    return j.select(time_col, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in value_cols])
