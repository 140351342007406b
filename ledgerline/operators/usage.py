"""MU1-MU6: daily usage, rolling active users, engagement.

Rolling distinct users (WAU/MAU) are computed without a range join.
For each customer, every active day d opens the interval
[d, min(next active day, d + w)) during which the customer counts as
active; the intervals of one customer never overlap, so +1 at the start,
-1 at the end, summed per day and accumulated over days gives the exact
number of distinct customers active in the trailing w days.  Cost is
linear in customer-days.  The per-customer ``lead`` partitions by
customer (a hot customer holds at most one row per day); the running
sum is over one row per calendar day, a bounded series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date


# Numbers of a customer-day that a day adds up, and their names for the day.
DAILY_SUMS = {"user_engagement_score": "daily_engagement_score", "user_event_count": "total_events",
              "engagement_events": "engagement_events", "conversion_events": "conversion_events",
              "churn_signal_events": "churn_signal_events"}
ROLLING = {"wau_7d": 7, "mau_28d": 28}


def recent_events(fct_events: DataFrame, as_of: dt.date, years_back: int = 2) -> DataFrame:
    """MU1: events dated on or after ``as_of - years`` (pushed into the scan)."""
    try:
        lo = as_of.replace(year=as_of.year - years_back)
    except ValueError:
        lo = as_of.replace(year=as_of.year - years_back, day=28)
    recent = F.col("event_date_key") >= lit_date(lo)
    if "partition_month" in fct_events.columns:     # stored facts: prune month partitions
        recent = recent & (F.col("partition_month") >= lit_date(lo.replace(day=1)))
    return (fct_events.filter(recent)
            .select(F.col("event_date_key").alias("event_date"), "customer_sk", "event_type",
                    "event_category", "feature_name", "platform", "device_type",
                    "engagement_score", "is_conversion_event", "is_churn_signal"))


def _customer_day_sums(events: DataFrame) -> DataFrame:
    """Everything the daily numbers add up, per customer and active day."""
    flag = lambda c: F.count(F.when(c, 1))
    return events.groupBy("event_date", "customer_sk").agg(
        F.sum("engagement_score").cast("bigint").alias("user_engagement_score"),
        F.count(F.lit(1)).alias("user_event_count"),
        flag(F.col("event_category") == "ENGAGEMENT").alias("engagement_events"),
        flag(F.col("is_conversion_event")).alias("conversion_events"),
        flag(F.col("is_churn_signal")).alias("churn_signal_events"))


def customer_days(events: DataFrame) -> DataFrame:
    """MU2: one row per customer per active day."""
    return _customer_day_sums(events).select("event_date", "customer_sk", "user_engagement_score", "user_event_count")


def features_by_day(events: DataFrame) -> DataFrame:
    """Distinct features per day, from the distinct (day, feature) pairs."""
    return (events.select("event_date", "feature_name").distinct().groupBy("event_date")
            .agg(F.count("feature_name").alias("distinct_features_used")))


def daily_usage(events: DataFrame) -> DataFrame:
    """MU3: daily aggregate, from the customer-day sums; features from the
    distinct (day, feature) pairs.  No distinct count runs over raw events."""
    daily = _customer_day_sums(events).groupBy("event_date").agg(
        F.count("customer_sk").alias("dau"),
        *[F.sum(c).cast("bigint").alias(n) for c, n in DAILY_SUMS.items()])
    return daily.join(features_by_day(events), "event_date")


def rolling_actives(cust_days: DataFrame, days: DataFrame, window_days: int,
                    name: str, entity: str = "customer_sk", date_col: str = "event_date") -> DataFrame:
    """MU4/MU5: distinct entities active in [d - w + 1, d] for each date d of ``days``."""
    w = Window.partitionBy(entity).orderBy(date_col)
    d = F.col(date_col)
    intervals = (cust_days.select(entity, date_col).distinct()
                 .withColumn("_next", F.lead(date_col).over(w))
                 .select(d.alias("_start"),
                         F.least(F.coalesce("_next", F.date_add(d, window_days)),
                                 F.date_add(d, window_days)).alias("_end")))
    deltas = (intervals.select(F.explode(F.array(
                F.struct(F.col("_start").alias("_day"), F.lit(1).alias("_delta")),
                F.struct(F.col("_end").alias("_day"), F.lit(-1).alias("_delta")))).alias("e"))
              .groupBy(F.col("e._day").alias("_day"))
              .agg(F.sum("e._delta").alias("_delta")))
    running = deltas.select("_day", F.sum("_delta").over(
        Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(name))
    return (days.select(date_col).join(running, d == F.col("_day"), "inner")
            .select(date_col, F.col(name).cast("bigint").alias(name)))


def usage_by_day(events: DataFrame) -> DataFrame:
    """MU3-MU5 together: ``daily_usage`` with ``wau_7d`` and ``mau_28d``, from one customer-day aggregate.

    A customer-day is its day's sums and the start of both windows' intervals; it ends
    them on later days, which may have no events of their own and are left out last.
    """
    days = _customer_day_sums(events).withColumn(
        "_next", F.lead("event_date").over(Window.partitionBy("customer_sk").orderBy("event_date")))
    end = lambda n: F.least(F.date_add("event_date", n), F.coalesce("_next", F.date_add("event_date", n)))
    starts = {name: F.lit(1) for name in ROLLING}
    user = {"days": F.lit(1), "dau": F.col("customer_sk").isNotNull().cast("int"), **{n: F.col(c) for c, n in DAILY_SUMS.items()}}
    nothing = {n: F.lit(None).cast("int" if n in ("days", "dau") else "bigint") for n in user}
    rows = [(F.col("event_date"), {**starts, **user})]
    rows += [(end(n), {**{other: F.lit(-1 if other == name else 0) for other in ROLLING}, **nothing}) for name, n in ROLLING.items()]
    parts = days.select(F.explode(F.array(*[
        F.struct(day.alias("event_date"), *[v.alias(n) for n, v in values.items()]) for day, values in rows])).alias("e")).select("e.*")
    daily = parts.groupBy("event_date").agg(*[F.sum(n).cast("bigint").alias(n) for n in [*ROLLING, *user]])
    upto = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = daily.select("event_date", *user, *[F.sum(name).over(upto).alias(name) for name in ROLLING]).where("days > 0")
    return daily.drop("days").join(features_by_day(events), "event_date")


def mart_usage(fct_events: DataFrame, as_of: dt.date, years_back: int = 2) -> DataFrame:
    """MU6: DAU, WAU, MAU, ratios, engagement and 7-row moving averages."""
    j = usage_by_day(recent_events(fct_events, as_of, years_back))
    dau = F.col("dau")
    wau_c, mau_c = F.col("wau_7d"), F.col("mau_28d")
    moving = Window.orderBy("event_date").rowsBetween(-6, 0)
    return j.select(
        "event_date", dau.alias("dau"),
        "wau_7d", "mau_28d",
        F.round(dau.cast("double") / F.nullif(wau_c, F.lit(0)).cast("double") * 100, 2).alias("dau_wau_ratio_pct"),
        F.round(dau.cast("double") / F.nullif(mau_c, F.lit(0)).cast("double") * 100, 2).alias("dau_mau_ratio_pct"),
        "daily_engagement_score",
        F.round(F.col("daily_engagement_score").cast("double") / F.nullif(dau, F.lit(0)).cast("double"), 2)
         .alias("avg_engagement_per_user"),
        "total_events", "engagement_events", "conversion_events", "churn_signal_events",
        "distinct_features_used",
        F.avg(dau).over(moving).alias("dau_7d_avg"),
        F.avg("total_events").over(moving).alias("events_7d_avg"))
