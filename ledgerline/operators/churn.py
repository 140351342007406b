"""MC1-MC3: monthly churn by plan.

The reference crosses every report month with every subscription state
and counts conditionally.  Here each state row is exploded only over the
report months it is active in (``sequence`` of month starts), and the
churned / new counts are keyed by a single month each, so the work is
linear in (rows x active months) and no nested-loop join is planned.
The months x plans scaffold is an explode per distinct plan (not a
join); the three aggregates are left-joined to it null-safely on the
plan (the plan may be NULL).  All joined inputs are already aggregated
to at most months x plans rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_start

MONEY = "decimal(38,2)"


def _one_month():
    return F.expr("interval 1 month")


def report_window(as_of: dt.date, years_back: int = 3,
                  calendar_start: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """MC1 bounds: month starts of every calendar day in [as_of - years, as_of]."""
    try:
        lo = as_of.replace(year=as_of.year - years_back)
    except ValueError:          # Feb 29
        lo = as_of.replace(year=as_of.year - years_back, day=28)
    if calendar_start and calendar_start > lo:
        lo = calendar_start
    return lo.replace(day=1), as_of.replace(day=1)


def report_months(spark: SparkSession, as_of: dt.date, years_back: int = 3,
                  calendar_start: dt.date | None = None) -> DataFrame:
    """MC1: distinct first-of-month dates of the report window."""
    first, last = report_window(as_of, years_back, calendar_start)
    return spark.range(1).select(F.explode(F.sequence(
        lit_date(first), lit_date(last), _one_month())).alias("report_month"))


def churn_counts(fct_subscriptions: DataFrame, as_of: dt.date, years_back: int = 3,
                 calendar_start: dt.date | None = None) -> DataFrame:
    """MC2: active / churned / new subscriptions and active MRR by month and plan.

    Active at month start m: ``start_date <= m`` and (``cancelled_at`` is
    NULL or ``cancelled_at > m``); each fact row (state) counts, so MRR of
    several states of one subscription adds up.

    One pass over the fact, as sums of changes: a state covers a run of months;
    per subscription the runs are united, and each united run adds one active
    subscription in its first month and takes it away after its last.  The
    changes are summed by plan and month and run up over the months, so no row
    is multiplied by the months it covers.  The states of a subscription are first
    summed by their months, so however many it has (or those without an id have),
    what is collected is bounded by the months of the report.
    """
    first, last = report_window(as_of, years_back, calendar_start)
    lo, hi = lit_date(first), lit_date(last)
    start_m, canc_m = month_start("start_date"), month_start("cancelled_at")
    from_m = F.greatest(F.when(F.col("start_date") == start_m, start_m).otherwise(F.add_months(start_m, 1)), lo)
    to_m = F.least(F.coalesce(F.when(F.col("cancelled_at") > canc_m.cast("timestamp_ntz"), canc_m)
                              .otherwise(F.add_months(canc_m, -1)), hi), hi)
    runs = F.col("start_date").isNotNull() & (F.col("a") <= F.col("b"))
    within = lambda m: F.when(m.between(lo, hi), m)
    s = fct_subscriptions.select("subscription_id", "plan_code", "mrr_usd", "start_date", from_m.alias("a"), to_m.alias("b"),
                                 within(canc_m).alias("gone"), within(start_m).alias("came"))
    sums = s.groupBy("plan_code", "subscription_id", F.when(runs, F.col("a")).alias("a"), F.when(runs, F.col("b")).alias("b"), "gone", "came").agg(
        F.sum(F.when(runs, F.coalesce("mrr_usd", F.lit(0)))).cast("decimal(38,2)").alias("mrr"),
        F.count_if(runs & F.col("mrr_usd").isNotNull()).alias("paid"), F.count_if(runs).alias("states"), F.count(F.lit(1)).alias("n"))
    has = F.col("states") > 0
    per = sums.groupBy("plan_code", "subscription_id").agg(   # the states of one subscription, by their months
        F.array_sort(F.collect_list(F.when(has, F.struct("a", "b")))).alias("runs"),
        F.collect_list(F.when(has, F.struct("a", "b", "mrr", "paid", "states"))).alias("money"),
        F.collect_set("gone").alias("gone"), F.collect_set("came").alias("came"), F.sum("n").alias("n"))
    change = "named_struct('m', {m}, 'active', {active}, 'gone', {gone}, 'came', {came}, 'mrr', {mrr}, 'paid', {paid}, 'states', {states}, 'n', {n})"
    zero = dict(active="0L", gone="0L", came="0L", mrr="cast(0 as decimal(38,2))", paid="0L", states="0L", n="0L")
    at = lambda m, **v: change.format(m=m, **zero | v)
    one = "if(subscription_id is null, 0L, 1L)"
    united = """aggregate(runs, cast(array() as array<struct<a:date,b:date>>), (u, r) ->
        if(size(u) = 0 or r.a > element_at(u, -1).b, array_append(u, named_struct('a', r.a, 'b', r.b)),
           array_append(slice(u, 1, size(u) - 1), named_struct('a', element_at(u, -1).a, 'b', greatest(element_at(u, -1).b, r.b)))))"""
    after = "add_months(r.b, 1)"
    less = dict(mrr="cast(-r.mrr as decimal(38,2))", paid="-r.paid", states="-r.states")
    changes = F.expr(f"""explode(flatten(array(
        transform({united}, r -> {at('r.a', active=one)}), transform({united}, r -> {at(after, active='-' + one)}),
        transform(money, r -> {at('r.a', mrr='r.mrr', paid='r.paid', states='r.states')}),
        transform(money, r -> {at(after, **less)}),
        transform(gone, m -> {at('m', gone=one)}), transform(came, m -> {at('m', came=one)}),
        array({at(f"date'{first}'", n='n')}))))""")
    sums = per.select("plan_code", changes.alias("c")).groupBy("plan_code", F.col("c.m").alias("report_month")).agg(
        *[F.sum(f"c.{c}").alias(c) for c in ("active", "gone", "came", "mrr", "paid", "states", "n")])
    months = F.sequence(lo, hi, _one_month())
    grid = sums.groupBy("plan_code").agg(F.sum("n").alias("plan_rows")).select("plan_code", "plan_rows", F.explode(months).alias("report_month"))
    sums = sums.select(F.col("plan_code").alias("_p"), F.col("report_month").alias("_m"), "active", "gone", "came", "mrr", "paid", "states")
    rows = grid.join(sums, (F.col("report_month") == F.col("_m")) & F.col("plan_code").eqNullSafe(F.col("_p")), "left")
    w = Window.partitionBy("plan_code").orderBy("report_month").rowsBetween(Window.unboundedPreceding, 0)
    run = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(w)
    rows = rows.select("report_month", "plan_code", "plan_rows", run("active").alias("active_subs"), run("mrr").alias("mrr"),
                       run("paid").alias("paid"), run("states").alias("states"), "gone", "came")
    # The reference sums 0 for every inactive row: NULL only if all rows are active with NULL MRR.
    unpriced = (F.col("paid") == 0) & (F.col("states") == F.col("plan_rows"))
    return rows.select(
        "report_month", "plan_code", F.col("active_subs").cast("bigint").alias("active_subs"),
        F.coalesce("gone", F.lit(0)).cast("bigint").alias("churned_subs"), F.coalesce("came", F.lit(0)).cast("bigint").alias("new_subs"),
        F.when(~unpriced, F.col("mrr")).cast(MONEY).alias("active_mrr_usd"))


def mart_churn(fct_subscriptions: DataFrame, as_of: dt.date, years_back: int = 3,
               calendar_start: dt.date | None = None) -> DataFrame:
    """MC3: churn rates against the previous month row of the plan."""
    c = churn_counts(fct_subscriptions, as_of, years_back, calendar_start)
    w = Window.partitionBy("plan_code").orderBy("report_month")
    c = (c.withColumn("_pa", F.lag("active_subs").over(w))
          .withColumn("_pm", F.lag("active_mrr_usd").over(w)))
    pa, pm = F.col("_pa"), F.col("_pm")
    rate = F.col("churned_subs").cast("double") / pa.cast("double")
    return (c.withColumn("monthly_churn_rate_pct", F.when(pa > 0, F.round(rate * 100, 4)))
             .withColumn("annualised_churn_rate_pct",
                         F.when(pa > 0, F.round((1 - F.pow(1 - rate, 12)) * 100, 4)))
             .withColumn("mrr_churn_rate_pct",
                         F.when(pm > 0, F.round((pm - F.col("active_mrr_usd")).cast("double")
                                                / pm.cast("double") * 100, 4)))
             .drop("_pa", "_pm"))
