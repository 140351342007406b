"""The rewritten operators against their literal forms, brute force in Python."""
import datetime as dt
import random
from decimal import Decimal

from ledgerline.operators import churn, obt, usage


def _months(first, last):
    out, m = [], first
    while m <= last:
        out.append(m)
        m = (m.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return out


def test_rolling_actives_equals_range_join(spark):
    rng = random.Random(7)
    base = dt.date(2001, 1, 1)
    rows = set()
    for c in range(30):
        for _ in range(rng.randint(0, 12)):
            rows.add((base + dt.timedelta(days=rng.choice([0, 1, 2, 5, 9, 20, 33, 34, 60, 61, 90])), f"c{c}"))
    cd = spark.createDataFrame(sorted(rows), "event_date date, customer_sk string")
    days = cd.select("event_date").distinct()
    for w in (7, 28):
        got = {r.event_date: r[f"n"] for r in usage.rolling_actives(cd, days, w, "n").collect()}
        for d in {d for d, _ in rows}:
            lo = d - dt.timedelta(days=w - 1)
            assert got[d] == len({c for dd, c in rows if lo <= dd <= d}), (w, d)


def test_churn_counts_equal_cross_join(spark):
    rng = random.Random(3)
    as_of = dt.date(2001, 8, 1)
    rows = []
    for i in range(120):
        start = dt.date(1998, 1, 1) + dt.timedelta(days=rng.randint(0, 1300))
        canc = None
        if rng.random() < 0.5:
            canc = dt.datetime.combine(start + dt.timedelta(days=rng.randint(-40, 500)), dt.time())
            if rng.random() < 0.2:                       # exactly at a month start
                canc = dt.datetime(canc.year, canc.month, 1)
        plan = rng.choice(["PRO", "FREE", None])
        mrr = None if rng.random() < 0.1 else Decimal(rng.randint(0, 900)) / 100
        sid = str(rng.randint(0, 80))                    # several states per subscription
        rows.append((sid, plan, mrr, start, canc))
    rows.append(("999", "SOLO", None, dt.date(1999, 1, 1), None))   # all-active NULL-MRR group
    fct = spark.createDataFrame(rows, "subscription_id string, plan_code string, mrr_usd decimal(18,2), "
                                      "start_date date, cancelled_at timestamp_ntz")
    got = {(r.report_month, r.plan_code): (r.active_subs, r.churned_subs, r.new_subs, r.active_mrr_usd)
           for r in churn.churn_counts(fct, as_of, 3, dt.date(1995, 1, 1)).collect()}
    months = _months(dt.date(1998, 8, 1), dt.date(2001, 8, 1))
    plans = {r[1] for r in rows}
    assert len(got) == len(months) * len(plans)
    for m in months:
        nxt = _months(m, m + dt.timedelta(days=40))[1]
        for p in plans:
            g = [r for r in rows if r[1] == p]
            act = [r for r in g if r[3] <= m and (r[4] is None or r[4] > dt.datetime.combine(m, dt.time()))]
            churned = {r[0] for r in g if r[4] is not None and m <= r[4].date() < nxt}
            new = {r[0] for r in g if m <= r[3] < nxt}
            vals = [r[2] if r in act else Decimal(0) for r in g]
            mrr = None if all(v is None for v in vals) else sum(v for v in vals if v is not None)
            assert got[(m, p)] == (len({r[0] for r in act}), len(churned), len(new), mrr), (m, p)


def test_customer_months_equals_calendar_cross_join(spark):
    as_of = dt.date(2001, 8, 1)
    start = dt.date(1995, 1, 15)                         # mid-month calendar start
    rows = [("a", "ska", dt.date(1994, 11, 1), True), ("b", "skb", dt.date(2001, 8, 1), True),
            ("c", "skc", dt.date(2001, 9, 1), True), ("d", "skd", None, True),
            ("e", "ske", dt.date(1999, 3, 1), False)]
    dim = spark.createDataFrame(rows, "customer_id string, customer_sk string, cohort_month date, is_current boolean")
    for c in ("customer_name", "email", "company_name", "customer_segment", "acquisition_channel",
              "country_code", "cohort_quarter", "cohort_year", "first_subscription_date",
              "is_active_customer", "has_churned"):
        from pyspark.sql import functions as F
        dim = dim.withColumn(c, F.lit(None).cast("string"))
    got = sorted((r.customer_id, r.report_month) for r in obt.customer_months(dim, start, as_of).collect())
    cal = [start + dt.timedelta(days=i) for i in range((dt.date(2004, 8, 1) - start).days)]
    firsts = [d for d in cal if d.day == 1]
    want = sorted((r[0], d) for r in rows if r[3] and r[2] is not None
                  for d in firsts if r[2] <= d <= as_of)
    assert got == want


def test_highest_plan_alphabetical_or_by_tier(spark):
    from ledgerline.sources import seeds
    rows = [("s1", "c", "STARTER", dt.date(2001, 1, 5), False, Decimal("1.00")),
            ("s2", "c", "ENTERPRISE", dt.date(2001, 1, 9), False, Decimal("2.00")),
            ("s3", "c", "LEGACY", dt.date(2001, 1, 9), False, Decimal("2.00"))]
    fct = spark.createDataFrame(rows, "subscription_id string, customer_sk string, plan_code string, "
                                      "start_date date, is_churned boolean, mrr_usd decimal(18,2)")
    alpha = obt.started_subscriptions(fct).first().highest_plan_code
    tier = obt.started_subscriptions(fct, seeds.plan_tiers(spark)).first().highest_plan_code
    assert (alpha, tier) == ("STARTER", "ENTERPRISE")


def test_churn_collects_months_not_states(spark, monkeypatch):
    """100,000 states without an id: no array is longer than there are months."""
    fct = spark.range(100_000).selectExpr("cast(null as string) subscription_id", "'PRO' plan_code", "cast(1 as decimal(18,2)) mrr_usd",
                                          "date'2000-01-01' + cast(id % 90 as int) start_date", "cast(null as timestamp_ntz) cancelled_at")
    frames, select = [], type(fct).select
    monkeypatch.setattr(type(fct), "select", lambda self, *c: frames.append(self) or select(self, *c))
    got = {r.report_month: r for r in churn.churn_counts(fct, dt.date(2001, 1, 1), 3, dt.date(2000, 1, 1)).collect()}
    monkeypatch.undo()
    per = next(f for f in frames if "money" in f.columns)
    assert max(len(r.money) for r in per.select("money").collect()) <= 13 * 13
    assert got[dt.date(2001, 1, 1)].active_mrr_usd == 100_000 and got[dt.date(2001, 1, 1)].active_subs == 0


def _usage_rows():
    rng = random.Random(5)
    base = dt.date(2001, 1, 20)
    days = [base + dt.timedelta(days=d) for d in (0, 1, 2, 6, 7, 11, 27, 28, 29, 70)] + [None]
    return [(rng.choice(days), rng.choice([None, "c0", *(f"c{k}" for k in range(9))]), rng.choice(["ENGAGEMENT", "ERROR", None]),
             rng.choice([None, "f1", "f2", "f3"]), rng.choice([None, 1, 5]), rng.random() < 0.3, rng.random() < 0.2) for _ in range(300)]


USAGE_COLUMNS = ("event_date_key date, customer_sk string, event_category string, feature_name string, engagement_score int, "
                 "is_conversion_event boolean, is_churn_signal boolean")


def test_usage_by_day_equals_its_parts(spark):
    rows = [r for r in _usage_rows() if r[0]]
    events = spark.createDataFrame(rows, USAGE_COLUMNS).withColumnRenamed("event_date_key", "event_date")
    got = {r.event_date: r.asDict() for r in usage.usage_by_day(events).collect()}
    assert len(got) == len({r[0] for r in rows}) == 10
    for r in usage.daily_usage(events).collect():
        assert {c: got[r.event_date][c] for c in r.asDict()} == r.asDict()
    for name, n in usage.ROLLING.items():
        for d, r in got.items():
            assert r[name] == len({x[1] for x in rows if d - dt.timedelta(days=n - 1) <= x[0] <= d}), (name, d)
    plan = usage.usage_by_day(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2         # one pass for the sums and windows, one for the features
    assert usage.usage_by_day(events.limit(0)).count() == 0


def test_customer_usage_counts_days_as_distinct(spark):
    rows = _usage_rows()
    got = {(r.report_month, r.customer_sk): (r.total_events, r.active_days, r.features_used)
           for r in obt.customer_usage(spark.createDataFrame(rows, USAGE_COLUMNS)).collect()}
    want = {}
    for r in rows:
        want.setdefault((r[0] and r[0].replace(day=1), r[1]), []).append(r)
    assert got == {k: (len(g), len({x[0] for x in g} - {None}), len({x[3] for x in g} - {None})) for k, g in want.items()}
