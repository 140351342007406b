import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import bitmaps, metrics, quality, revenue, staging


def test_metric_query_grains_and_dimension_check(spark):
    ev = spark.createDataFrame(
        [("e1", "c1", dt.date(2001, 1, 1), "web"), ("e2", "c1", dt.date(2001, 1, 1), "ios"),
         ("e3", "c2", dt.date(2001, 1, 9), "web")],
        "event_sk string, customer_sk string, event_date_key date, platform string")
    t = {"fct_events": ev}
    dau = {r.metric_time__day: r.dau for r in metrics.metric_query(t, "dau").collect()}
    assert dau == {dt.date(2001, 1, 1): 1, dt.date(2001, 1, 9): 1}
    m = metrics.metric_query(t, "total_events", ("platform",), "month").collect()
    assert sorted((r.platform, r.total_events) for r in m) == [("ios", 1), ("web", 2)]
    with pytest.raises(ValueError):
        metrics.metric_query(t, "dau", ("not_a_dimension",))
    with pytest.raises(ValueError):
        metrics.metric_query(t, "dau", (), "fortnight")


def test_mrr_non_negative_check(spark):
    f = spark.createDataFrame(
        [("i1", "c", "s", Decimal("-1.00000000"), dt.date(2001, 1, 1), False),
         ("i2", "c", "s", Decimal("-1.00000000"), dt.date(2001, 1, 1), True),
         ("i3", "c", "s", Decimal("5.00000000"), dt.date(2001, 1, 1), False)],
        "invoice_id string, customer_sk string, subscription_sk string, mrr_contribution_usd decimal(28,8), "
        "invoice_date date, is_refunded boolean")
    assert [r.invoice_id for r in quality.mrr_non_negative(f).collect()] == ["i1"]


def test_freshness_thresholds(spark):
    t = spark.createDataFrame([(dt.datetime(2001, 8, 1),)], "_loaded_at timestamp_ntz")
    out = {}
    for hours in (11, 13, 25):
        r = quality.freshness({"x": t}, dt.datetime(2001, 8, 1) + dt.timedelta(hours=hours)).first()
        out[hours] = r.status
    assert out == {11: "pass", 13: "warn", 25: "error"}


def test_unique_relationships_accepted_values(spark):
    child = spark.createDataFrame([("s1", "c1", "active"), ("s1", "c9", "gone"), ("s2", None, None)],
                                  "subscription_id string, customer_id string, status string")
    parent = spark.createDataFrame([("c1",)], "customer_id string")
    assert [tuple(r) for r in quality.unique(child, "subscription_id").collect()] == [("s1", 2)]
    assert [r.customer_id for r in quality.relationships(child, "customer_id", parent, "customer_id").collect()] == ["c9"]
    assert [r.status for r in quality.accepted_values(child, "status", quality.ACCEPTED_STATUS).collect()] == ["gone"]


def test_metrics_of_two_models_meet_on_time_and_dimensions(spark):
    d = dt.date(2001, 1, 1)
    inv = spark.createDataFrame([("i1", d, "PRO", Decimal("5.00000000"), True), ("i2", d, None, Decimal("7.00000000"), True), ("i3", d, "PRO", Decimal("9.00000000"), False)],
                                "invoice_sk string, invoice_date date, plan_code string, mrr_contribution_usd decimal(28,8), is_paid boolean")
    sub = spark.createDataFrame([("s1", d, None, "active"), ("s2", d, "FREE", "active"), ("s3", None, "FREE", "paused")],
                                "subscription_id string, start_date date, plan_code string, status string")
    t = {"fct_invoices": inv, "fct_subscriptions": sub}
    out = metrics.metrics_query(t, ("mrr", "active_subscriptions", "invoice_count"), ("plan_code",), "month", {"fct_invoices_sm": F.col("is_paid")})
    got = {(r.metric_time__month, r.plan_code): (r.mrr, r.active_subscriptions, r.invoice_count) for r in out.collect()}
    assert got == {(d, "PRO"): (Decimal(5), None, 1), (d, None): (Decimal(7), 1, 1), (d, "FREE"): (None, 1, None), (None, "FREE"): (None, 1, None)}
    for wrong in ({"by": ("status",)}, {"where": {"fct_events_sm": F.lit(True)}}):
        with pytest.raises(ValueError):
            metrics.metrics_query(t, ("mrr", "active_subscriptions"), **wrong)


def test_a_tier_edit_within_a_month_is_no_new_revenue(spark):
    months = [dt.date(2001, m, 1) for m in (1, 2, 3)]
    rows = [(months[0], "PRO", 3, 10), (months[1], "PRO", 3, 4), (months[1], "PRO", 4, 6), (months[2], "PRO", 4, 12)]
    m = spark.createDataFrame([(d, p, t, "c", "s", Decimal(v), Decimal(0), Decimal(0), Decimal(0), 1, 0) for d, p, t, v in rows],
                              "revenue_month date, plan_code string, tier_level int, customer_sk string, subscription_sk string, mrr_usd decimal(28,8), "
                              "arr_usd decimal(38,2), collected_usd decimal(38,2), refunded_usd decimal(38,2), paid_count long, failed_count long")
    got = {(r.revenue_month.month, r.tier_level): (r.current_mrr, r.prior_mrr, r.new_mrr, r.expansion_mrr, r.contraction_mrr) for r in revenue.mrr_movements(m).collect()}
    assert got == {(1, 3): (10, 0, 10, 0, 0), (2, 3): (4, 0, 0, 0, 0), (2, 4): (6, 10, 0, 0, 0), (3, 4): (12, 10, 0, 2, 0)}


def test_property_values(spark):
    texts = ['{"k": 5, "x": {"y": [1, 2]}}', '{"k": "6"}', '{"k": "six"}', '{"k": ', "", None, "[3]", "null"]
    stg = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "event_id string, event_properties string")
    out = staging.property_values(stg, {"k": ("$.k", "int"), "y": ("$.x.y[1]", "bigint")}).collect()
    assert [(r.is_json, r.k, r.y) for r in sorted(out, key=lambda r: r.event_id)] == [
        (True, 5, 2), (True, 6, None), (True, None, None), (False, None, None), (False, None, None), (False, None, None), (True, None, None), (True, None, None)]


def test_bitmaps_count_exactly(spark):
    import random
    rng = random.Random(4)
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=d) for d in range(60) if d % 9]
    rows = [(rng.choice(days), f"c{rng.randrange(40_000)}") for _ in range(3000)] + [(days[0], None)]
    ev = spark.createDataFrame(rows, "event_date date, customer_sk string")
    numbers = bitmaps.dense_numbers(ev)
    got = sorted(r.number for r in numbers.collect())
    assert got == list(range(1, len({c for _, c in rows if c}) + 1))
    out = {r.event_date: (r.dau, r.wau_7d, r.mau_28d) for r in bitmaps.rolling_actives(bitmaps.day_bitmaps(ev, numbers)).collect()}
    seen = lambda d, w: len({c for e, c in rows if c and d - dt.timedelta(days=w) < e <= d})
    assert out == {d: (seen(d, 1), seen(d, 7), seen(d, 28)) for d in {e for e, c in rows if c}}
