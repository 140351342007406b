"""Tables built from parameters and seeds only (not registered as driver queries)."""
import datetime as dt

from ledgerline.operators import dimensions
from ledgerline.sources import seeds


def test_dim_date_calendar(spark):
    d = dimensions.dim_date(spark, dt.date(1995, 1, 1), dt.date(2001, 8, 1))
    assert d.count() == 3500                                   # end (as_of + 3 years) excluded
    r = {x.date_day: x for x in d.filter("date_day in ('2001-08-01', '2001-08-05', '2001-07-31')").collect()}
    today, sunday = r[dt.date(2001, 8, 1)], r[dt.date(2001, 8, 5)]
    assert (today.is_today, today.day_of_week, today.day_of_week_name, today.month_name) == (True, 3, "Wed", "Aug")
    assert (sunday.day_of_week, sunday.is_weekday, sunday.is_past_or_today) == (0, False, False)
    assert today.first_day_of_week == dt.date(2001, 7, 30) and today.year_month_key == 200108
    assert today.year_quarter_key == 20013 and r[dt.date(2001, 7, 31)].last_day_of_month == dt.date(2001, 7, 31)
    assert dimensions.time_spine(spark, dt.date(2020, 1, 1), dt.date(2001, 8, 1)).count() == 0


def test_seeds_and_dim_plan(spark):
    assert seeds.event_types(spark).count() == 23
    plans = {r.plan_code: r for r in dimensions.dim_plan(seeds.plan_tiers(spark)).collect()}
    assert plans["FREE"].annual_discount_factor is None           # monthly price 0
    assert abs(plans["STARTER"].annual_discount_pct - 16.666667) < 1e-6
    assert len({r.plan_sk for r in plans.values()}) == 5
