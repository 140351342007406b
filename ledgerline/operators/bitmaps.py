"""MU3-MU5, OB3, ME11 as mergeable distinct counts: exact bitmaps of customers.

Customers get dense numbers; the customers of a day are bitmaps of 32,768 numbers
each.  Bitmaps merge by OR: days to trailing windows and months, without going
back to the events.  Events are aggregated once, and a day's late events only
change that day's bitmaps (``refresh_days``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.store import TableStore

DAYS = "actives_by_day"


def dense_numbers(keys: DataFrame, key: str = "customer_sk") -> DataFrame:
    """``(key, number)``: distinct keys numbered from 1 in their order.

    A range sort numbers the rows of its partitions; the partitions' sizes, one row
    each, give where they start.  Written once, so numbers stay the same.
    """
    rows = keys.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).sortWithinPartitions(key)
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "numbered-keys")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return rows.withColumn("part", part).join(F.broadcast(before), "part").select(
        key, (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("number"))


def day_bitmaps(events: DataFrame, numbers: DataFrame, key: str = "customer_sk", day: str = "event_date") -> DataFrame:
    """``(day, bucket, bitmap)``: who was active, from the distinct (day, customer) pairs."""
    pairs = events.select(day, key).distinct().join(numbers, key)
    return pairs.groupBy(day, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def actives(bitmaps: DataFrame, period: Column, name: str, count: str) -> DataFrame:
    """Distinct customers per period, ``period`` being a column of days or an array of
    the periods that a day counts for."""
    merged = bitmaps.select(period.alias(name), "bucket", "bitmap").groupBy(name, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(name).agg(F.sum(F.bitmap_count("bitmap")).alias(count))


def trailing(day: str, window_days: int) -> Column:
    """The days in whose trailing window a day lies."""
    return F.explode(F.sequence(F.col(day), F.date_add(day, window_days - 1)))


def rolling_actives(bitmaps: DataFrame, day: str = "event_date") -> DataFrame:
    """``(day, dau, wau_7d, mau_28d)`` for the days that have events."""
    out = bitmaps.groupBy(day).agg(F.sum(F.bitmap_count("bitmap")).alias("dau"))
    for days, name in ((7, "wau_7d"), (28, "mau_28d")):
        out = out.join(actives(bitmaps, trailing(day, days), day, name), day)
    return out


def refresh_days(store: TableStore, bitmaps: DataFrame, day: str = "event_date") -> DataFrame:
    """Store the bitmaps of some days in place of what was there for these days."""
    store.finish("marts", DAYS)
    store.overwrite("marts", bitmaps, {DAYS: ("true", [day], False)})
    return store.read("marts", DAYS)
