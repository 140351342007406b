"""Date helpers that keep calendar semantics explicit.

* Truncations return ``DATE`` (``trunc``), never a timestamp.
* Month differences count calendar-month boundaries (Jan 31 -> Feb 1 is
  one month), i.e. ``12 * (y2 - y1) + (m2 - m1)``; Spark's own
  ``months_between`` / ``datediff(MONTH, ..)`` count whole months instead.
* Day differences count date boundaries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def lit_ts(t: dt.datetime) -> Column:
    """Wall-clock timestamp literal, independent of any time zone.

    (``F.lit(datetime)`` would build a session-zone TIMESTAMP through the
    Python process's local zone, shifting the value when the two differ.)
    """
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(c) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def quarter_start(c) -> Column:
    return F.trunc(_col(c).cast("date"), "quarter")


def year_start(c) -> Column:
    return F.trunc(_col(c).cast("date"), "year")


def month_diff(start, end) -> Column:
    """Calendar-month boundaries crossed from ``start`` to ``end``."""
    s, e = _col(start).cast("date"), _col(end).cast("date")
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def day_diff(start, end) -> Column:
    """Date boundaries crossed from ``start`` to ``end``."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date")).cast("bigint")
