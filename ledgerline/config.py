"""Run parameters shared by every table function.

Everything that the warehouse would otherwise read from a clock is an
argument here: ``as_of`` replaces ``current_date()`` and ``load_ts``
replaces the per-model load timestamp.  Table functions take these as
literals, so a rebuild, an incremental load and a streaming micro-batch
compute the same thing for the same inputs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Project calendar start and the reporting date / load time
# used by the test fixtures (fixture dates run 1995-2002).
DEFAULT_START_DATE = dt.date(2020, 1, 1)
FIXTURE_START_DATE = dt.date(1995, 1, 1)
FIXTURE_AS_OF = dt.date(2001, 8, 1)
FIXTURE_LOAD_TS = dt.datetime(2001, 8, 1, 0, 0, 0)


@dataclass(frozen=True)
class Config:
    """Parameters of one warehouse run.

    as_of       the reporting date ("today"); required
    load_ts     load timestamp stamped on vault rows and snapshot versions; required,
                and a new one for every load
    start_date  first day of the calendar (``dim_date``) and time spine
    root        directory holding materialised tables (one sub-dir per layer)
    """

    as_of: dt.date
    load_ts: dt.datetime
    start_date: dt.date = DEFAULT_START_DATE
    root: str | None = None
    calendar_years_ahead: int = 3
    churn_years_back: int = 3
    usage_years_back: int = 2
    cohort_max_months: int = 24
    vault_key_digits: int = 1      # stored vault tables have 16 ** digits key partitions

    @staticmethod
    def fixtures(root: str | None = None) -> "Config":
        return Config(start_date=FIXTURE_START_DATE, as_of=FIXTURE_AS_OF,
                      load_ts=FIXTURE_LOAD_TS, root=root)
