"""Two-year periods and fetch-window dates."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

CYCLE_VARIABLE = "TRIBUTARY_CYCLE"
WINDOW_VARIABLE = "TRIBUTARY_BOOTSTRAP_DAYS"


def election_cycle(day: Column) -> Column:
    """Even year that closes the two-year period a date falls in."""
    year = F.year(day)
    return year + F.pmod(year, F.lit(2))


def bootstrap_start(cycle: Column, today: Column, days: int = 365) -> Column:
    """Later of the first day of the cycle and ``days`` before today."""
    return F.greatest(F.make_date(cycle - 1, F.lit(1), F.lit(1)), F.date_sub(today, days))


def days_before(day: Column, days: int) -> Column:
    return F.date_sub(day, days)


def today_text(today: Column | None = None) -> Column:
    return F.date_format(F.current_date() if today is None else today, "yyyy-MM-dd")


def hours_between(earlier: Column, later: Column) -> Column:
    """Whole hours, truncated."""
    return F.timestamp_diff("HOUR", earlier, later)


def current_cycle(today: dt.date | None = None, env: Mapping[str, str] = os.environ) -> int:
    """Cycle of a driver-side date; an environment setting overrides it."""
    if env.get(CYCLE_VARIABLE):
        return int(env[CYCLE_VARIABLE])
    year = (today or dt.datetime.now(dt.UTC).date()).year
    return year + year % 2


def bootstrap_date(cycle: int, today: dt.date | None = None, days: int | None = None,
                   env: Mapping[str, str] = os.environ) -> dt.date:
    if days is None:
        days = int(env.get(WINDOW_VARIABLE, "365"))
    today = today or dt.datetime.now(dt.UTC).date()
    return max(dt.date(cycle - 1, 1, 1), today - dt.timedelta(days=days))
