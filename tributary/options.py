"""Parameters shared by the staging and mart plans."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Options:
    """How amounts, averages and time are treated.

    amount_type   exact decimal that raw float amounts are cast to. The default keeps nine
                  decimals; ``decimal(18,2)`` is the faster choice for data in whole cents.
    average_type  type of averages; ``double`` divides the exact sum as a double.
    loaded_at_type  type of the load time in staging and marts.
    as_of         "today" for date rules; None means the day the query runs.
    """

    amount_type: str = "decimal(38,9)"
    average_type: str = "decimal(38,9)"
    loaded_at_type: str = "timestamp"
    as_of: dt.date | None = None

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)


@dataclass(frozen=True)
class Thresholds:
    """Limits of the data-quality assertions."""

    min_volume: int = 100
    max_orphan_ratio: float = 0.05
    max_age_hours: int = 24
    dimension_max_age_days: int = 7
    lookback_days: int = 7
    bootstrap_days: int = 365
    peak_date_share: float = 0.5
