"""High-water marks, affected-key recompute, upsert and dimension refresh planning."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.calendar import bootstrap_date, days_before
from tributary.operators.selection import distinct_nonempty

EPOCH = dt.datetime(1970, 1, 1)


def high_water_mark(df: DataFrame, event_date: str, today: Column) -> DataFrame:
    """One row with the newest date that is not in the future; NULL for an empty table."""
    return df.filter(F.col(event_date) <= today).agg(F.max(event_date).alias("max_date"))


def watermark_window(df: DataFrame, event_date: str, today: Column,
                     lookback_days: int = 7) -> DataFrame:
    """One row: mark, start of the next fetch window, and how the start was found."""
    mark = high_water_mark(df, event_date, today)
    return mark.select(
        "max_date",
        days_before(F.col("max_date"), lookback_days).alias("min_date"),
        F.when(F.col("max_date").isNull(), "bootstrap").otherwise("watermark").alias("mode"),
    )


@dataclass(frozen=True)
class Window:
    """A resolved fetch window; ``allow_empty`` means that no rows is a success."""

    min_date: dt.date | None
    max_date: dt.date | None
    allow_empty: bool
    mode: str


def resolve_window(*, since_watermark: bool = False, min_date: dt.date | None = None,
                   max_date: dt.date | None = None, from_file: bool = False,
                   mark: dt.date | None = None, lookback_days: int = 7, cycle: int,
                   today: dt.date | None = None, bootstrap_days: int | None = None) -> Window:
    """Which dates to load: the mark, else an explicit start, else the bootstrap start."""
    if since_watermark and min_date is not None:
        raise ValueError("choose either since_watermark or min_date")
    if since_watermark:
        if mark is None:
            start = bootstrap_date(cycle, today, bootstrap_days)
            return Window(start, max_date, True, "bootstrap")
        return Window(mark - dt.timedelta(days=lookback_days), max_date, True, "watermark")
    if min_date is not None:
        return Window(min_date, max_date, False, "explicit")
    if from_file:
        return Window(None, max_date, False, "file")
    return Window(bootstrap_date(cycle, today, bootstrap_days), max_date, False, "bootstrap")


class EmptyLoadError(RuntimeError):
    """Raised when a load that must bring rows brings none."""


def should_load(df: DataFrame, window: Window) -> bool:
    """False for an empty incremental window, an error for any other empty load."""
    if not df.isEmpty():
        return True
    if window.allow_empty:
        return False
    raise EmptyLoadError("no records to load")


def rows_after_mark(df: DataFrame, loaded_at: str, mart: DataFrame, mart_mark: str) -> DataFrame:
    """Rows loaded strictly after the newest load the mart has seen.

    The mark is a scalar subquery, computed before the scan so that the comparison can reach it.
    """
    kind = mart.schema[mart_mark].dataType
    floor = mart.agg(F.coalesce(F.max(mart_mark), F.lit(EPOCH).cast(kind)).alias("floor"))
    return df.filter(F.col(loaded_at) > floor.scalar())


def affected_keys(new_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new_rows.select(*keys).distinct()


def upsert(current: DataFrame, fresh: DataFrame, keys: Sequence[str],
           replaced: DataFrame | None = None) -> DataFrame:
    """Current rows without the replaced keys, plus the fresh rows; nothing else is deleted."""
    gone = (fresh if replaced is None else replaced).select(*keys)
    return current.join(gone, list(keys), "left_anti").unionByName(fresh)


def existing_dimension_state(df: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """Newest load time per non-empty key."""
    present = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return present.groupBy(key).agg(F.max(loaded_at).alias("loaded_at"))


def dimension_refresh_plan(needed: DataFrame, existing: DataFrame, key: str, loaded_at: str,
                           now: dt.datetime | None = None, max_age_days: int = 7) -> DataFrame:
    """Keys to fetch and why.

    Everything needed when nothing is loaded or the newest load of any row is older than
    ``max_age_days`` (strictly); otherwise the needed keys that are not loaded yet. No rows
    means the dimension is up to date.
    """
    kind = existing.schema[loaded_at].dataType
    clock = (F.current_timestamp() if now is None else F.lit(now)).cast(kind)
    state = existing_dimension_state(existing, key, loaded_at)
    newest = existing.filter(F.col(key).isNotNull() & (F.col(key) != "")).agg(
        F.max(loaded_at).alias("newest")).scalar()
    limit = clock - F.make_interval(days=F.lit(max_age_days))
    mode = (
        F.when(newest.isNull(), "full: nothing loaded")
        .when(newest < limit, "full: stale")
        .otherwise("delta")
    )
    known = state.select(key, F.lit(True).alias("_known"))
    candidates = distinct_nonempty(needed, key).join(known, key, "left").withColumn("mode", mode)
    return candidates.filter((F.col("mode") != "delta") | F.col("_known").isNull()) \
        .select(key, "mode")
