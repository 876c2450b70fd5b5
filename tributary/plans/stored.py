"""The stored tables of a deployment; None for a table that does not exist yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.dedupe import latest_wins
from tributary.options import Options
from tributary.plans import staging
from tributary.schemas import RAW_COMMITTEES, RAW_FACTS, mart_daily, mart_summary
from tributary.sources import layers as tables, ledger, versions
from tributary.sources.layers import Layers

DATE = "contribution_receipt_date"


def raw_facts(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """All committed batches; a folder that other means filled, without a ledger, is read as it is."""
    rows = ledger.read(spark, layers)
    if rows is None and "data" not in versions.listed(spark, layers.facts):
        rows = tables.read_by_date(spark, layers.facts, RAW_FACTS, DATE, layers.grain)
    return rows


def record_versions(spark: SparkSession, layers: Layers) -> Callable[[DataFrame], DataFrame] | None:
    """Finds the versions of a few record ids in the index; None where facts were not loaded as batches."""
    if not ledger.entries(spark, layers):
        return None
    return lambda ids: ledger.versions_of(ids, ledger.index(spark, layers), layers.buckets)


def staged_versions(spark: SparkSession, layers: Layers, options: Options) -> DataFrame:
    """One row per record with the columns that the marts read, as ``stg_contributions`` picks it.

    The index holds these columns in buckets of the record id, so the newest versions are found there
    without moving a row; facts that were not loaded as batches are moved.
    """
    known = ledger.entries(spark, layers)
    rows = ledger.index(spark, layers, known) if known else raw_facts(spark, layers)
    return latest_wins(staging.typed_versions(rows, options), ["sub_id"], staging.NEWEST_FACT)


def raw_committees(spark: SparkSession, layers: Layers) -> DataFrame | None:
    return tables.read_or_none(spark, layers.committees, RAW_COMMITTEES)


def daily_mart(spark: SparkSession, layers: Layers, options: Options) -> DataFrame | None:
    columns = mart_daily(options.amount_type, options.average_type, options.loaded_at_type)
    return versions.read(spark, layers.daily, columns, tables.grain_column(DATE, layers.grain))


def summary_mart(spark: SparkSession, layers: Layers, options: Options) -> DataFrame | None:
    return versions.read(spark, layers.summary, mart_summary(options.amount_type, options.average_type))


def append_facts(rows: DataFrame, layers: Layers, batch: str | None = None) -> bool:
    """Load a batch of raw facts; False if a batch of that id is loaded already."""
    return ledger.append(rows, layers, batch)


def dates_loaded_after(spark: SparkSession, layers: Layers, mark: dt.datetime) -> list[dt.date] | None:
    """Dates of the batches behind a load time; None where no batch was ever noted."""
    batches = ledger.entries(spark, layers)
    if not batches:
        return None
    return sorted({d for b in batches if b.loaded_at and b.loaded_at > mark for d in b.dates})


def daily_mark(spark: SparkSession, layers: Layers) -> dt.datetime | None:
    """Load time up to which the daily mart is complete; None before its first build."""
    state = versions.head(spark, layers.daily)
    return dt.datetime.fromisoformat(state.notes["mark"]) if state else None
