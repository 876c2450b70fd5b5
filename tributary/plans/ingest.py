"""Loading of facts and of the dimension: window, fetch, validate, land, append."""

from __future__ import annotations

import datetime as dt
from contextlib import ExitStack
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.incremental import (EmptyLoadError, Window, dimension_refresh_plan,
                                             high_water_mark, resolve_window, should_load)
from tributary.operators.rollup import (category_counts, peak_of_cells, summary_cells,
                                        summary_of_cells)
from tributary.operators.selection import distinct_nonempty, rows_for_keys, windowed_fetch
from tributary.options import Options, Thresholds
from tributary.plans.normalise import (accepted, classify_committees, classify_facts,
                                       quarantined, record_counts)
from tributary.plans.stored import DATE, append_facts, raw_committees, raw_facts
from tributary.plans.summary_state import pinned
from tributary.schemas import RAW_COMMITTEES, RAW_FACTS
from tributary.session import stored
from tributary.sources import landing, layers as tables, ledger
from tributary.sources.layers import Layers

AMOUNT = "contribution_receipt_amount"


# ---- facts -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class FactRequest:
    """Which source records to load."""

    cycle: int
    since_watermark: bool = False
    min_date: dt.date | None = None
    max_date: dt.date | None = None
    lookback_days: int = 7
    state: str | None = None
    min_amount: float | None = None
    max_records: int | None = None
    memo_length: int | None = None


@dataclass(frozen=True)
class FactLoad:
    """``rows_cut`` are valid records inside the window that a cap left out."""

    window: Window
    loaded: bool
    summary: dict | None = None
    records: dict | None = None
    rows_cut: int = 0


def request_window(spark: SparkSession, layers: Layers, request: FactRequest, *,
                   options: Options = Options(), today: dt.date | None = None,
                   from_file: bool = False, bootstrap_days: int | None = None) -> Window:
    """Resolve the dates of a request; looks at the ledger or the raw table only for a watermark load."""
    mark = None
    if request.since_watermark and request.min_date is None:
        batches = ledger.entries(spark, layers)
        if batches:  # the ledger tells the dates of every batch, so no row is read
            today_is = pinned(spark, options).as_of
            mark = max((d for b in batches for d in b.dates if d is not None and d <= today_is), default=None)
        elif (raw := raw_facts(spark, layers)) is not None:
            mark = high_water_mark(raw, DATE, options.today()).first()["max_date"]
    return resolve_window(
        since_watermark=request.since_watermark, min_date=request.min_date,
        max_date=request.max_date, from_file=from_file, mark=mark,
        lookback_days=request.lookback_days, cycle=request.cycle, today=today,
        bootstrap_days=bootstrap_days)


def requested_facts(rows: DataFrame, request: FactRequest, window: Window) -> DataFrame:
    """Valid individual records of the request; the newest ones if it has a cap."""
    return windowed_fetch(
        rows, record_id="sub_id", event_date=DATE, amount=AMOUNT,
        period=("two_year_transaction_period", request.cycle), individuals_only="is_individual",
        region=("contributor_state", request.state) if request.state else None,
        min_amount=request.min_amount, min_date=window.min_date, max_date=window.max_date,
        max_records=request.max_records)


def ingest_facts(spark: SparkSession, layers: Layers, request: FactRequest, *,
                 run_at: dt.datetime, lines: DataFrame | None = None,
                 input_file: str | None = None, options: Options = Options(),
                 thresholds: Thresholds = Thresholds(), sample_path: str | None = None,
                 quarantine_path: str | None = None, dry_run: bool = False) -> FactLoad:
    """Load one batch, from source records or from a file of already normalised records.

    A file is loaded as it is: no window, no filters, no cap, no normalising. A dry run stops
    after the summary. An empty window is a success only for a watermark load. Source records
    are parsed once into a stored table; the counts, the window, the summary and the landed
    files all read that. The result tells how many records there were, how many were skipped or
    unreadable, and how many a cap cut; unreadable ones go to ``quarantine_path`` if given.
    """
    window = request_window(spark, layers, request, options=options,
                            today=options.as_of or run_at.date(),
                            from_file=input_file is not None,
                            bootstrap_days=thresholds.bootstrap_days)
    with ExitStack() as scratch:
        records, rows_cut = None, 0
        if input_file is not None:
            batch = scratch.enter_context(stored(
                landing.scan_ndjson(spark, input_file, RAW_FACTS), "records"))
        else:
            rows = scratch.enter_context(stored(
                classify_facts(lines, F.lit(run_at), request.memo_length), "records"))
            records = record_counts(rows)
            valid = accepted(rows)
            batch = requested_facts(valid, request, window)
            if request.max_records is not None:
                everything = requested_facts(valid, replace(request, max_records=None), window)
                rows_cut = max(0, everything.count() - request.max_records)
            if quarantine_path and not dry_run:
                quarantined(rows).write.mode("append").json(quarantine_path)
        if not should_load(batch, window):
            return FactLoad(window, loaded=False, records=records)
        if sample_path:
            landing.write_sample(batch, sample_path)
        summary = batch_summary(batch, thresholds)
        if not dry_run:
            load_facts(spark, layers, batch, run_at)
    return FactLoad(window, loaded=not dry_run, summary=summary, records=records,
                    rows_cut=rows_cut)


def load_facts(spark: SparkSession, layers: Layers, rows: DataFrame, run_at: dt.datetime) -> str:
    """Land one batch as NDJSON, then load the landed files; a run's time loads once."""
    path = landing.land(rows.select(*RAW_FACTS), layers.landed_facts, run_at)
    append_facts(landing.scan_ndjson(spark, path, RAW_FACTS), layers, f"run {run_at.isoformat()}")
    return path


def batch_summary(rows: DataFrame, thresholds: Thresholds = Thresholds()) -> dict:
    """What a load is about to bring, and how far one date dominates.

    Both one-row results come from one aggregate per (committee, state, date), computed once.
    """
    cells = summary_cells(rows, "committee_id", "contributor_state", DATE, AMOUNT)
    with stored(cells, "cells") as cells:
        totals = summary_of_cells(cells, "committee_id", "contributor_state", DATE).first()
        peak = peak_of_cells(cells, DATE, thresholds.peak_date_share).first()
    return {"totals": totals.asDict(), "peak": peak.asDict() if peak else None}


# ---- dimension -------------------------------------------------------------------------------

@dataclass(frozen=True)
class DimensionLoad:
    """``mode`` says why rows were wanted; no rows were wanted when it is "up to date"."""

    mode: str
    loaded: bool = False
    summary: dict | None = None
    records: dict | None = None


def dimension_summary(rows: DataFrame) -> dict:
    """Row count and the five most frequent parties."""
    parties = category_counts(rows, "party").collect()
    return {"committees": rows.count(), "parties": {r["party"]: r["n_rows"] for r in parties}}


def ingest_committees(spark: SparkSession, layers: Layers, lines: DataFrame, *,
                      now: dt.datetime, max_age_days: int = 7, dry_run: bool = False,
                      sample_path: str | None = None,
                      quarantine_path: str | None = None) -> DimensionLoad:
    """Append the dimension rows the loaded facts need.

    ``lines`` are the source system's records. Unreadable ones are counted, and written to
    ``quarantine_path`` if given. Facts without any committee are an error, as there is nothing
    the dimension could be loaded for.
    """
    facts = raw_facts(spark, layers)
    if facts is None:
        raise EmptyLoadError("load facts before the dimension")
    needed = distinct_nonempty(facts, "committee_id")
    existing = raw_committees(spark, layers)
    if existing is None:
        plan = needed.withColumn("mode", F.lit("full: nothing loaded"))
    else:
        plan = dimension_refresh_plan(facts, existing, "committee_id", "_loaded_at", now,
                                      max_age_days)
    with ExitStack() as scratch:
        plan = scratch.enter_context(stored(plan, "wanted"))
        first = plan.first()
        if first is None:
            if needed.isEmpty():
                raise EmptyLoadError("the facts name no committee")
            return DimensionLoad("up to date")
        rows = scratch.enter_context(stored(classify_committees(lines, F.lit(now)), "records"))
        if quarantine_path and not dry_run:
            quarantined(rows).write.mode("append").json(quarantine_path)
        wanted = rows_for_keys(accepted(rows).select(*RAW_COMMITTEES), plan, "committee_id")
        return _load_committees(wanted, layers, first["mode"], append=True, dry_run=dry_run,
                                sample_path=sample_path, records=record_counts(rows))


def ingest_committees_of_cycle(layers: Layers, lines: DataFrame, cycle: int, *,
                               loaded_at: Column | None = None, max_records: int | None = None,
                               dry_run: bool = False, sample_path: str | None = None,
                               quarantine_path: str | None = None) -> DimensionLoad:
    """Replace the dimension by the committees of one cycle.

    A source record names its cycles in an array ``cycles`` or a number ``cycle``. A cap, if
    asked for, keeps the first committees by identifier.
    """
    record = F.try_parse_json("line")
    listed = F.array_contains(F.try_variant_get(record, "$.cycles", "array<int>"), cycle)
    single = F.try_variant_get(record, "$.cycle", "int") == cycle
    with stored(classify_committees(lines, loaded_at), "records") as rows:
        if quarantine_path and not dry_run:
            quarantined(rows).write.mode("append").json(quarantine_path)
        in_cycle = rows.filter(F.col("reject_reason").isNull()).filter(
            F.coalesce(listed, single, F.lit(False))).select(*RAW_COMMITTEES)
        if max_records is not None:
            in_cycle = in_cycle.orderBy("committee_id").limit(max_records)
        return _load_committees(in_cycle, layers, "cycle", append=False, dry_run=dry_run,
                                sample_path=sample_path, records=record_counts(rows))


def ingest_committee_file(spark: SparkSession, layers: Layers, path: str, dry_run: bool = False,
                          sample_path: str | None = None) -> DimensionLoad:
    """Replace the dimension by a file of already normalised records."""
    return _load_committees(landing.scan_ndjson(spark, path, RAW_COMMITTEES), layers, "file",
                            append=False, dry_run=dry_run, sample_path=sample_path)


def _load_committees(rows: DataFrame, layers: Layers, mode: str, *, append: bool, dry_run: bool,
                     sample_path: str | None, records: dict | None = None) -> DimensionLoad:
    with stored(rows, "committees") as rows:
        if rows.isEmpty():
            raise EmptyLoadError("no committee records to load")
        if sample_path:
            landing.write_sample(rows, sample_path)
        summary = dimension_summary(rows)
        if not dry_run:
            tables.write_dimension(rows, layers.committees, append=append)
    return DimensionLoad(mode, loaded=not dry_run, summary=summary, records=records)
