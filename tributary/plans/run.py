"""Marts over stored tables, and the whole batch run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.incremental import EPOCH, upsert
from tributary.operators.quality import require_clean
from tributary.options import Options, Thresholds
from tributary.plans import check_state, marts, staging, summary_state
from tributary.plans.checks import dq_suite
from tributary.plans.ingest import (DimensionLoad, FactLoad, FactRequest, ingest_committees,
                                    ingest_facts)
from tributary.plans.stored import (DATE, daily_mart, dates_loaded_after, raw_committees, raw_facts,
                                    record_versions, staged_versions, summary_mart)
from tributary.schemas import RAW_COMMITTEES, ddl, mart_daily
from tributary.session import stored
from tributary.sources import export, layers as tables, versions
from tributary.sources.layers import Layers

# Staged columns that the summary and the assertions read.
STAGED_FOR_MARTS = ["sub_id", "committee_id", "contributor_name", "contributor_state", "amount",
                    DATE]

# ---- marts -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class MartRun:
    mode: str
    touched_keys: int | None = None
    touched_dates: int | None = None


def _starts(dates: list[dt.date], grain: str) -> list[dt.date]:
    starts = {"day": lambda d: d, "month": lambda d: d.replace(day=1),
              "year": lambda d: d.replace(month=1, day=1)}
    return [starts[grain](d) for d in dates]


def _in_partitions(dates: list[dt.date], grain: str) -> Column:
    """Predicate on the partition column that covers some dates."""
    values = sorted(set(_starts(dates, grain)))
    return F.col(tables.grain_column(DATE, grain)).isin(values)


def _committees(spark: SparkSession, layers: Layers, options: Options) -> DataFrame:
    dimension = raw_committees(spark, layers)
    if dimension is None:
        dimension = spark.createDataFrame([], ddl(RAW_COMMITTEES))
    return staging.stg_committees(dimension, options)


def _commit_daily(rows: DataFrame, layers: Layers, base: versions.Commit | None,
                  touched: list[str] | None, options: Options) -> None:
    """Write mart rows beside the table, then put them in place together with the new mark."""
    spark, part = rows.sparkSession, tables.grain_column(DATE, layers.grain)
    arranged = tables.arranged(rows, DATE, layers.grain, ["committee_id"])
    version, values = versions.write_version(arranged, layers.daily, part)
    kind = options.loaded_at_type
    written = spark.read.schema(f"last_loaded_at {kind}").parquet(f"{layers.daily}/data/version={version}")
    newest = written.agg(F.max("last_loaded_at")).first()[0] if values else None
    old = dt.datetime.fromisoformat(base.notes["mark"]) if base and touched is not None else EPOCH
    mark = max(old, newest) if newest else old
    gone = base.parts if base and touched is None else touched or []
    versions.commit(spark, layers.daily, base, version, values, gone, {"mark": mark.isoformat()})


def refresh_daily(spark: SparkSession, layers: Layers, options: Options = Options(),
                  full_refresh: bool = False, repair_moved_keys: bool = False) -> MartRun:
    """Build or update the daily mart.

    An incremental run looks for new raw rows in the dates of the batches behind the load-time
    mark, recomputes the keys they touch from the touched dates only, and replaces only those
    partitions. Versions of these records elsewhere come from the bucketed index. Partitions and
    mark change in one commit: a run that breaks off at any step leaves the old mart readable and
    the old mark, and the next one does its work again. A record that moved to another key leaves
    its old mart row behind; ``repair_moved_keys`` also recomputes the keys its earlier versions
    had, and a full refresh repairs everything.
    """
    raw = raw_facts(spark, layers)
    if raw is None:
        raise RuntimeError("no raw facts to build from")
    committees = _committees(spark, layers, options)
    base = versions.head(spark, layers.daily)

    if full_refresh or base is None:
        rows = marts.daily_contributions(staged_versions(spark, layers, options), committees, options)
        _commit_daily(rows, layers, base, None, options)
        return MartRun("full")

    mark = dt.datetime.fromisoformat(base.notes["mark"])
    dates = dates_loaded_after(spark, layers, mark)
    if dates is not None and not dates:
        return MartRun("incremental", 0, 0)
    new = raw if dates is None else raw.filter(
        _in_partitions(dates, layers.grain) & F.col(DATE).isin(dates))
    lookup = record_versions(spark, layers)
    touched = marts.touched_since(new, F.lit(mark), options, repair_moved_keys, lookup)
    if touched.n_keys == 0:
        return MartRun("incremental", 0, 0)

    parts = _in_partitions(touched.dates, layers.grain)
    rows = marts.daily_of_touched(raw, committees, touched, options, parts, lookup)
    part = tables.grain_column(DATE, layers.grain)
    values = sorted({versions.part_text(d) for d in _starts(touched.dates, layers.grain)})
    columns = mart_daily(options.amount_type, options.average_type, options.loaded_at_type)
    current = versions.read(spark, layers.daily, columns, part, state=base, only=values)
    merged = upsert(current.select(*rows.columns), rows, marts.DAILY_KEYS, replaced=touched.keys)
    _commit_daily(merged, layers, base, values, options)
    return MartRun("incremental", touched.n_keys, len(touched.dates))


def refresh_summary(spark: SparkSession, layers: Layers, options: Options = Options(),
                    staged: DataFrame | None = None) -> None:
    """Full rebuild of the committee mart, from staged rows that are stored already if given."""
    if staged is None:
        staged = staged_versions(spark, layers, options)
    rows = marts.committee_summary(staged, _committees(spark, layers, options), options)
    versions.replace(rows, layers.summary)


def update_summary(spark: SparkSession, layers: Layers, options: Options = Options()) -> int:
    """The committee mart from its counted state, brought up to the newest batch; committees touched."""
    touched = summary_state.update(spark, layers, options)
    rows = marts.with_committee_facts(summary_state.stats(spark, layers, options),
                                      _committees(spark, layers, options))
    versions.replace(rows, layers.summary)
    return touched


# ---- whole run -------------------------------------------------------------------------------

@dataclass
class RunReport:
    facts: FactLoad | None = None
    dimension: DimensionLoad | None = None
    daily: MartRun | None = None
    exported: list[str] = field(default_factory=list)


def check_marts(spark: SparkSession, layers: Layers, staged: DataFrame,
                options: Options = Options(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(assertion, failing_rows) over the stored tables."""
    dimension = staging.stg_committees(raw_committees(spark, layers), options)
    return dq_suite(staged, dimension, daily_mart(spark, layers, options),
                    summary_mart(spark, layers, options), options, thresholds)


def staged_for_marts(spark: SparkSession, layers: Layers,
                     options: Options = Options()) -> DataFrame:
    """The staged columns that the summary and the assertions read."""
    return staged_versions(spark, layers, options).select(*STAGED_FOR_MARTS)


def publish_staging(spark: SparkSession, layers: Layers, options: Options = Options()) -> None:
    """Both staging views under their names, for queries in the same session."""
    tables.publish_view(staging.stg_contributions(raw_facts(spark, layers), options),
                        "stg_contributions")
    tables.publish_view(staging.stg_committees(raw_committees(spark, layers), options),
                        "stg_committees")


def build_and_check(spark: SparkSession, layers: Layers, options: Options = Options(),
                    thresholds: Thresholds = Thresholds(), full_refresh: bool = False,
                    repair_moved_keys: bool = False, counted_summary: bool = False) -> MartRun:
    """Both marts, then every assertion; fails on the first set of failing rows.

    ``counted_summary`` updates the summary and the assertions from their states: only records of new
    batches and mart partitions that changed are read, and the verdicts are those of the whole suite.
    """
    daily = refresh_daily(spark, layers, options, full_refresh, repair_moved_keys)
    if counted_summary:
        update_summary(spark, layers, options)
        check_state.update(spark, layers, options)
        require_clean(check_state.results(spark, layers, options, thresholds))
    else:
        # The summary and four assertions read the staged rows: deduplicate once and store them.
        with stored(staged_for_marts(spark, layers, options), "staged") as staged:
            refresh_summary(spark, layers, options, staged)
            require_clean(check_marts(spark, layers, staged, options, thresholds))
    publish_staging(spark, layers, options)
    return daily


def export_marts(spark: SparkSession, layers: Layers, options: Options = Options(), *,
                 project: str = "", exported_at: dt.datetime | None = None,
                 publish_to: str | None = None) -> list[str]:
    """Write the three snapshots; optionally publish them as one at a serving location."""
    daily = daily_mart(spark, layers, options)
    summary = summary_mart(spark, layers, options)
    root = layers.export_path("current")
    export.write_snapshots(root, export.export_daily(daily, summary),
                           export.export_summary(summary),
                           export.export_meta(daily, summary, project=project,
                                              dataset=layers.mart, exported_at=exported_at))
    return export.publish(spark, root, publish_to) if publish_to else []


def run_batch(spark: SparkSession, layers: Layers, fact_lines: DataFrame,
              committee_lines: DataFrame, request: FactRequest, *, run_at: dt.datetime,
              options: Options = Options(), thresholds: Thresholds = Thresholds(),
              full_refresh: bool = False, repair_moved_keys: bool = False,
              project: str = "") -> RunReport:
    """One run, stopping at the first failure: load, dimension, marts, assertions, export.

    ``fact_lines`` and ``committee_lines`` are the source system's records, one JSON text per
    row.
    """
    report = RunReport()
    report.facts = ingest_facts(spark, layers, request, lines=fact_lines, run_at=run_at,
                                options=options, thresholds=thresholds)
    report.dimension = ingest_committees(spark, layers, committee_lines, now=run_at,
                                         max_age_days=thresholds.dimension_max_age_days)
    report.daily = build_and_check(spark, layers, options, thresholds, full_refresh,
                                   repair_moved_keys)
    report.exported = export_marts(spark, layers, options, project=project, exported_at=run_at,
                                   publish_to=layers.export_path("published"))
    return report
