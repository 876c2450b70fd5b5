"""One callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.functions import calendar, labels
from tributary.operators import concentration, quality, rollup, selection
from tributary.operators.dedupe import duplicate_key_count, latest_wins
from tributary.operators.incremental import (affected_keys, dimension_refresh_plan,
                                             existing_dimension_state, high_water_mark,
                                             rows_after_mark, watermark_window)
from tributary.options import Thresholds
from tributary.plans import check_state, ingest, marts, normalise, reports, run, staging
from tributary.plans.checks import dq_suite
from tributary.plans.stored import append_facts, raw_committees
from tributary.registry import adapters, wire
from tributary.registry.adapters import AS_OF, FIRST_LOAD_END, NOW, OPTIONS
from tributary.schemas import RAW_FACTS, ddl
from tributary.session import scratch_path, store
from tributary.sources import export, footers, landing, layers as tables
from tributary.sources.layers import Layers
from tributary.streaming.latest import latest_versions

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DATE = "contribution_receipt_date"
AMOUNT = "contribution_receipt_amount"


def query(key: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return register


# ---- shared relations ------------------------------------------------------------------------

def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_contributions(adapters.contributions(spark, sf), OPTIONS)


def _committees(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_committees(adapters.committees(spark, sf), OPTIONS)


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.committee_summary(_staged(spark, sf), _committees(spark, sf), OPTIONS)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_contributions(_staged(spark, sf), _committees(spark, sf), OPTIONS)


def _feed_staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_contributions(adapters.feed(spark, sf), OPTIONS)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` stored once, as the several readers of a mart would find it."""
    return store(df, scratch_path(df.sparkSession, "kept"))


def _feed_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The daily mart as it stood after the first load, stored as an update finds it."""
    first = adapters.feed(spark, sf).filter(F.col("_loaded_at") < F.lit(FIRST_LOAD_END).cast(
        "timestamp_ntz"))
    return _kept(marts.daily_contributions(staging.stg_contributions(first, OPTIONS),
                                           _committees(spark, sf), OPTIONS))


# ---- normalisation and staging ---------------------------------------------------------------

def _wire_time():
    return F.lit(NOW).cast("timestamp_ntz")


@query("normalize_contributions")
def q_normalize_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.normalise_facts(wire.fact_lines(spark, sf), _wire_time())


@query("normalize_outcomes")
def q_normalize_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.reject_counts(
        normalise.classify_facts(wire.fact_lines(spark, sf), _wire_time()))


@query("normalize_committees")
def q_normalize_committees(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.normalise_committees(wire.committee_lines(spark, sf), _wire_time())


@query("scan_ndjson")
def q_scan_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    """Raw facts written as landing files and scanned back with the declared schema."""
    path = landing.land(adapters.contributions(spark, sf), scratch_path(spark, "landing"),
                        dt.datetime(2001, 8, 5, 12, 0, tzinfo=dt.UTC))
    rows = landing.scan_ndjson(spark, path, {**RAW_FACTS, "_loaded_at": "timestamp_ntz"})
    return rows.select("sub_id", "committee_id", "contributor_state", AMOUNT, DATE,
                       "is_individual", "two_year_transaction_period", "_loaded_at")


@query("stg_contributions")
def q_stg_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf)


@query("stg_committees")
def q_stg_committees(spark: SparkSession, sf: str) -> DataFrame:
    return _committees(spark, sf)


@query("dedupe_latest")
def q_dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Last shipped line of every order."""
    return latest_wins(adapters.shipments(spark, sf), ["l_orderkey"],
                       ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "price",
                        "l_returnflag"])


@query("valid_and_skipped")
def q_valid_and_skipped(spark: SparkSession, sf: str) -> DataFrame:
    return selection.valid_and_skipped(adapters.contributions(spark, sf), "sub_id", DATE, AMOUNT)


# ---- fetches and key sets --------------------------------------------------------------------

def _window(spark: SparkSession, sf: str, max_records: int | None) -> DataFrame:
    rows = selection.windowed_fetch(
        adapters.contributions(spark, sf),
        record_id="sub_id", event_date=DATE, amount=AMOUNT, max_records=max_records,
        period=("two_year_transaction_period", 1998), individuals_only="is_individual",
        region=("contributor_state", "1-URGENT"), min_amount=1000,
        min_date=dt.date(1997, 2, 1), max_date=dt.date(1998, 11, 30))
    return rows.select("sub_id", "committee_id", AMOUNT, DATE)


@query("windowed_fetch")
def q_windowed_fetch(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, 250)


@query("windowed_fetch_all")
def q_windowed_fetch_all(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, None)


@query("dim_fetch_by_ids")
def q_dim_fetch_by_ids(spark: SparkSession, sf: str) -> DataFrame:
    needed = selection.distinct_nonempty(adapters.contributions(spark, sf), "committee_id")
    rows = selection.rows_for_keys(adapters.committees(spark, sf), needed, "committee_id")
    return rows.select("committee_id", "name", "party", "_loaded_at")


@query("dim_fetch_by_cycle")
def q_dim_fetch_by_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that ordered in the 2000 cycle."""
    orders = adapters.table(spark, sf, "orders")
    cycle = calendar.election_cycle(F.col("o_orderdate"))
    cycles = orders.groupBy("o_custkey").agg(F.collect_set(cycle).alias("cycles"))
    rows = selection.rows_for_cycle(cycles, "cycles", 2000)
    return rows.select(F.col("o_custkey").alias("c_custkey"),
                       F.size("cycles").cast("bigint").alias("n_cycles"))


@query("needed_dim_keys")
def q_needed_dim_keys(spark: SparkSession, sf: str) -> DataFrame:
    return selection.distinct_nonempty(adapters.contributions(spark, sf), "committee_id")


@query("existing_dim_state")
def q_existing_dim_state(spark: SparkSession, sf: str) -> DataFrame:
    return existing_dimension_state(adapters.committees(spark, sf), "committee_id", "_loaded_at")


@query("dim_delta_keys")
def q_dim_delta_keys(spark: SparkSession, sf: str) -> DataFrame:
    needed = selection.distinct_nonempty(adapters.contributions(spark, sf), "committee_id")
    return selection.keys_missing_from(needed, adapters.committees(spark, sf),
                                       "committee_id").orderBy("committee_id")


@query("dim_refresh_plan")
def q_dim_refresh_plan(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_refresh_plan(adapters.contributions(spark, sf),
                                  adapters.committees(spark, sf), "committee_id", "_loaded_at",
                                  now=NOW)


@query("dim_refresh_plan_stale")
def q_dim_refresh_plan_stale(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_refresh_plan(adapters.contributions(spark, sf),
                                  adapters.committees(spark, sf), "committee_id", "_loaded_at",
                                  now=NOW + dt.timedelta(days=30))


# ---- marts -----------------------------------------------------------------------------------

@query("committee_summary")
def q_committee_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf)


@query("daily_contributions")
def q_daily_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf)


def _supplier_summary(spark: SparkSession, sf: str) -> DataFrame:
    stats = rollup.grouped_stats(
        adapters.shipments(spark, sf), ["l_suppkey"],
        n_lines=F.count("*"), total_price=F.sum("price"),
        avg_price=rollup.average("price", "double"), min_price=F.min("price"),
        max_price=F.max("price"), n_orders=F.count_distinct("l_orderkey"),
        n_parts=F.count_distinct("l_partkey"), first_ship=F.min("ship_date"),
        last_ship=F.max("ship_date"))
    supplier = adapters.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nation = adapters.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return stats.join(supplier, "l_suppkey", "left").join(nation, "s_nationkey", "left") \
        .drop("s_nationkey")


@query("supplier_summary")
def q_supplier_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The same aggregate-then-enrich plan over shipped lines."""
    return _supplier_summary(spark, sf)


@query("daily_shipments")
def q_daily_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.grouped_stats(
        adapters.shipments(spark, sf), ["ship_date", "l_suppkey"],
        n_lines=F.count("*"), total_price=F.sum("price"),
        avg_price=rollup.average("price", "double"),
        n_flags=F.count_distinct("l_returnflag"))


# ---- incremental -----------------------------------------------------------------------------

@query("high_water_mark")
def q_high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return high_water_mark(adapters.contributions(spark, sf), DATE, F.lit(AS_OF))


@query("watermark_window")
def q_watermark_window(spark: SparkSession, sf: str) -> DataFrame:
    return watermark_window(adapters.contributions(spark, sf), DATE, F.lit(AS_OF), 7)


@query("incremental_new_rows")
def q_incremental_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = rows_after_mark(_feed_staged(spark, sf), "loaded_at", _feed_mart(spark, sf),
                           "last_loaded_at")
    return rows.select("sub_id", "committee_id", "amount", DATE, "loaded_at")


@query("affected_keys")
def q_affected_keys(spark: SparkSession, sf: str) -> DataFrame:
    return affected_keys(
        rows_after_mark(_feed_staged(spark, sf), "loaded_at", _feed_mart(spark, sf),
                        "last_loaded_at"), marts.DAILY_KEYS)


@query("affected_key_recompute")
def q_affected_key_recompute(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_recomputed(adapters.feed(spark, sf), _committees(spark, sf),
                                  _feed_mart(spark, sf), OPTIONS)


@query("merge_upsert")
def q_merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_merged(adapters.feed(spark, sf), _committees(spark, sf),
                              _feed_mart(spark, sf), OPTIONS)


def _feed_tables(spark: SparkSession, sf: str, grain: str) -> Layers:
    """Raw tables and daily mart of the feed, after a first full and one incremental run."""
    at = Layers(scratch_path(spark, "layers"), grain=grain)
    raw = adapters.feed(spark, sf).withColumn("memo_text", F.lit("")).select(
        *[F.col(c).cast(kind).alias(c) for c, kind in RAW_FACTS.items()])
    first_end = F.lit(FIRST_LOAD_END).cast("timestamp_ntz").cast("timestamp")
    tables.write_dimension(adapters.committees(spark, sf).withColumn(
        "_loaded_at", F.col("_loaded_at").cast("timestamp")), at.committees, append=False)
    append_facts(raw.filter(F.col("_loaded_at") < first_end), at)
    run.refresh_daily(spark, at, OPTIONS)
    append_facts(raw.filter(F.col("_loaded_at") >= first_end), at)
    run.refresh_daily(spark, at, OPTIONS)
    return at


def _built_tables(spark: SparkSession, sf: str) -> Layers:
    """Raw tables, both marts and published snapshots of a whole run."""
    at = Layers(scratch_path(spark, "layers"), grain="month")
    raw = adapters.contributions(spark, sf).select(
        *[F.col(c).cast(kind).alias(c) for c, kind in RAW_FACTS.items()])
    append_facts(raw, at)
    tables.write_dimension(adapters.committees(spark, sf).withColumn(
        "_loaded_at", F.col("_loaded_at").cast("timestamp")), at.committees, append=False)
    run.refresh_daily(spark, at, OPTIONS)
    run.refresh_summary(spark, at, OPTIONS)
    run.export_marts(spark, at, OPTIONS, exported_at=NOW, publish_to=at.export_path("published"))
    return at


def _published(spark: SparkSession, sf: str, name: str) -> DataFrame:
    target = _built_tables(spark, sf).export_path("published")
    path = export.published(spark, target)[name]
    return spark.read.schema(ddl(export.SNAPSHOTS[name][0])).json(path)


@query("pipeline_run")
def q_pipeline_run(spark: SparkSession, sf: str) -> DataFrame:
    """The daily snapshot that a whole run publishes, read back from its files."""
    return _published(spark, sf, "daily_contributions")


@query("published_summary")
def q_published_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf, "committee_summary")


@query("dimension_reload")
def q_dimension_reload(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension landed as JSON, loaded over an older one, and read back."""
    at = Layers(scratch_path(spark, "layers"))
    rows = adapters.committees(spark, sf).withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp"))
    tables.write_dimension(rows.limit(1), at.committees, append=False)
    path = landing.land(rows, f"{at.root}/landing/committees",
                        dt.datetime(2001, 8, 5, 12, 0, tzinfo=dt.UTC))
    ingest.ingest_committee_file(spark, at, path)
    loaded = raw_committees(spark, at)
    return loaded.select("committee_id", "name", "party", "party_full", "state",
                         F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"))


@query("incremental_run")
def q_incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    """The stored mart after a first run and an incremental run over partitioned tables."""
    at = _feed_tables(spark, sf, "day")
    mart = run.daily_mart(spark, at, OPTIONS)
    return mart


def _summary_in_batches(spark: SparkSession, sf: str, after: Callable[[Layers], None] | None = None) -> Layers:
    """Raw facts loaded as three batches, the summary updated after each, and whatever comes ``after``."""
    at = Layers(scratch_path(spark, "layers"), grain="year")
    raw = adapters.contributions(spark, sf).select(
        *[F.col(c).cast(kind).alias(c) for c, kind in RAW_FACTS.items()])
    tables.write_dimension(adapters.committees(spark, sf).withColumn(
        "_loaded_at", F.col("_loaded_at").cast("timestamp")), at.committees, append=False)
    loaded = F.col("_loaded_at")
    cuts = [F.lit(x).cast("timestamp") for x in (dt.datetime(1998, 1, 1), dt.datetime(2000, 6, 1))]
    for k, batch in enumerate((raw.filter(loaded < cuts[0]), raw.filter((loaded >= cuts[0]) & (loaded < cuts[1])),
                               raw.filter(loaded >= cuts[1]))):
        append_facts(batch, at, f"batch {k}")
        append_facts(batch, at, f"batch {k}")  # a batch that runs again adds nothing
        run.update_summary(spark, at, OPTIONS)
        if after:
            after(at)
    return at


@query("counted_summary")
def q_counted_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The committee mart after three batches, each merged into its counted state."""
    return run.summary_mart(spark, _summary_in_batches(spark, sf), OPTIONS)


@query("loaded_once")
def q_loaded_once(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows per year after batches that ran twice."""
    raw = run.raw_facts(spark, _summary_in_batches(spark, sf))
    return raw.groupBy(F.year(DATE).alias("year")).agg(F.count("*").alias("n_rows"),
                                                       F.count_distinct("sub_id").alias("n_records"))


# ---- quality ---------------------------------------------------------------------------------

@query("dq_unique")
def q_dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Fails on purpose: raw facts hold several versions per record."""
    return quality.not_unique(adapters.contributions(spark, sf), "sub_id")


@query("dq_not_null")
def q_dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(adapters.contributions(spark, sf),
                               ["sub_id", "committee_id", AMOUNT, DATE])


@query("dq_no_future")
def q_dq_no_future(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dated_after(_staged(spark, sf), "sub_id", DATE, F.lit(AS_OF))


@query("dq_min_volume")
def q_dq_min_volume(spark: SparkSession, sf: str) -> DataFrame:
    return quality.below_volume(_staged(spark, sf), 1_000_000_000)


@query("dq_positive_count")
def q_dq_positive_count(spark: SparkSession, sf: str) -> DataFrame:
    """Committees whose refunds exceed what they raised."""
    return quality.not_positive(_summary(spark, sf), ["committee_id"], "total_raised")


@query("orphan_ratio")
def q_orphan_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage(_staged(spark, sf), _committees(spark, sf), "committee_id")


@query("orphan_ratio_breach")
def q_orphan_ratio_breach(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage_breach(_staged(spark, sf), _committees(spark, sf), "committee_id",
                                   0.01)


@query("orphan_keys")
def q_orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphan_keys(_staged(spark, sf), _committees(spark, sf), "committee_id")


@query("freshness")
def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.freshness(adapters.contributions(spark, sf), "_loaded_at", now=NOW,
                             max_age_hours=24)


@query("dq_suite")
def q_dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Every assertion, over stored staged rows and marts as a run checks them."""
    staged = _kept(_staged(spark, sf).select(*run.STAGED_FOR_MARTS, "loaded_at"))
    committees = _committees(spark, sf)
    return dq_suite(staged, committees,
                    _kept(marts.daily_contributions(staged, committees, OPTIONS)),
                    _kept(marts.committee_summary(staged, committees, OPTIONS)), OPTIONS,
                    Thresholds())


@query("dq_incremental")
def q_dq_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Every assertion from counts that were merged after each of three batches."""
    def check(at: Layers) -> None:
        run.refresh_daily(spark, at, OPTIONS)
        check_state.update(spark, at, OPTIONS)

    return check_state.results(spark, _summary_in_batches(spark, sf, check), OPTIONS)


@query("duplicate_key_count")
def q_duplicate_key_count(spark: SparkSession, sf: str) -> DataFrame:
    raw = duplicate_key_count(adapters.contributions(spark, sf), ["sub_id"])
    staged = duplicate_key_count(_staged(spark, sf), ["sub_id"])
    return raw.select(F.lit("raw").alias("layer"), "duplicate_keys").unionByName(
        staged.select(F.lit("staging").alias("layer"), "duplicate_keys"))


# ---- summaries and reports -------------------------------------------------------------------

@query("layer_counts")
def q_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.layer_counts({
        "raw": adapters.contributions(spark, sf),
        "staging": _staged(spark, sf),
        "mart (daily)": _daily(spark, sf),
        "mart (committee)": _summary(spark, sf),
    })


@query("footer_counts")
def q_footer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and extreme keys of the stored tables, from their footers."""
    keys = {"customer": "c_custkey", "events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey"}
    return footers.table_extremes(spark, {t: (f"{sf}/{t}.parquet", key) for t, key in keys.items()})


@query("latest_in_sessions")
def q_latest_in_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event of each user's sessions of one hour, as the stream keeps it."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "user_id", "value")
    return latest_versions(events, ["user_id"], ["ts", "event_id"], "ts", "1 hour")


@query("load_summary")
def q_load_summary(spark: SparkSession, sf: str) -> DataFrame:
    raw = adapters.contributions(spark, sf).withColumn(AMOUNT, F.col(AMOUNT).cast("decimal(18,2)"))
    return rollup.load_summary(raw, entity_id="committee_id", region="contributor_state",
                               event_date=DATE, amount=AMOUNT)


@query("date_concentration")
def q_date_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.date_concentration(_staged(spark, sf), DATE, "amount")


@query("dim_party_counts")
def q_dim_party_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.category_counts(adapters.committees(spark, sf), "party")


@query("month_total_pruned")
def q_month_total_pruned(spark: SparkSession, sf: str) -> DataFrame:
    raw = adapters.contributions(spark, sf)
    return selection.total_between(raw, F.col(AMOUNT).cast("decimal(18,2)"), DATE,
                                   dt.date(1998, 6, 1), dt.date(1998, 6, 30))


@query("whole_total")
def q_whole_total(spark: SparkSession, sf: str) -> DataFrame:
    raw = adapters.contributions(spark, sf)
    return selection.total_between(raw, F.col(AMOUNT).cast("decimal(18,2)"), DATE)


@query("party_filter")
def q_party_filter(spark: SparkSession, sf: str) -> DataFrame:
    return reports.for_party(_summary(spark, sf), "Democratic-Farmer-Labor").select(
        "committee_id", "committee_name", "party", "party_full", "total_raised")


@query("party_label")
def q_party_label(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf).select("committee_id", reports.label().alias("party_label"))


@query("party_class")
def q_party_class(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf).select(
        "committee_id", labels.party_class(reports.label()).alias("party_class"))


@query("unique_parties")
def q_unique_parties(spark: SparkSession, sf: str) -> DataFrame:
    return reports.parties(_summary(spark, sf))


@query("party_rollup")
def q_party_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return reports.party_rollup(_summary(spark, sf))


@query("party_rollup_sql")
def q_party_rollup_sql(spark: SparkSession, sf: str) -> DataFrame:
    return reports.party_full_rollup(_summary(spark, sf))


@query("daily_to_committee_rollup")
def q_daily_to_committee_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return reports.committees_from_daily(_daily(spark, sf))


@query("top_committees")
def q_top_committees(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_committees(_summary(spark, sf))


@query("top10_report")
def q_top10_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_report(_summary(spark, sf))


@query("kpi_strip")
def q_kpi_strip(spark: SparkSession, sf: str) -> DataFrame:
    return reports.kpis(_summary(spark, sf), _daily(spark, sf), "GREEN PARTY")


@query("concentration_bands")
def q_concentration_bands(spark: SparkSession, sf: str) -> DataFrame:
    return reports.bands(_summary(spark, sf))


@query("concentration_ladder")
def q_concentration_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ladder(_summary(spark, sf))


@query("concentration_summary")
def q_concentration_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.concentration_total(_summary(spark, sf), "GREEN PARTY")


@query("committee_ranking")
def q_committee_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return reports.committee_ranking(_summary(spark, sf))


@query("newest_shipments")
def q_newest_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """The newest half of the shipped lines; those of an order share an identifier."""
    lines = adapters.shipments(spark, sf).select("l_orderkey", "l_linenumber", "ship_date", "price")
    return selection.newest_rows(lines, "ship_date", "l_orderkey", 20_000, ["l_linenumber", "price"], small=50)


@query("supplier_concentration")
def q_supplier_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return concentration.concentration_bands(
        _supplier_summary(spark, sf).withColumn("l_suppkey", F.col("l_suppkey").cast("string")),
        "total_price", "l_suppkey", "s_name")


@query("format_report")
def q_format_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.formatted(_summary(spark, sf))


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return adapters.table(spark, sf, "orders").select(day.alias("day")).distinct()


@query("election_cycle")
def q_election_cycle(spark: SparkSession, sf: str) -> DataFrame:
    cycle = calendar.election_cycle(F.col("day"))
    return _order_days(spark, sf).select("day", cycle.cast("bigint").alias("cycle"))


@query("bootstrap_min_date")
def q_bootstrap_min_date(spark: SparkSession, sf: str) -> DataFrame:
    """First day a fresh load on each order day would ask for."""
    cycle = calendar.election_cycle(F.col("day"))
    start = calendar.bootstrap_start(cycle, F.col("day"), 365)
    return _order_days(spark, sf).select("day", start.alias("min_date"))


# ---- exports ---------------------------------------------------------------------------------

@query("export_daily")
def q_export_daily(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_daily(_daily(spark, sf), _summary(spark, sf))


@query("export_summary")
def q_export_summary(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_summary(_summary(spark, sf))


@query("export_meta")
def q_export_meta(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_meta(_daily(spark, sf), _summary(spark, sf), project="local",
                              dataset="mart", exported_at=F.lit(NOW).cast("timestamp_ntz"))
