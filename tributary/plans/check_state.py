"""The assertions kept up to date from counted results, without reading untouched rows.

Every assertion over facts is a sum over rows, so the state holds sums that merge: staged rows, nulls and
repeated ids by date, staged rows by committee, and failing rows by partition of the daily mart. A batch
touches some records: each one's former version is taken back and its present one added, as the counted
summary does. Of the daily mart, those partitions count again whose version differs from the one counted
before; its commit names them. The dimension and the committee mart hold one row per committee and are
checked whole. State rows (kind, day, committee_id, part, counted_in, n) are pieces of one versioned table;
committees are spread over shards, of which a batch reads and replaces the ones it touches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators import quality
from tributary.options import Options, Thresholds
from tributary.plans import staging
from tributary.plans.checks import NOT_NULL, UNIQUE
from tributary.plans.stored import DATE, raw_committees, raw_facts, staged_versions, summary_mart
from tributary.plans.summary_state import changed_records, pinned
from tributary.schemas import mart_daily
from tributary.session import settle
from tributary.sources import layers as tables, ledger, versions
from tributary.sources.layers import Layers

SHARDS = 32
COLUMNS = {"kind": "string", "day": "date", "committee_id": "string", "part": "string", "counted_in": "string", "n": "bigint"}
STAGED, DAILY = "stg_contributions", "daily_contributions"
_GROUP = [c for c in COLUMNS if c != "n"]


def _cells(rows: DataFrame, kinds: dict[str, Column], sign: int = 1, **keys: Column) -> DataFrame:
    """One state row per kind and key: ``sign`` times the rows that meet the kind's condition."""
    totals = rows.groupBy(*[v.alias(c) for c, v in keys.items()]).agg(
        *[(F.count_if(test) * sign).alias(f"k{i}") for i, test in enumerate(kinds.values())])
    named = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"k{i}").cast("bigint").alias("n"))
                      for i, kind in enumerate(kinds)])
    out = totals.select(*keys, F.inline(named))
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items()])


def _of_staged(rows: DataFrame, sign: int) -> DataFrame:
    """Counts of staged rows by date and by committee, and how many ids repeat."""
    nulls = {f"not_null:{STAGED}.{c}": F.col(c).isNull() for c in NOT_NULL[STAGED]}
    by_day = _cells(rows, {"rows": F.lit(True), **nulls}, sign, day=F.col(DATE))
    by_committee = _cells(rows, {"facts": F.lit(True)}, sign, committee_id=F.col("committee_id"))
    repeated = quality.not_unique(rows, UNIQUE[STAGED])
    return by_day.unionByName(by_committee).unionByName(
        _cells(repeated, {f"unique:{STAGED}.{UNIQUE[STAGED]}": F.lit(True)}, sign))


def _of_daily(rows: DataFrame, part: str, version_of: dict[str, str]) -> DataFrame:
    """Failing rows of some partitions of the daily mart, with the version they were counted in."""
    tests = {f"not_null:{DAILY}.{c}": F.col(c).isNull() for c in NOT_NULL[DAILY]}
    tests[f"positive:{DAILY}.contribution_count"] = F.col("contribution_count") <= 0
    value = F.coalesce(F.col(part).cast("string"), F.lit(versions.NULL))
    counted = _cells(rows, tests, part=value).filter("n <> 0")
    spark = rows.sparkSession
    seen = spark.createDataFrame(list(version_of.items()), "part string, counted_in string")
    noted = seen.select(F.lit("version").alias("kind"), "part", "counted_in", F.lit(1).cast("bigint").alias("n"))
    return counted.drop("counted_in").join(F.broadcast(seen), "part").unionByName(noted, allowMissingColumns=True)


def _piece() -> Column:
    shard = F.pmod(F.xxhash64("committee_id"), F.lit(SHARDS)).cast("string")
    return (F.when(F.col("kind") == "facts", F.concat(F.lit("committees-"), shard))
            .when(F.col("part").isNotNull(), "daily").otherwise("days"))


def update(spark: SparkSession, layers: Layers, options: Options = Options()) -> list[str]:
    """Bring the state up to the newest batch and the daily mart; returns the mart partitions it read."""
    at = pinned(spark, options)
    base = versions.head(spark, layers.check_state)
    batches = ledger.entries(spark, layers)
    applied = int(base.notes["batch"]) if base else 0
    then = dt.date.fromisoformat(base.notes["as_of"]) if base else at.as_of
    if at.as_of < then:
        raise ValueError("the state was made for a later day")
    newest = max((b.number for b in batches), default=0)
    if base is None:
        delta = _of_staged(settle(staged_versions(spark, layers, at)), 1)
    elif newest == applied and at.as_of == then:
        delta = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
    else:
        former, present = changed_records(spark, layers, batches, applied, then, at)
        delta = _of_staged(settle(former), -1).unionByName(_of_staged(settle(present), 1))
    delta = settle(delta.withColumn("piece", _piece()))

    part = tables.grain_column(DATE, layers.grain)
    mart = versions.head(spark, layers.daily) or versions.Commit()
    counted = {}
    if base and "daily" in base.parts:
        counted = {r["part"]: r["counted_in"] for r in _read(spark, layers, base, ["daily"]).filter(
            "kind = 'version'").collect()}
    changed = sorted(p for p, v in mart.parts.items() if counted.get(p) != v)
    gone = sorted(set(counted) - set(mart.parts))
    touched = {r[0] for r in delta.select("piece").distinct().collect()}
    fresh = delta.drop("piece")
    if changed or gone:
        touched.add("daily")
    if not touched:
        return changed
    if changed:
        columns = mart_daily(at.amount_type, at.average_type, at.loaded_at_type)
        rows = versions.read(spark, layers.daily, columns, part, state=mart, only=changed)
        fresh = fresh.unionByName(_of_daily(rows, part, {p: mart.parts[p] for p in changed}).select(*COLUMNS))
    if base:
        kept = _read(spark, layers, base, sorted(touched))
        replaced = changed + gone
        fresh = fresh.unionByName(kept.filter(F.col("part").isNull() | ~F.col("part").isin(replaced)))
    merged = fresh.groupBy(*_GROUP).agg(F.sum("n").alias("n")).filter("n <> 0").withColumn("piece", _piece())
    rows = merged.hint("rebalance", "piece").sortWithinPartitions("piece", "committee_id", "day", "part", "kind")
    versions.replace(rows.select(*COLUMNS, "piece"), layers.check_state, "piece", base, sorted(touched),
                     {"batch": str(newest), "as_of": at.as_of.isoformat()})
    return changed


def _read(spark: SparkSession, layers: Layers, state: versions.Commit, only: list[str]) -> DataFrame:
    return versions.read(spark, layers.check_state, COLUMNS, "piece", "string", state, only).select(*COLUMNS)


def results(spark: SparkSession, layers: Layers, options: Options = Options(),
            thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(assertion, failing_rows) as ``dq_suite`` gives them, from the state of the last ``update``."""
    state = versions.head(spark, layers.check_state)
    committees = staging.stg_committees(raw_committees(spark, layers), options)
    summary = summary_mart(spark, layers, options)
    sums = _read(spark, layers, state, [p for p in state.parts if not p.startswith("committees-")])
    tests = {f"not_null:{STAGED}.{c}": None for c in NOT_NULL[STAGED]}
    tests |= {f"not_null:{DAILY}.{c}": None for c in NOT_NULL[DAILY]}
    tests |= {f"positive:{DAILY}.contribution_count": None, f"unique:{STAGED}.{UNIQUE[STAGED]}": None}
    found = {kind: F.sum(F.when(F.col("kind") == kind, F.col("n"))) for kind in tests}
    rows = F.col("kind") == "rows"
    found[f"no_future:{STAGED}.{DATE}"] = F.sum(F.when(rows & (F.col("day") > options.today()), F.col("n")))
    few = F.coalesce(F.sum(F.when(rows, F.col("n"))), F.lit(0)) < thresholds.min_volume
    found[f"min_volume:{STAGED}"] = F.when(few, 1).otherwise(0).cast("bigint")
    totals = sums.agg(*[F.coalesce(total, F.lit(0)).alias(f"t{i}") for i, total in enumerate(found.values())])
    out = totals.select(F.inline(F.array(*[F.struct(F.lit(kind).alias("assertion"), F.col(f"t{i}").alias("failing_rows"))
                                           for i, kind in enumerate(found)])))
    for table, df in (("stg_committees", committees), ("committee_summary", summary)):
        out = out.unionByName(quality.column_checks(df, table, not_null=NOT_NULL[table]))
    facts = _read(spark, layers, state, [p for p in state.parts if p.startswith("committees-")])
    covered = quality.coverage_of_counts(facts, committees, "committee_id", "n")
    return out.unionByName(quality.failing_row_counts({
        f"unique:stg_committees.{UNIQUE['stg_committees']}": quality.not_unique(committees, UNIQUE["stg_committees"]),
        f"unique:committee_summary.{UNIQUE['committee_summary']}": quality.not_unique(summary, UNIQUE["committee_summary"]),
        f"orphan_ratio:{STAGED}": quality.over_limit(covered, thresholds.max_orphan_ratio)}))
