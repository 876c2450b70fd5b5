"""The committee mart kept up to date from counted records, without reading untouched committees.

State rows (committee, donor, state, day, amount, n, total) count how many current records of a committee
are alike in all that the mart reads; rows with n = 0 go. A batch touches some records: each one's former
version is retracted and its present one merged, so moved and repeated records are exact, and so are
minimum, maximum and distinct counts, which no running total could take back. Both versions come from
the bucketed index. State and the statistics that follow from it are pieces of one versioned table, by
shard of the committee id: an update reads and replaces the shards it touches, in one commit that also
notes the last batch and the day it was made for. The statistics are computed from the counted rows as
they were written, so these are neither kept nor computed a second time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.dedupe import latest_wins
from tributary.options import Options
from tributary.plans import staging
from tributary.plans.stored import DATE, staged_versions
from tributary.schemas import ddl, mart_summary, sum_type
from tributary.session import settle
from tributary.sources import ledger, versions
from tributary.sources.layers import Layers

SHARDS = 32
#: What state rows are; a state that holds other ones is built anew (fixed value).
ROWS = "records"
ALIKE = ["committee_id", "contributor_name", "contributor_state", DATE, "amount"]
STATS = ["total_contributions", "total_raised", "avg_contribution", "min_contribution", "max_contribution",
         "donor_states", "unique_donors", "first_contribution_date", "last_contribution_date"]


def _cell_columns(options: Options) -> dict[str, str]:
    return {"committee_id": "string", "contributor_name": "string", "contributor_state": "string", DATE: "date",
            "amount": options.amount_type, "n": "bigint", "total": sum_type(options.amount_type)}


def _columns(options: Options) -> dict[str, str]:
    mart = mart_summary(options.amount_type, options.average_type)
    return {**_cell_columns(options), **{c: mart[c] for c in STATS}}


def _shard() -> Column:
    return F.pmod(F.xxhash64("committee_id"), F.lit(SHARDS))


def _piece(kind: str, shard: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), shard.cast("string"))


def _counted(records: DataFrame, sign: int) -> DataFrame:
    """One row per record, to be counted ``sign`` times."""
    amount = F.col("amount")
    return records.select(*ALIKE, F.lit(sign).cast("bigint").alias("n"), (amount if sign > 0 else -amount).alias("total"))


def _merged(cells: DataFrame, options: Options) -> DataFrame:
    kind = sum_type(options.amount_type)
    return cells.groupBy(*ALIKE).agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total")).filter("n <> 0")


def _stats(cells: DataFrame, options: Options) -> DataFrame:
    """Statistics of each committee from its counted rows: by state and by donor first, so no row is copied."""
    day, amount, kind = F.col(DATE), F.col("amount"), sum_type(options.amount_type)
    by_state = cells.groupBy("committee_id", "contributor_state").agg(
        F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total"), F.min(amount).alias("least"),
        F.max(amount).alias("most"), F.min(day).alias("first"), F.max(day).alias("last"))
    by_donor = cells.select("committee_id", "contributor_name").distinct()
    records, raised = F.sum("n"), F.sum("total").cast(kind)
    mean = raised.cast("double") / records if options.average_type == "double" else _decimal_mean(raised, records, options)
    return by_state.unionByName(by_donor, allowMissingColumns=True).groupBy("committee_id").agg(
        records.alias("total_contributions"), raised.alias("total_raised"), mean.alias("avg_contribution"),
        F.min("least").alias("min_contribution"), F.max("most").alias("max_contribution"),
        F.count("contributor_state").alias("donor_states"), F.count("contributor_name").alias("unique_donors"),
        F.min("first").alias("first_contribution_date"), F.max("last").alias("last_contribution_date"))


def _decimal_mean(total: Column, n: Column, options: Options) -> Column:
    """As ``avg`` of the decimals: the sum by the count, with four more digits where there is room."""
    precision, scale = (int(x) for x in options.amount_type[len("decimal("):-1].split(","))
    kind = f"decimal({min(38, precision + 4)},{min(38, scale + 4)})"
    return (total / n.cast("decimal(20,0)")).cast(kind).cast(options.average_type)


def pinned(spark: SparkSession, options: Options) -> Options:
    """The options with today's date as a value."""
    today = options.as_of or spark.range(1).select(F.current_date()).first()[0]
    return Options(options.amount_type, options.average_type, options.loaded_at_type, today)


def update(spark: SparkSession, layers: Layers, options: Options = Options()) -> int:
    """Bring the state up to the newest batch; returns how many committees were touched."""
    base = versions.head(spark, layers.summary_state)
    batches = ledger.entries(spark, layers)
    at = pinned(spark, options)
    today = at.as_of
    last = base if base and base.notes.get("rows") == ROWS else None
    applied = int(last.notes["batch"]) if last else 0
    then = dt.date.fromisoformat(base.notes["as_of"]) if base else today
    if today < then:
        raise ValueError("the state was made for a later day")
    newest = max((b.number for b in batches), default=0)
    if last and newest == applied and today == then:
        return 0
    shards, committees = range(SHARDS), None
    if last is None:
        cells = _merged(_counted(staged_versions(spark, layers, at), 1), options)
    else:
        former, present = changed_records(spark, layers, batches, applied, then, at)
        delta = settle(_merged(_counted(former, -1).unionByName(_counted(present, 1)), options))
        per_shard = delta.select("committee_id").distinct().groupBy(_shard().alias("shard")).count().collect()
        shards, committees = [r["shard"] for r in per_shard], sum(r["count"] for r in per_shard)
        kept = versions.read(spark, layers.summary_state, _columns(options), "piece", "string", last,
                             [f"cells-{s}" for s in shards])
        cells = _merged(kept.select(*delta.columns).unionByName(delta), options)

    def write(rows: DataFrame, kind: str) -> tuple[str, list[str]]:
        rows = rows.withColumn("piece", _piece(kind, _shard())).hint("rebalance", "piece")
        return versions.write_version(rows.sortWithinPartitions("piece", "committee_id"), layers.summary_state, "piece")

    version, values = write(cells, "cells")
    folder = f"{layers.summary_state}/data/version={version}"
    written = spark.read.schema(ddl(_cell_columns(options))).parquet(folder)
    own, own_values = write(_stats(written, options), "stats")
    touched = [f"{kind}-{s}" for s in shards for kind in ("cells", "stats")]
    gone = touched if last else [*touched, *(base.parts if base else [])]
    versions.commit(spark, layers.summary_state, base, version, values, gone,
                    {"batch": str(newest), "as_of": today.isoformat(), "rows": ROWS}, {own: own_values})
    if committees is None:
        committees = stats(spark, layers, options).count()
    return committees


def changed_records(spark: SparkSession, layers: Layers, batches: list[ledger.Batch], applied: int, then: dt.date,
                    at: Options) -> tuple[DataFrame, DataFrame]:
    """Former and present staged versions of the records that may have changed.

    These are the records of the batches after ``applied``, and those with a date that has come since ``then``.
    """
    old, new = ([b for b in batches if (b.number <= applied) == o] for o in (True, False))
    ids = ledger.index(spark, layers, new).select("sub_id")
    if at.as_of > then:
        raw = ledger.read(spark, layers)
        ids = ids.union(raw.filter((F.col(DATE) > F.lit(then)) & (F.col(DATE) <= F.lit(at.as_of))).select("sub_id"))
    ids = settle(ids.filter("sub_id is not null").distinct())
    former = Options(at.amount_type, at.average_type, at.loaded_at_type, then)

    def current(known: list[ledger.Batch], options: Options) -> DataFrame:
        found = ledger.versions_of(ids, ledger.index(spark, layers, known), layers.buckets)
        return latest_wins(staging.typed_versions(found, options), ["sub_id"], staging.NEWEST_FACT)

    return current(old, former), current(batches, at)


def stats(spark: SparkSession, layers: Layers, options: Options = Options()) -> DataFrame:
    """Statistics of all committees, one row each; the counted values are not read."""
    state = versions.head(spark, layers.summary_state)
    only = [p for p in state.parts if p.startswith("stats-")]
    rows = versions.read(spark, layers.summary_state, _columns(options), "piece", "string", state, only)
    return rows.select("committee_id", *STATS)
