"""The two marts. Aggregation comes before the dimension join, one row per key."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.labels import NO_NAME
from tributary.operators.dedupe import latest_wins
from tributary.operators.incremental import EPOCH, affected_keys, upsert
from tributary.operators.rollup import average, grouped_stats
from tributary.options import Options
from tributary.plans import staging
from tributary.session import settle

DAILY_KEYS = ["contribution_receipt_date", "committee_id"]


def committee_stats(staged: DataFrame, options: Options = Options()) -> DataFrame:
    return grouped_stats(
        staged, ["committee_id"],
        total_contributions=F.count("*"),
        total_raised=F.sum("amount"),
        avg_contribution=average("amount", options.average_type),
        min_contribution=F.min("amount"),
        max_contribution=F.max("amount"),
        donor_states=F.count_distinct("contributor_state"),
        unique_donors=F.count_distinct("contributor_name"),
        first_contribution_date=F.min("contribution_receipt_date"),
        last_contribution_date=F.max("contribution_receipt_date"),
    )


def with_committee_facts(stats: DataFrame, committees: DataFrame) -> DataFrame:
    """Committee statistics with what the dimension knows about each."""
    known = committees.select("committee_id", "committee_name", "party", "party_full",
                              "committee_type_full", "designation_full",
                              F.col("state").alias("committee_state"))
    return stats.join(known, "committee_id", "left").select(
        "committee_id", F.coalesce("committee_name", F.lit(NO_NAME)).alias("committee_name"),
        "party", "party_full", "committee_type_full", "designation_full", "committee_state",
        "total_contributions", "total_raised", "avg_contribution", "min_contribution",
        "max_contribution", "donor_states", "unique_donors", "first_contribution_date",
        "last_contribution_date",
    )


def committee_summary(staged: DataFrame, committees: DataFrame,
                      options: Options = Options()) -> DataFrame:
    """One row per committee, kept when the dimension does not know it."""
    return with_committee_facts(committee_stats(staged, options), committees)


def daily_stats(staged: DataFrame, options: Options = Options()) -> DataFrame:
    return grouped_stats(
        staged, DAILY_KEYS,
        contribution_count=F.count("*"),
        total_amount=F.sum("amount"),
        avg_amount=average("amount", options.average_type),
        unique_states=F.count_distinct("contributor_state"),
        last_loaded_at=F.max("loaded_at"),
    )


def with_committee(stats: DataFrame, committees: DataFrame) -> DataFrame:
    known = committees.select("committee_id", "committee_name", "party", "party_full")
    return stats.join(known, "committee_id", "left").select(
        *DAILY_KEYS, F.coalesce("committee_name", F.lit(NO_NAME)).alias("committee_name"),
        "party", "party_full", "contribution_count", "total_amount", "avg_amount",
        "unique_states", "last_loaded_at",
    )


def daily_contributions(staged: DataFrame, committees: DataFrame,
                        options: Options = Options()) -> DataFrame:
    """Full refresh of the daily mart."""
    return with_committee(daily_stats(staged, options), committees)


@dataclass(frozen=True)
class Touched:
    """Keys that got rows, and their dates, which are bounded by the calendar."""

    keys: DataFrame
    dates: list[dt.date]
    n_keys: int

    def covers(self, column: Column) -> Column:
        """The dates as literals, so that scans prune their partitions."""
        return column.isin(self.dates) if self.dates else F.lit(False)


def touched_since(raw: DataFrame, mark: Column, options: Options = Options(),
                  moved_from: bool = False, lookup: staging.Lookup | None = None) -> Touched:
    """Keys of the rows loaded after a mark.

    The latest version of a record is newer than the mark exactly when any version is, so the
    rows behind the mark can be staged on their own. ``moved_from`` adds every key that an
    earlier version of those records had.
    """
    kind = options.loaded_at_type
    new = raw.filter(F.col("_loaded_at").cast(kind) > mark.cast(kind))
    fresh = latest_wins(staging.typed_versions(new, options), ["sub_id"], staging.NEWEST_FACT)
    if moved_from:
        fresh = settle(fresh)
    keys = affected_keys(fresh, DAILY_KEYS)
    if moved_from:
        ids = fresh.select("sub_id")
        history = raw.join(ids, "sub_id", "left_semi") if lookup is None else lookup(ids)
        earlier = history.filter(F.col(DAILY_KEYS[0]) <= options.today())
        keys = keys.unionByName(earlier.select(*DAILY_KEYS)).distinct()
    keys = settle(keys)
    per_date = keys.groupBy(DAILY_KEYS[0]).agg(F.count("*").alias("n")).collect()
    return Touched(keys, sorted(r[0] for r in per_date), sum(r["n"] for r in per_date))


def daily_of_touched(raw: DataFrame, committees: DataFrame, touched: Touched,
                     options: Options = Options(), partitions: Column | None = None,
                     lookup: staging.Lookup | None = None) -> DataFrame:
    """Fresh mart rows of the touched keys.

    Rows of the touched dates are aggregated before they are matched with the key set: the join
    sees one row per key, so a key that holds a large part of the table never passes a row-level
    shuffle. NULL keys never match, as in an inner join.
    """
    staged = staging.stg_contributions_within(raw, touched.covers, options, partitions, lookup)
    stats = daily_stats(staged, options).join(touched.keys, DAILY_KEYS, "left_semi")
    return with_committee(stats, committees)


def daily_recomputed(raw: DataFrame, committees: DataFrame, mart: DataFrame,
                     options: Options = Options()) -> DataFrame:
    """Fresh mart rows for the keys that got raw rows since the mart was last built."""
    kind = mart.schema["last_loaded_at"].dataType
    newest = mart.agg(F.coalesce(F.max("last_loaded_at"), F.lit(EPOCH).cast(kind)).alias("mark")).scalar()
    return daily_of_touched(raw, committees, touched_since(raw, newest, options), options)


def daily_merged(raw: DataFrame, committees: DataFrame, mart: DataFrame,
                 options: Options = Options()) -> DataFrame:
    """The whole daily mart after an incremental run."""
    return upsert(mart, daily_recomputed(raw, committees, mart, options), DAILY_KEYS)
