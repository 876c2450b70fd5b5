"""Staging views: typed, filtered, one row per record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.cleaning import blank_if_null
from tributary.operators.dedupe import latest_wins
from tributary.options import Options
from tributary.session import settle

DATE = "contribution_receipt_date"

# Order that picks a record's version. The load time decides; the others only break exact ties,
# so that a rerun picks the same row. All of them are columns the marts read anyway.
NEWEST_FACT = ["loaded_at", DATE, "amount", "committee_id", "contributor_state",
               "contributor_name"]
NEWEST_COMMITTEE = ["loaded_at", "committee_name", "party_full", "party", "state"]


def valid_facts(raw: DataFrame, options: Options) -> DataFrame:
    return raw.filter(
        F.col("sub_id").isNotNull()
        & F.col(DATE).isNotNull()
        & F.col("contribution_receipt_amount").isNotNull()
        & (F.col(DATE) <= options.today())
    )


def _amount(options: Options) -> Column:
    return F.col("contribution_receipt_amount").cast(options.amount_type).alias("amount")


def _loaded_at(options: Options) -> Column:
    return F.col("_loaded_at").cast(options.loaded_at_type).alias("loaded_at")


def _typed_facts(raw: DataFrame, options: Options) -> DataFrame:
    return valid_facts(raw, options).select(
        "sub_id", "committee_id", "contributor_name", "contributor_city", "contributor_state",
        "contributor_zip", "contributor_employer", "contributor_occupation", _amount(options),
        DATE, "receipt_type", "entity_type", "is_individual", "two_year_transaction_period",
        _loaded_at(options),
    )


def typed_versions(raw: DataFrame, options: Options) -> DataFrame:
    """Valid facts with only the columns that pick a version, which are all that the marts read."""
    return valid_facts(raw, options).select(
        "sub_id", _loaded_at(options), DATE, _amount(options), "committee_id", "contributor_state", "contributor_name")


def stg_contributions(raw: DataFrame, options: Options = Options()) -> DataFrame:
    return latest_wins(_typed_facts(raw, options), ["sub_id"], NEWEST_FACT)


Lookup = Callable[[DataFrame], DataFrame]


def stg_contributions_within(raw: DataFrame, scope: Callable[[Column], Column],
                             options: Options = Options(), partitions: Column | None = None,
                             lookup: Lookup | None = None) -> DataFrame:
    """The staged rows whose date is in scope, with the columns of ``typed_versions``.

    The rows in scope are read once and kept. A version outside the scope can only push an older
    version inside it aside, and for that its identifier, load time and date are enough; only
    versions of records that have one inside count. ``lookup`` finds these in an index by
    identifier; without one they are cut from ``raw`` by a semi-join. Equal load times are decided
    by the date, which differs between the two sides. ``partitions`` is the scope on a derived
    partition column, implied by the dates.
    """
    covered = raw if partitions is None else raw.filter(partitions)
    inside = settle(typed_versions(covered, options).filter(scope(F.col(DATE))))
    ids = inside.select("sub_id").distinct()
    history = raw.join(ids, "sub_id", "left_semi") if lookup is None else lookup(ids)
    outside = valid_facts(history, options).filter(~scope(F.col(DATE))).select(
        "sub_id", _loaded_at(options), DATE, F.lit(False).alias("_inside"))
    versions = inside.withColumn("_inside", F.lit(True)).unionByName(
        outside, allowMissingColumns=True)
    return latest_wins(versions, ["sub_id"], NEWEST_FACT).filter("_inside").drop("_inside")


def stg_committees(raw: DataFrame, options: Options = Options()) -> DataFrame:
    texts = ["party", "party_full", "state", "designation", "designation_full",
             "committee_type", "committee_type_full"]
    typed = raw.filter(F.col("committee_id").isNotNull()).select(
        "committee_id", F.col("name").alias("committee_name"),
        *[blank_if_null(F.col(c)).alias(c) for c in texts],
        "treasurer_name", "first_file_date",
        F.col("_loaded_at").cast(options.loaded_at_type).alias("loaded_at"),
    )
    return latest_wins(typed, ["committee_id"], NEWEST_COMMITTEE)
