"""Dashboard reports over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions import display
from tributary.functions.cleaning import zero_if_null
from tributary.functions.labels import name_or_id, party_class, party_label
from tributary.operators import concentration
from tributary.operators.rollup import category_totals, ranked

EVERY_PARTY = "all"


def label() -> Column:
    return party_label(F.col("party_full"), F.col("party"))


def for_party(summary: DataFrame, party: str = EVERY_PARTY) -> DataFrame:
    return summary if party == EVERY_PARTY else summary.filter(label() == party)


def parties(summary: DataFrame) -> DataFrame:
    return summary.select(label().alias("party_label")).distinct().orderBy("party_label")


def party_rollup(summary: DataFrame) -> DataFrame:
    return category_totals(summary, label(), "total_raised", "party_label")


def party_full_rollup(summary: DataFrame) -> DataFrame:
    """Totals per full party name, rows without one left out."""
    named = summary.filter(F.col("party_full") != "")
    return named.groupBy("party_full").agg(
        F.count("*").alias("committees"),
        F.sum("total_contributions").alias("contributions"),
        F.round(F.sum("total_raised"), 2).alias("total_raised"),
    ).orderBy(F.desc("total_raised"), "party_full")


def top_committees(summary: DataFrame, n: int = 12) -> DataFrame:
    """Whole names, and labels that a chart has room for."""
    rows = ranked(summary, zero_if_null(F.col("total_raised")), n, ["committee_id"])
    name = name_or_id(F.col("committee_name"), F.col("committee_id"))
    return rows.select(
        "committee_id", name.alias("name"), display.shortened(name).alias("label"),
        zero_if_null(F.col("total_raised")).alias("total_raised"),
        party_class(label()).alias("party_class"),
    )


def top_report(summary: DataFrame, n: int = 10) -> DataFrame:
    rows = ranked(summary, F.col("total_raised"), n, ["committee_id"])
    return rows.select("committee_name", "party", "total_contributions",
                       F.round("total_raised", 2).alias("total_raised"))


def committees_from_daily(daily: DataFrame, n: int = 10) -> DataFrame:
    totals = daily.groupBy("committee_id").agg(
        F.sum("contribution_count").alias("contributions"),
        F.round(F.sum("total_amount"), 2).alias("total"),
    )
    return ranked(totals, F.col("total"), n, ["committee_id"])


def kpis(summary: DataFrame, daily: DataFrame, party: str = EVERY_PARTY) -> DataFrame:
    """Totals under the party filter; the date span always covers the whole export."""
    day = "contribution_receipt_date"
    span = daily.agg(F.struct(F.min(day).cast("string").alias("first"),
                              F.max(day).cast("string").alias("last")).alias("s")).scalar()
    totals = for_party(summary, party).agg(
        zero_if_null(F.sum("total_raised")).alias("total_raised"),
        zero_if_null(F.sum("total_contributions")).alias("total_contributions"),
        F.count("*").alias("committees"),
    )
    text = F.concat(display.calendar_day(F.col("s.first")), F.lit(" – "),
                    display.calendar_day(F.col("s.last")))
    known = F.col("s.first").isNotNull() & F.col("s.last").isNotNull()
    return totals.select("*", span.alias("s")).select(
        "total_raised", "total_contributions", "committees",
        F.when(known, text).otherwise(display.DASH).alias("date_range"),
    )


def formatted(summary: DataFrame) -> DataFrame:
    """Every committee with its numbers and dates as display text."""
    total = summary.agg(F.sum("total_raised").cast("double")).scalar()
    share = F.col("total_raised").cast("double") / total
    return summary.select(
        "committee_id",
        display.usd(F.col("total_raised")).alias("raised"),
        display.usd(F.col("total_raised"), cents=True).alias("raised_cents"),
        display.grouped_int(F.col("total_contributions")).alias("contributions"),
        display.compact_usd(F.col("total_raised")).alias("raised_compact"),
        display.calendar_day(F.col("first_contribution_date").cast("string")).alias("first_day"),
        display.calendar_day(F.col("last_contribution_date").cast("string")).alias("last_day"),
        display.percent(share).alias("share"),
    )


def bands(summary: DataFrame, party: str = EVERY_PARTY) -> DataFrame:
    return concentration.concentration_bands(
        for_party(summary, party), "total_raised", "committee_id", "committee_name")


def ladder(summary: DataFrame, party: str = EVERY_PARTY) -> DataFrame:
    return concentration.concentration_ladder(
        for_party(summary, party), "total_raised", "committee_id", "committee_name")


def concentration_total(summary: DataFrame, party: str = EVERY_PARTY) -> DataFrame:
    return concentration.concentration_summary(
        for_party(summary, party), "total_raised", "committee_id", "committee_name")


def committee_ranking(summary: DataFrame) -> DataFrame:
    """Place and running share of every committee."""
    return concentration.ranked_shares(summary, "total_raised", "committee_id")
