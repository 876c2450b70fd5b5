"""The assertion set of the campaign-finance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.operators import quality
from tributary.options import Options, Thresholds

# Columns that must not be null, per table (fixed values).
NOT_NULL = {
    "stg_contributions": ["sub_id", "amount", "committee_id", "contribution_receipt_date"],
    "stg_committees": ["committee_id", "committee_name"],
    "daily_contributions": ["contribution_receipt_date", "committee_id", "contribution_count",
                            "total_amount", "committee_name"],
    "committee_summary": ["committee_id", "total_contributions", "total_raised"],
}
# Columns that must be unique, per table (fixed values).
UNIQUE = {
    "stg_contributions": "sub_id",
    "stg_committees": "committee_id",
    "committee_summary": "committee_id",
}


def dq_suite(staged: DataFrame, committees: DataFrame, daily: DataFrame, summary: DataFrame,
             options: Options = Options(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(assertion, failing_rows) of every assertion, passing ones with 0.

    Row-wise assertions share one pass per table. A caller that has already stored the staged
    rows should pass the stored table, since several assertions read it.
    """
    relations = {"stg_contributions": staged, "stg_committees": committees,
                 "daily_contributions": daily, "committee_summary": summary}
    results = quality.column_checks(
        staged, "stg_contributions", not_null=NOT_NULL["stg_contributions"],
        no_future=("contribution_receipt_date", options.today()),
        minimum_rows=thresholds.min_volume)
    results = results.unionByName(quality.column_checks(
        committees, "stg_committees", not_null=NOT_NULL["stg_committees"]))
    results = results.unionByName(quality.column_checks(
        daily, "daily_contributions", not_null=NOT_NULL["daily_contributions"],
        positive=["contribution_count"]))
    results = results.unionByName(quality.column_checks(
        summary, "committee_summary", not_null=NOT_NULL["committee_summary"]))
    own = {f"unique:{t}.{c}": quality.not_unique(relations[t], c) for t, c in UNIQUE.items()}
    own["orphan_ratio:stg_contributions"] = quality.coverage_breach(
        staged, committees, "committee_id", thresholds.max_orphan_ratio)
    return results.unionByName(quality.failing_row_counts(own))
