"""Fixed table schemas: column name -> Spark type (values given by the data model)."""

from __future__ import annotations

RAW_FACTS = {
    "sub_id": "string",
    "committee_id": "string",
    "contributor_name": "string",
    "contributor_city": "string",
    "contributor_state": "string",
    "contributor_zip": "string",
    "contributor_employer": "string",
    "contributor_occupation": "string",
    "contribution_receipt_amount": "double",
    "contribution_receipt_date": "date",
    "receipt_type": "string",
    "memo_text": "string",
    "is_individual": "boolean",
    "two_year_transaction_period": "bigint",
    "entity_type": "string",
    "_loaded_at": "timestamp",
}

RAW_COMMITTEES = {
    "committee_id": "string",
    "name": "string",
    "party": "string",
    "party_full": "string",
    "state": "string",
    "designation": "string",
    "designation_full": "string",
    "committee_type": "string",
    "committee_type_full": "string",
    "treasurer_name": "string",
    "first_file_date": "date",
    "_loaded_at": "timestamp",
}

# Export rows: dates as text, decimals as doubles.
EXPORT_DAILY = {
    "contribution_receipt_date": "string",
    "committee_id": "string",
    "committee_name": "string",
    "party": "string",
    "party_full": "string",
    "contribution_count": "bigint",
    "total_amount": "double",
    "avg_amount": "double",
    "unique_states": "bigint",
}

EXPORT_SUMMARY = {
    "committee_id": "string",
    "committee_name": "string",
    "party": "string",
    "party_full": "string",
    "committee_type_full": "string",
    "designation_full": "string",
    "committee_state": "string",
    "total_contributions": "bigint",
    "total_raised": "double",
    "avg_contribution": "double",
    "min_contribution": "double",
    "max_contribution": "double",
    "donor_states": "bigint",
    "unique_donors": "bigint",
    "first_contribution_date": "string",
    "last_contribution_date": "string",
}

EXPORT_META = {
    "exported_at": "string",
    "project": "string",
    "dataset": "string",
    "daily_contributions_rows": "bigint",
    "committee_summary_rows": "bigint",
    "date_min": "string",
    "date_max": "string",
    "total_raised": "double",
    "total_contributions": "bigint",
}


def ddl(columns: dict[str, str]) -> str:
    """Schema text for ``spark.read.schema``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def mart_daily(amount_type: str, average_type: str, loaded_at_type: str) -> dict[str, str]:
    """Columns of the daily mart; the decimal widths follow the options in use."""
    return {
        "contribution_receipt_date": "date",
        "committee_id": "string",
        "committee_name": "string",
        "party": "string",
        "party_full": "string",
        "contribution_count": "bigint",
        "total_amount": sum_type(amount_type),
        "avg_amount": average_type,
        "unique_states": "bigint",
        "last_loaded_at": loaded_at_type,
    }


def mart_summary(amount_type: str, average_type: str) -> dict[str, str]:
    return {
        "committee_id": "string",
        "committee_name": "string",
        "party": "string",
        "party_full": "string",
        "committee_type_full": "string",
        "designation_full": "string",
        "committee_state": "string",
        "total_contributions": "bigint",
        "total_raised": sum_type(amount_type),
        "avg_contribution": average_type,
        "min_contribution": amount_type,
        "max_contribution": amount_type,
        "donor_states": "bigint",
        "unique_donors": "bigint",
        "first_contribution_date": "date",
        "last_contribution_date": "date",
    }


def sum_type(decimal_type: str) -> str:
    """Type of ``sum`` over a decimal column: ten more digits, at most 38."""
    precision, scale = decimal_type[len("decimal("):-1].split(",")
    return f"decimal({min(38, int(precision) + 10)},{int(scale)})"
