"""Loosely typed JSON records -> rows of the fixed raw schemas.

A record without its required fields is skipped. A record whose JSON, amount, date or period
cannot be read is rejected with a reason instead of failing the whole load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.cleaning import JsonRecord, iso_date, null_if_blank
from tributary.schemas import RAW_COMMITTEES, RAW_FACTS

# Raw fields that are plain text and become '' when empty.
FACT_TEXTS = [
    "committee_id", "contributor_name", "contributor_city", "contributor_state",
    "contributor_zip", "contributor_employer", "contributor_occupation", "receipt_type",
    "memo_text", "entity_type",
]
COMMITTEE_TEXTS = [
    "name", "party", "party_full", "state", "designation", "designation_full",
    "committee_type", "committee_type_full", "treasurer_name",
]

SKIPPED = "missing required field"


def _records(lines: DataFrame, columns: dict[str, Column], reason: Column) -> DataFrame:
    """One row per line: the given columns, ``reject_reason`` and the line itself."""
    parsed = JsonRecord.parse(lines, [c for c in columns if c != "_loaded_at"])
    return parsed.select(*[c.alias(name) for name, c in columns.items()],
                         reason.alias("reject_reason"), F.col("value").alias("line"))


def classify_facts(lines: DataFrame, loaded_at: Column | None = None,
                   memo_length: int | None = None) -> DataFrame:
    """Every line as a raw fact row plus ``reject_reason`` (NULL for rows to load).

    Memo texts are kept whole unless ``memo_length`` asks for their first characters only.
    """
    of = JsonRecord
    amount = of.number("contribution_receipt_amount")
    date_text = of.text("contribution_receipt_date")
    date = iso_date(date_text, strict=False)
    period = of.whole_number("two_year_transaction_period")
    missing = (
        (date_text == "") | of.raw("contribution_receipt_amount").isNull() | ~of.truth("sub_id")
    )
    reason = (
        F.when(of.unreadable(), "malformed json")
        .when(missing, SKIPPED)
        .when(amount.isNull(), "bad amount")
        .when(date.isNull(), "bad date")
        .when(period.isNull(), "bad period")
    )
    columns = {c: of.text(c) for c in FACT_TEXTS}
    columns |= {
        "sub_id": of.raw("sub_id"),
        "contribution_receipt_amount": amount,
        "contribution_receipt_date": date,
        # A record without the flag counts as an individual; a null flag does not.
        "is_individual": of.absent("is_individual") | of.truth("is_individual"),
        "two_year_transaction_period": period,
        "_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
    }
    if memo_length is not None:
        columns["memo_text"] = F.substring(columns["memo_text"], 1, memo_length)
    return _records(lines, {c: columns[c] for c in RAW_FACTS}, reason)


def normalise_facts(lines: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return accepted(classify_facts(lines, loaded_at))


def classify_committees(lines: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Every line as a raw dimension row plus ``reject_reason``."""
    of = JsonRecord
    key = of.text("committee_id")
    first_text = of.text("first_file_date")
    first = iso_date(null_if_blank(first_text), strict=False)
    reason = (
        F.when(of.unreadable(), "malformed json")
        .when(key == "", SKIPPED)
        .when((first_text != "") & first.isNull(), "bad date")
    )
    columns = {c: of.text(c) for c in COMMITTEE_TEXTS}
    columns |= {
        "committee_id": key,
        "first_file_date": first,
        "_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
    }
    return _records(lines, {c: columns[c] for c in RAW_COMMITTEES}, reason)


def normalise_committees(lines: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return accepted(classify_committees(lines, loaded_at))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason", "line")


def _unreadable() -> Column:
    return F.coalesce(F.col("reject_reason") != SKIPPED, F.lit(False))


def quarantined(rows: DataFrame) -> DataFrame:
    """Lines that could not be read, with the reason; skipped records are not among them."""
    return rows.filter(_unreadable()).select("line", "reject_reason")


def record_counts(rows: DataFrame) -> dict[str, int]:
    """What became of the source records; meant for stored rows, one pass over one column."""
    return rows.agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("reject_reason") == SKIPPED).alias("n_skipped"),
        F.count_if(_unreadable()).alias("n_unreadable")).first().asDict()


def reject_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("reject_reason", F.lit("loaded")).alias("outcome")) \
        .agg(F.count("*").alias("n_rows"))
