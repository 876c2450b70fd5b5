import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import dicts, lines
from tributary.plans import normalise as n
from tributary.schemas import RAW_COMMITTEES, RAW_FACTS

GOOD = {"sub_id": "s1", "committee_id": "C1", "contribution_receipt_date": "2024-03-01",
        "contribution_receipt_amount": 25.5, "contributor_state": "OR", "is_individual": True,
        "two_year_transaction_period": 2024, "memo_text": "m"}
def stamp():
    return F.lit(dt.datetime(2024, 3, 2))


def one(spark, record):
    rows = dicts(n.classify_facts(lines(spark, [record]), stamp()))
    assert len(rows) == 1
    return rows[0]


def test_columns_and_types(spark):
    df = n.normalise_facts(lines(spark, [GOOD]), stamp())
    assert dict(df.dtypes) == RAW_FACTS
    row = dicts(df)[0]
    assert row["sub_id"] == "s1" and row["contribution_receipt_date"] == dt.date(2024, 3, 1)
    assert row["contributor_zip"] == "" and row["_loaded_at"] == dt.datetime(2024, 3, 2)


@pytest.mark.parametrize("change", [
    {"contribution_receipt_date": None}, {"contribution_receipt_date": ""},
    {"contribution_receipt_amount": None}, {"sub_id": None}, {"sub_id": ""}, {"sub_id": 0},
    {"contribution_receipt_date": 0},
])
def test_skipped(spark, change):
    assert one(spark, GOOD | change)["reject_reason"] == n.SKIPPED


@pytest.mark.parametrize("field", ["sub_id", "contribution_receipt_date",
                                   "contribution_receipt_amount"])
def test_absent_required_field(spark, field):
    assert one(spark, {k: v for k, v in GOOD.items() if k != field})["reject_reason"] == n.SKIPPED


@pytest.mark.parametrize("change, reason", [
    ({"contribution_receipt_amount": "abc"}, "bad amount"),
    ({"contribution_receipt_amount": "12.5d"}, "bad amount"),
    ({"contribution_receipt_amount": ""}, "bad amount"),
    ({"contribution_receipt_date": "2024-13-45"}, "bad date"),
    ({"contribution_receipt_date": "March"}, "bad date"),
    ({"two_year_transaction_period": "soon"}, "bad period"),
])
def test_quarantined(spark, change, reason):
    rows = n.classify_facts(lines(spark, [GOOD | change, GOOD, "{broken"]), stamp())
    bad = {r["reject_reason"] for r in dicts(n.quarantined(rows))}
    assert bad == {reason, "malformed json"}
    assert n.normalise_facts(lines(spark, [GOOD | change, GOOD, "{broken"]), stamp()).count() == 1


@pytest.mark.parametrize("value, expected", [
    (4001, "4001"), (4060320251234567890, "4060320251234567890"), ("0", "0"), ("x", "x"),
])
def test_identifier(spark, value, expected):
    row = one(spark, GOOD | {"sub_id": value})
    assert row["reject_reason"] is None and row["sub_id"] == expected


@pytest.mark.parametrize("value, expected", [
    (0, 0.0), (-50.0, -50.0), ("12.5", 12.5), (1e3, 1000.0), (True, 1.0),
])
def test_amount(spark, value, expected):
    row = one(spark, GOOD | {"contribution_receipt_amount": value})
    assert row["reject_reason"] is None and row["contribution_receipt_amount"] == expected


@pytest.mark.parametrize("value, expected", [
    (True, True), (False, False), (None, False), ("false", True), ("", False), (0, False),
    (1, True), ([], False), ({}, False),
])
def test_individual_flag(spark, value, expected):
    assert one(spark, GOOD | {"is_individual": value})["is_individual"] is expected


def test_individual_flag_absent(spark):
    record = {k: v for k, v in GOOD.items() if k != "is_individual"}
    assert one(spark, record)["is_individual"] is True


@pytest.mark.parametrize("value, expected", [
    (None, ""), ("", ""), (0, ""), (False, ""), ([], ""), ("0", "0"), ("false", "false"),
    (97201, "97201"), ("OR", "OR"),
])
def test_text_fields(spark, value, expected):
    assert one(spark, GOOD | {"contributor_state": value})["contributor_state"] == expected


@pytest.mark.parametrize("value, expected", [
    (None, 0), (0, 0), ("", 0), (2024, 2024), ("2022", 2022), (2024.0, 2024),
])
def test_period(spark, value, expected):
    assert one(spark, GOOD | {"two_year_transaction_period": value})[
        "two_year_transaction_period"] == expected


def test_memo_is_whole_unless_a_length_is_asked_for(spark):
    memo = "é…\n\"" * 500
    assert one(spark, GOOD | {"memo_text": memo})["memo_text"] == memo
    rows = dicts(n.classify_facts(lines(spark, [GOOD | {"memo_text": memo}]), stamp(), 1024))
    assert rows[0]["memo_text"] == memo[:1024]


def test_the_last_of_repeated_members_counts(spark):
    text = '{"sub_id":"a","sub_id":"b","contribution_receipt_date":"2024-03-01",' \
           '"contribution_receipt_amount":1,"two_year_transaction_period":2024}'
    rows = dicts(n.classify_facts(lines(spark, [text]), stamp()))
    assert rows[0]["reject_reason"] is None and rows[0]["sub_id"] == "b"


def test_outcome_counts(spark):
    rows = n.classify_facts(lines(spark, [GOOD, GOOD, GOOD | {"sub_id": ""}, "nope"]), stamp())
    assert {r["outcome"]: r["n_rows"] for r in dicts(n.reject_counts(rows))} == {
        "loaded": 2, n.SKIPPED: 1, "malformed json": 1}


def test_committees(spark):
    records = [
        {"committee_id": "C1", "name": "One", "first_file_date": "1999-01-02", "party": None},
        {"committee_id": "C2", "first_file_date": ""},
        {"committee_id": "C3", "first_file_date": None},
        {"committee_id": None}, {"committee_id": ""}, {},
        {"committee_id": "C4", "first_file_date": "never"},
    ]
    df = n.normalise_committees(lines(spark, records), stamp())
    assert dict(df.dtypes) == RAW_COMMITTEES
    rows = {r["committee_id"]: r for r in dicts(df)}
    assert set(rows) == {"C1", "C2", "C3"}
    assert rows["C1"]["first_file_date"] == dt.date(1999, 1, 2) and rows["C1"]["party"] == ""
    assert rows["C2"]["first_file_date"] is None and rows["C2"]["name"] == ""
