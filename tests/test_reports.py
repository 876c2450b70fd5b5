import datetime as dt
import hashlib
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import dicts, plan, summary
from tributary.functions import calendar, cleaning, display, labels
from tributary.operators import concentration, rollup, selection
from tributary.plans import reports


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


# ---- labels ----------------------------------------------------------------------------------

@pytest.mark.parametrize("full, code, expected", [
    ("DEMOCRATIC PARTY", "DEM", "DEMOCRATIC PARTY"), (" \tGreen \n", None, "Green"),
    ("", "dfl", "Democratic-Farmer-Labor"), (None, " LIB ", "Libertarian Party"),
    ("", "XYZ", "XYZ"), ("  ", "xyz", "XYZ"), ("", "", "Unknown / other"),
    (None, None, "Unknown / other"), ("", "NNE", "None"),
])
def test_party_label(spark, full, code, expected):
    typed = [F.lit(v).cast("string") for v in (full, code)]
    assert value(spark, labels.party_label(*typed)) == expected


@pytest.mark.parametrize("label, expected", [
    ("DEMOCRATIC PARTY", "d"), ("Republican Party", "r"), ("Independent", "i"),
    ("Green Party", "i"), ("Libertarian Party", "i"), ("Working Families", "o"),
    ("Democratic-Farmer-Labor", "d"),
])
def test_party_class(spark, label, expected):
    assert value(spark, labels.party_class(F.lit(label))) == expected


# ---- display ---------------------------------------------------------------------------------

@pytest.mark.parametrize("amount, whole, cents, compact", [
    ("1234567.5", "$1,234,568", "$1,234,567.50", "1.2M"),
    ("-1234.56", "-$1,235", "-$1,234.56", "-1k"),
    ("0.5", "$1", "$0.50", "1"), ("2.5", "$3", "$2.50", "3"), ("0", "$0", "$0.00", "0"),
    ("999.4", "$999", "$999.40", "999"), ("1500", "$1,500", "$1,500.00", "2k"),
    ("1250000", "$1,250,000", "$1,250,000.00", "1.3M"),
])
def test_money(spark, amount, whole, cents, compact):
    v = F.lit(Decimal(amount)).cast("decimal(28,2)")
    assert value(spark, display.usd(v)) == whole
    assert value(spark, display.usd(v, cents=True)) == cents
    assert value(spark, display.compact_usd(v)) == compact
    assert value(spark, display.compact_usd(v.cast("double"))) == compact


@pytest.mark.parametrize("text, expected", [
    ("2024-03-01", "Mar 1, 2024"), ("2024-12-31", "Dec 31, 2024"), (None, "—"), ("", "—"),
    ("yesterday", "yesterday"), ("2024-03-01T10:20:30+00:00", "Mar 1, 2024"),
    ("2024-99-01", "2024-99-01"),
])
def test_calendar_day(spark, text, expected):
    assert value(spark, display.calendar_day(F.lit(text).cast("string"))) == expected


def test_small_texts(spark):
    assert value(spark, display.grouped_int(F.lit(1234567))) == "1,234,567"
    assert value(spark, display.percent(F.lit(0.3594))) == "35.9%"
    assert value(spark, display.shortened(F.lit("x" * 42))) == "x" * 42
    assert value(spark, display.shortened(F.lit("x" * 43))) == "x" * 41 + "…"
    assert value(spark, display.date_prefix(F.lit("2024-03-01T10:00:00Z"))) == "2024-03-01"
    assert value(spark, labels.name_or_id(F.lit(""), F.lit("C1"))) == "C1"
    assert value(spark, cleaning.iso_date(F.lit("x"), strict=False)) is None
    with pytest.raises(Exception, match="x"):
        value(spark, cleaning.iso_date(F.concat(F.lit("x"), F.col("id").cast("string"))))
    local = F.lit(dt.datetime(2024, 1, 1, 12))
    assert value(spark, cleaning.as_utc(local, "America/New_York")) == dt.datetime(2024, 1, 1, 17)
    assert value(spark, cleaning.as_utc(local)) == dt.datetime(2024, 1, 1, 12)


# ---- calendar --------------------------------------------------------------------------------

def test_cycles(spark):
    assert value(spark, calendar.election_cycle(F.lit(dt.date(2025, 5, 1)))) == 2026
    assert value(spark, calendar.election_cycle(F.lit(dt.date(2024, 5, 1)))) == 2024
    assert calendar.current_cycle(dt.date(2025, 1, 1), {}) == 2026
    assert calendar.current_cycle(dt.date(2025, 1, 1), {"TRIBUTARY_CYCLE": "2020"}) == 2020
    assert calendar.bootstrap_date(2026, dt.date(2025, 2, 1), env={}) == dt.date(2025, 1, 1)
    assert calendar.bootstrap_date(2026, dt.date(2026, 8, 1), env={}) == dt.date(2025, 8, 1)
    assert calendar.bootstrap_date(2026, dt.date(2026, 8, 1),
                                   env={"TRIBUTARY_BOOTSTRAP_DAYS": "1"}) == dt.date(2026, 7, 31)
    start = calendar.bootstrap_start(F.lit(2026), F.lit(dt.date(2025, 2, 1)))
    assert value(spark, start) == dt.date(2025, 1, 1)
    assert value(spark, calendar.today_text(F.lit(dt.date(2024, 1, 2)))) == "2024-01-02"


# ---- concentration ---------------------------------------------------------------------------

def ranked(spark, amounts):
    return summary(spark, [(f"C{i:03d}", f"Name {i}", "DEM", "", 1, None if a is None else
                            Decimal(a)) for i, a in enumerate(amounts)])


def brute(amounts):
    order = sorted(amounts, key=lambda a: -(a or 0))
    clamped = [max(0, a or 0) for a in order]
    return sum(clamped), [sum(clamped[:k]) for k in (1, 5, 12)]


@pytest.mark.parametrize("amounts", [
    list(range(1, 31)), [5, 4, 3], [10, None, -4, 7, 0], [-1, -2], [0, 0], [8] * 20, [100],
])
def test_bands_and_ladder(spark, amounts):
    df = ranked(spark, amounts)
    total, (top1, top5, top12) = brute(amounts)
    bands = {r["band"]: r for r in dicts(reports.bands(df))}
    want = {"top1": top1, "top5": top5 - top1, "top12": top12 - top5, "rest": total - top12}
    assert {k: float(r["amount"]) for k, r in bands.items()} == {
        k: float(v) for k, v in want.items() if v > 0 or k == "rest"}
    assert bands["rest"]["label"] == f"Rest ({max(0, len(amounts) - 12)})"
    for row in bands.values():
        assert row["share"] == pytest.approx(float(row["amount"]) / float(total) if total else 0)
    ladder = sorted(dicts(reports.ladder(df)), key=lambda r: r["position"])
    assert [float(r["amount"]) for r in ladder] == [float(x) for x in (top1, top5, top12, total)]
    assert ladder[3]["share"] == 1.0 and ladder[3]["label"] == f"All {len(amounts)}"
    hidden = concentration.concentration_bands(df, "total_raised", "committee_id",
                                               "committee_name", hide_empty=True)
    assert hidden.isEmpty() is (total <= 0)


def test_concentration_of_nothing(spark):
    df = ranked(spark, [])
    assert [r["band"] for r in dicts(reports.bands(df))] == ["rest"]
    ladder = dicts(reports.ladder(df))
    assert [float(r["amount"]) for r in ladder] == [0, 0, 0, 0]
    assert concentration.concentration_ladder(df, "total_raised", "committee_id",
                                              "committee_name", hide_empty=True).isEmpty()
    row = dicts(reports.concentration_total(df))[0]
    assert (float(row["total"]), row["committees"], row["top12_share"]) == (0.0, 0, 0.0)


def test_leader_falls_back_to_its_id(spark):
    df = summary(spark, [("C1", "", "D", "", 1, Decimal(5)), ("C2", "x", "D", "", 1, Decimal(1))])
    bands = {r["band"]: r["detail"] for r in dicts(reports.bands(df))}
    assert bands["top1"] == "C1"


# ---- rollups ---------------------------------------------------------------------------------

def three(spark):
    return summary(spark, [
        ("C1", "One", "DEM", "DEMOCRATIC PARTY", 3, Decimal("10.50")),
        ("C2", "Two", "DFL", "", 2, None),
        ("C3", "Three", "dfl ", None, 1, Decimal("4.00")),
        ("C4", "Unknown Committee", None, None, 5, Decimal("-1.00"))])


def test_party_rollup(spark):
    rows = dicts(reports.party_rollup(three(spark)))
    assert [(r["party_label"], float(r["total_raised"]), r["committees"]) for r in rows] == [
        ("DEMOCRATIC PARTY", 10.5, 1), ("Democratic-Farmer-Labor", 4.0, 2),
        ("Unknown / other", -1.0, 1)]
    assert [r["party_full"] for r in dicts(reports.party_full_rollup(three(spark)))] == [
        "DEMOCRATIC PARTY"]


def test_party_filter_and_list(spark):
    assert reports.for_party(three(spark)).count() == 4
    assert reports.for_party(three(spark), "Democratic-Farmer-Labor").count() == 2
    assert reports.for_party(three(spark), "nobody").isEmpty()
    assert {r["party_label"] for r in dicts(reports.parties(three(spark)))} == {
        "DEMOCRATIC PARTY", "Democratic-Farmer-Labor", "Unknown / other"}


def test_top_committees(spark):
    rows = dicts(reports.top_committees(three(spark), 3))
    assert [r["committee_id"] for r in rows] == ["C1", "C3", "C2"]
    assert [r["party_class"] for r in rows] == ["d", "d", "d"]


def test_kpis(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 3, 4),)],
                                  "contribution_receipt_date date")
    row = dicts(reports.kpis(three(spark), daily, "Democratic-Farmer-Labor"))[0]
    assert (float(row["total_raised"]), row["total_contributions"], row["committees"]) == (4, 3, 2)
    assert row["date_range"] == "Jan 2, 2024 – Mar 4, 2024"
    empty = dicts(reports.kpis(three(spark), daily.filter("false"), "nobody"))[0]
    assert (float(empty["total_raised"]), empty["committees"], empty["date_range"]) == (0, 0, "—")


def test_load_summary_and_peak(spark):
    rows = [("a", "OR", dt.date(2024, 1, 1), 10.0), ("a", "", dt.date(2024, 1, 1), 5.0),
            ("", "WA", dt.date(2024, 1, 2), 3.0), ("b", None, dt.date(2024, 1, 2), None)]
    df = spark.createDataFrame(rows, "e string, r string, d date, a double")
    row = dicts(rollup.load_summary(df, entity_id="e", region="r", event_date="d", amount="a"))[0]
    assert (row["n_records"], row["n_entities"], row["n_regions"], row["n_dates"]) == (4, 2, 2, 2)
    assert row["total_amount"] == 18.0 and row["avg_amount"] == 6.0
    peak = dicts(rollup.date_concentration(df, "d", "a"))[0]
    assert (peak["peak_date"], peak["peak_count"], peak["is_concentrated"]) == (
        dt.date(2024, 1, 2), 2, True)
    assert rollup.date_concentration(df.filter("false"), "d", "a").isEmpty()
    empty = dicts(rollup.load_summary(df.filter("false"), entity_id="e", region="r",
                                      event_date="d", amount="a"))[0]
    assert empty["n_records"] == 0 and empty["avg_amount"] is None


def test_category_counts(spark):
    df = spark.createDataFrame([("D",)] * 3 + [("",)] * 2 + [(None,)] * 2 + [("R",)], "p string")
    assert [(r["p"], r["n_rows"]) for r in dicts(rollup.category_counts(df, "p", 2))] == [
        ("Unknown", 4), ("D", 3)]


# ---- selection -------------------------------------------------------------------------------

def test_windowed_fetch_skips_before_the_cap(spark):
    day = dt.date(2024, 1, 1)
    rows = [(f"s{i}", day + dt.timedelta(days=i), float(i)) for i in range(10)]
    rows += [("", day + dt.timedelta(days=99), 1.0), ("x", None, 1.0),
             ("y", day + dt.timedelta(days=98), None)]
    df = spark.createDataFrame(rows, "k string, d date, a double")
    for cap, want in ((3, ["s6", "s7", "s8"]), (None, [f"s{i}" for i in range(2, 9)])):
        got = dicts(selection.windowed_fetch(
            df, record_id="k", event_date="d", amount="a", max_records=cap, min_amount=2,
            max_date=dt.date(2024, 1, 9)))
        assert sorted(r["k"] for r in got) == want
    row = dicts(selection.valid_and_skipped(df, "k", "d", "a"))[0]
    assert (row["n_valid"], row["n_skipped"]) == (10, 3)


@pytest.mark.parametrize("cap", [1, 7, 333, 500, 999, 1000, 5000])
def test_caps_match_a_sorted_list(spark, cap):
    """Half of the rows share a date, and a third one identifier."""
    days = [dt.date(2024, 1, 1 + (i % 10 if i % 2 else 5)) for i in range(1000)]
    rows = [("hot" if i % 3 == 0 else f"k{i}", d, float(i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "k string, d date, a double")
    got = selection.newest_rows(df, "d", "k", cap, ["a"])
    want = sorted(rows, key=lambda r: (-r[1].toordinal(), hashlib.md5(r[0].encode()).hexdigest(),
                                       r[2]))[:cap]
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(want)


def test_cap_sizes_around_one_hundred_thousand_give_one_order(spark):
    df = spark.range(120_000).select(
        F.col("id").cast("string").alias("k"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 7).cast("int")).alias("d"))
    taken = [{r["k"] for r in selection.newest_rows(df, "d", "k", n).select("k").collect()}
             for n in (99_999, 100_000, 100_001)]
    assert [len(x) for x in taken] == [99_999, 100_000, 100_001]
    assert taken[0] < taken[1] < taken[2]


@pytest.mark.parametrize("cap", [1, 3, 400, 700, 1501, 1999, 2000, 2001])
def test_caps_in_groups_of_one_identifier(spark, cap):
    """Half of the rows are versions of one identifier on one day, some equal throughout, some null."""
    day = dt.date(2024, 1, 1)
    rows = [("hot", day, float(i % 97) if i % 5 else None) if i % 2 else
            (f"k{i}", day + dt.timedelta(days=i % 3) if i % 7 else None, 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, d date, a double").repartition(3)
    got = selection.newest_rows(df, "d", "k", cap, ["a"], small=20)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or day).toordinal(),
                                       hashlib.md5(r[0].encode()).hexdigest(), r[2] is not None, r[2] or 0.0))[:cap]
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_no_task_ranks_a_hot_identifier(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    F.lit(dt.date(2024, 1, 1)).alias("d"), (F.col("id") % 1000).alias("a"))
    place = hashlib.md5(b"hot").hexdigest()
    before = df.filter(F.md5("k") < place).count()
    got = selection.newest_rows(df, "d", "k", before + 17_000, ["a"], small=500)
    hot = got.filter("k = 'hot'").groupBy("a").count().collect()
    assert got.count() == before + 17_000 and sum(r["count"] for r in hot) == 17_000
    assert max(r["a"] for r in hot) == 2 * (17_000 // 60 - (17_000 % 60 == 0))
    text = plan(got)
    assert not re.search(r"\) Window\b", text)  # what is left to rank is a sort of at most 500 rows
    assert len(re.findall("TakeOrderedAndProject", text)) >= 1


def test_ranking_of_the_whole_set(spark):
    rows = [(f"C{i}", None if i % 11 == 0 else float(i * 37 % 50 - 5)) for i in range(300)] + [("hot%d" % i, 7.0) for i in range(200)]
    df = spark.createDataFrame(rows, "c string, a double").withColumn("a", F.col("a").cast("decimal(18,2)"))
    got = concentration.ranked_shares(df.repartition(5), "a", "c").orderBy("place").collect()
    want = sorted(rows, key=lambda r: (-(r[1] or 0.0), r[0]))
    assert [r["c"] for r in got] == [r[0] for r in want] and [r["place"] for r in got] == list(range(1, 501))
    total, running = sum(max(r[1] or 0, 0) for r in rows), 0.0
    for r, (_, a) in zip(got, want):
        running += max(a or 0, 0)
        assert float(r["running"]) == running and r["running_share"] == pytest.approx(running / total)
    assert concentration.ranked_shares(df.limit(0), "a", "c").count() == 0
    assert {r["running_share"] for r in concentration.ranked_shares(
        df.withColumn("a", -F.abs("a")), "a", "c").collect()} == {0.0}


def test_cycle_fetch_on_numbers_and_arrays(spark):
    df = spark.createDataFrame([("a", 2024, [2022, 2024]), ("b", 2022, [2022])],
                               "k string, c int, cs array<int>")
    assert [r["k"] for r in dicts(selection.rows_for_cycle(df, "c", 2024))] == ["a"]
    assert selection.rows_for_cycle(df, "cs", 2022).count() == 2


def test_key_sets(spark):
    need = spark.createDataFrame([("a",), ("b",), ("a",), ("",), (None,)], "k string")
    have = spark.createDataFrame([("a",)], "k string")
    keys = selection.distinct_nonempty(need, "k")
    assert {r["k"] for r in dicts(keys)} == {"a", "b"}
    assert [r["k"] for r in dicts(selection.keys_missing_from(keys, have, "k"))] == ["b"]
    assert selection.rows_for_keys(need, have, "k").count() == 2
