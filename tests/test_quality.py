import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, T0, committee, committees, dicts, fact, facts
from tributary.operators import quality as q
from tributary.options import Options, Thresholds
from tributary.plans import marts, staging
from tributary.plans.checks import dq_suite


def frame(spark, values, schema):
    return spark.createDataFrame(values, schema)


def test_unique(spark):
    good = frame(spark, [("a",), ("b",), (None,), (None,)], "k string")
    assert q.not_unique(good, "k").isEmpty()
    assert dicts(q.not_unique(good.union(good), "k")) != []


def test_not_null(spark):
    df = frame(spark, [("a", None), ("b", None), ("c", 1)], "k string, v int")
    assert dicts(q.null_counts(df, ["k", "v"])) == [{"column_name": "v", "null_rows": 2}]
    assert q.null_counts(df, ["k"]).isEmpty()


def test_no_future(spark):
    df = frame(spark, [("a", DAY)], "k string, d date")
    assert q.dated_after(df, "k", "d", F.lit(DAY)).isEmpty()
    assert q.dated_after(df, "k", "d", F.lit(DAY - dt.timedelta(days=1))).count() == 1
    assert q.dated_after(df, "k", "d", F.current_date()).isEmpty()


def test_min_volume(spark):
    assert q.below_volume(spark.range(100), 100).isEmpty()
    assert dicts(q.below_volume(spark.range(99), 100)) == [{"n_rows": 99}]
    assert q.below_volume(spark.range(0), 100).count() == 1


def test_positive(spark):
    df = frame(spark, [("a", 1), ("b", 0), ("c", -1)], "k string, n int")
    assert {r["k"] for r in dicts(q.not_positive(df, ["k"], "n"))} == {"b", "c"}


@pytest.mark.parametrize("known, breach", [(95, False), (94, True)])
def test_orphan_ratio_is_strict(spark, known, breach):
    data = spark.range(100).select(F.col("id").cast("string").alias("k"))
    dims = spark.range(known).select(F.col("id").cast("string").alias("k"))
    assert (not q.coverage_breach(data, dims, "k", 0.05).isEmpty()) is breach
    assert dicts(q.coverage(data, dims, "k"))[0]["n_orphans"] == 100 - known


def test_orphan_ratio_of_empty_table(spark):
    empty = spark.createDataFrame([], "k string")
    assert dicts(q.coverage(empty, empty, "k")) == [
        {"n_facts": 0, "n_orphans": 0, "orphan_ratio": None}]
    assert q.coverage_breach(empty, empty, "k").isEmpty()


def test_null_key_is_an_orphan(spark):
    data = frame(spark, [(None,), ("a",)], "k string")
    assert dicts(q.coverage(data, frame(spark, [("a",)], "k string"), "k"))[0]["n_orphans"] == 1


def test_orphan_keys_order(spark):
    data = frame(spark, [("x",)] * 3 + [("y",)] * 5 + [("a",)] * 9 + [("w",)] * 3, "k string")
    got = dicts(q.orphan_keys(data, frame(spark, [("a",)], "k string"), "k", 2))
    assert got == [{"k": "y", "n_orphans": 5}, {"k": "w", "n_orphans": 3}]


@pytest.mark.parametrize("age, hours, is_stale", [
    (dt.timedelta(hours=24, minutes=59), 24, False), (dt.timedelta(hours=25), 25, True),
    (dt.timedelta(hours=23, minutes=59, seconds=59), 23, False),
])
def test_freshness(spark, age, hours, is_stale):
    df = frame(spark, [(T0 - dt.timedelta(days=9),), (T0,)], "t timestamp")
    row = dicts(q.freshness(df, "t", T0 + age))[0]
    assert (row["hours_since_load"], row["is_stale"]) == (hours, is_stale)
    assert q.stale(df, "t", T0 + age).isEmpty() is not is_stale


def test_empty_table_is_stale(spark):
    assert q.stale(frame(spark, [], "t timestamp"), "t", T0).count() == 1


def suite(spark, fact_rows, committee_rows, minimum=1):
    options = Options(as_of=DAY + dt.timedelta(days=5))
    staged = staging.stg_contributions(facts(spark, fact_rows), options)
    dims = staging.stg_committees(committees(spark, committee_rows), options)
    return dq_suite(staged, dims, marts.daily_contributions(staged, dims, options),
                    marts.committee_summary(staged, dims, options), options,
                    Thresholds(min_volume=minimum))


def test_suite_passes(spark):
    result = suite(spark, [fact("a"), fact("b")], [committee("C1")])
    assert result.count() == 21
    q.require_clean(result)


def test_suite_fails_with_names(spark):
    result = suite(spark, [fact("a", committee="C9"), fact("b", committee=None)],
                   [committee("C1", name=None)], minimum=100)
    broken = {r["assertion"] for r in dicts(result.filter("failing_rows > 0"))}
    assert broken == {
        "not_null:stg_contributions.committee_id", "min_volume:stg_contributions",
        "not_null:stg_committees.committee_name", "not_null:daily_contributions.committee_id",
        "not_null:committee_summary.committee_id", "orphan_ratio:stg_contributions"}
    with pytest.raises(q.QualityError, match="min_volume"):
        q.require_clean(result)
