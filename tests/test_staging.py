import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import DAY, T0, committee, committees, dicts, fact, facts, plan
from tributary.operators.dedupe import duplicate_key_count, duplicate_keys, latest_wins
from tributary.options import Options
from tributary.plans import staging

HOUR = dt.timedelta(hours=1)


def test_latest_version_wins(spark):
    raw = facts(spark, [fact("a", amount=1.0), fact("a", amount=2.0, loaded=T0 + HOUR),
                        fact("b", amount=3.0), fact("a", amount=9.0, loaded=T0 - HOUR)])
    rows = {r["sub_id"]: r for r in dicts(staging.stg_contributions(raw))}
    assert rows["a"]["amount"] == 2 and rows["b"]["amount"] == 3
    assert "memo_text" not in rows["a"] and len(rows["a"]) == 15


def test_tie_is_broken_the_same_way_every_time(spark):
    versions = [fact("a", amount=float(i), name=f"n{i}") for i in range(20)]
    for seed in range(3):
        random.Random(seed).shuffle(versions)
        raw = facts(spark, versions).repartition(5)
        assert dicts(staging.stg_contributions(raw))[0]["amount"] == 19


def test_null_load_time_loses(spark):
    raw = facts(spark, [fact("a", amount=1.0, loaded=None), fact("a", amount=2.0)])
    assert dicts(staging.stg_contributions(raw))[0]["amount"] == 2


def test_validity_filter(spark):
    tomorrow = dt.datetime.now(dt.UTC).date() + dt.timedelta(days=2)
    raw = facts(spark, [fact(None), fact("a", amount=None), fact("b", day=None),
                        fact("c", day=tomorrow), fact("d", amount=0.0), fact("", amount=-1.0)])
    assert {r["sub_id"] for r in dicts(staging.stg_contributions(raw))} == {"d", ""}


def test_as_of_moves_today(spark):
    raw = facts(spark, [fact("a", day=DAY), fact("b", day=DAY + dt.timedelta(days=1))])
    rows = staging.stg_contributions(raw, Options(as_of=DAY))
    assert [r["sub_id"] for r in dicts(rows)] == ["a"]


def test_amount_scale(spark):
    raw = facts(spark, [fact("a", amount=0.123456789)])
    assert dicts(staging.stg_contributions(raw))[0]["amount"] == Decimal("0.123456789")
    cents = staging.stg_contributions(raw, Options(amount_type="decimal(18,2)"))
    assert dicts(cents)[0]["amount"] == Decimal("0.12")


def test_committees(spark):
    raw = committees(spark, [
        committee("C1", name="old"), committee("C1", name="new", loaded=T0 + HOUR),
        committee(None), committee("", name="blank"),
        committee("C2", party=None, party_full=None, treasurer_name=None, name=None)])
    rows = {r["committee_id"]: r for r in dicts(staging.stg_committees(raw))}
    assert set(rows) == {"C1", "", "C2"}
    assert rows["C1"]["committee_name"] == "new"
    assert rows["C2"]["party"] == "" and rows["C2"]["treasurer_name"] is None
    assert rows["C2"]["committee_name"] is None


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    result = latest_wins(hot, ["k"], ["id"])
    assert result.count() == 20_001
    assert dicts(result.filter("k = -1"))[0]["id"] == 29_997
    text = plan(result)
    assert text.count("WindowGroupLimit") >= 2


def test_scoped_staging_equals_whole_staging(spark):
    rng = random.Random(7)
    days = [DAY + dt.timedelta(days=i) for i in range(6)]
    rows = [fact(f"s{rng.randrange(60)}", committee=f"C{rng.randrange(4)}",
                 amount=float(rng.randrange(100)), day=rng.choice(days),
                 loaded=T0 + HOUR * rng.randrange(4)) for _ in range(400)]
    raw = facts(spark, rows)
    scope = days[1:3]
    whole = staging.stg_contributions(raw).filter(F.col(staging.DATE).isin(scope))
    part = staging.stg_contributions_within(raw, lambda c: c.isin(scope))
    key = ["sub_id", "committee_id", "amount", staging.DATE, "loaded_at"]
    assert sorted(whole.select(key).collect()) == sorted(part.select(key).collect())
    assert whole.count() > 0


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert dicts(duplicate_keys(df, ["k"])) == [{"k": "a", "n_rows": 2}]
    assert dicts(duplicate_key_count(df, ["k"])) == [{"duplicate_keys": 2}]
