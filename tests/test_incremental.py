"""Incremental runs against full rebuilds, on stored tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import DAY, T0, committee, committees, dicts, fact, facts
from tributary.operators import incremental as inc
from tributary.options import Options
from tributary.plans import marts, run, staging
from tributary.plans.stored import append_facts, daily_mark, record_versions
from tributary.sources import layers as tables, versions
from tributary.sources.layers import Layers

OPTIONS = Options(amount_type="decimal(18,2)", as_of=dt.date(2024, 12, 31))
HOUR = dt.timedelta(hours=1)
KEY = marts.DAILY_KEYS
CHECKED = [*KEY, "committee_name", "contribution_count", "total_amount", "avg_amount",
           "unique_states", "last_loaded_at"]


def append(spark, at, rows):
    append_facts(facts(spark, rows), at)


def mart_rows(spark, at):
    return sorted(map(tuple, run.daily_mart(spark, at, OPTIONS).select(*CHECKED).collect()),
                  key=str)


def full_rows(spark, at):
    staged = staging.stg_contributions(run.raw_facts(spark, at), OPTIONS)
    dims = staging.stg_committees(run.raw_committees(spark, at), OPTIONS)
    rows = marts.daily_contributions(staged, dims, OPTIONS).select(*CHECKED).collect()
    return sorted(map(tuple, rows), key=str)


def batches(seed, n_batches=3, moves=False):
    """Batches with later versions of old records; with ``moves`` some change their key."""
    rng = random.Random(seed)
    made, out = {}, []
    for b in range(n_batches):
        rows = []
        for i in range(40):
            again = made and rng.random() < 0.4
            sid = rng.choice(list(made)) if again else f"b{b}-{i}"
            if again and not moves:
                cid, day = made[sid]
            else:
                cid = f"C{rng.randrange(5)}"
                day = DAY + dt.timedelta(days=4 * rng.randrange(10))
            made[sid] = (cid, day)
            rows.append(fact(sid, committee=cid, day=day, amount=float(rng.randrange(1, 900)),
                             state=rng.choice(["OR", "WA", ""]),
                             loaded=T0 + HOUR * (100 * b + i)))
        out.append(rows)
    return out


def deployed(spark, root, grain="day"):
    at = Layers(root, grain=grain)
    tables.write_dimension(committees(spark, [committee(f"C{i}") for i in range(4)]),
                           at.committees, append=False)
    return at


@pytest.mark.parametrize("grain", ["day", "month"])
def test_incremental_runs_equal_full_refresh(spark, root, grain):
    at = deployed(spark, root, grain)
    for i, rows in enumerate(batches(1)):
        append(spark, at, rows)
        result = run.refresh_daily(spark, at, OPTIONS)
        assert result.mode == ("full" if i == 0 else "incremental")
        assert mart_rows(spark, at) == full_rows(spark, at)


def test_repair_equals_full_refresh_when_keys_move(spark, root):
    at = deployed(spark, root)
    drifted = False
    for rows in batches(2, moves=True):
        append(spark, at, rows)
        run.refresh_daily(spark, at, OPTIONS, repair_moved_keys=True)
        assert mart_rows(spark, at) == full_rows(spark, at)
    at = deployed(spark, root + "-plain")
    for rows in batches(2, moves=True):
        append(spark, at, rows)
        run.refresh_daily(spark, at, OPTIONS)
        drifted = drifted or mart_rows(spark, at) != full_rows(spark, at)
    assert drifted
    run.refresh_daily(spark, at, OPTIONS, full_refresh=True)
    assert mart_rows(spark, at) == full_rows(spark, at)


def test_moved_record_leaves_its_old_row(spark, root):
    at = deployed(spark, root)
    append(spark, at, [fact("a", committee="C1"), fact("b", committee="C2")])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("a", committee="C3", loaded=T0 + HOUR)])
    run.refresh_daily(spark, at, OPTIONS)
    counts = {r["committee_id"]: r["contribution_count"]
              for r in dicts(run.daily_mart(spark, at, OPTIONS))}
    assert counts == {"C1": 1, "C2": 1, "C3": 1}
    run.refresh_daily(spark, at, OPTIONS, full_refresh=True)
    assert {r["committee_id"] for r in dicts(run.daily_mart(spark, at, OPTIONS))} == {"C2", "C3"}


def test_older_move_out_of_a_touched_date_is_seen(spark, root):
    """A version outside the touched dates still pushes an older one inside them aside."""
    later = DAY + dt.timedelta(days=3)
    at = deployed(spark, root)
    append(spark, at, [fact("a"), fact("a", day=later, loaded=T0 + HOUR), fact("b")])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("c", loaded=T0 + 2 * HOUR)])
    result = run.refresh_daily(spark, at, OPTIONS)
    assert (result.touched_keys, result.touched_dates) == (1, 1)
    assert mart_rows(spark, at) == full_rows(spark, at)


def test_mark_is_strict(spark, root):
    at = deployed(spark, root)
    append(spark, at, [fact("a")])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("b")])
    assert run.refresh_daily(spark, at, OPTIONS).touched_keys == 0
    assert mart_rows(spark, at) != full_rows(spark, at)


def test_null_committee_is_kept_by_full_and_ignored_by_incremental(spark, root):
    at = deployed(spark, root)
    append(spark, at, [fact("a", committee=None), fact("b")])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("c", committee=None, loaded=T0 + HOUR),
                       fact("d", loaded=T0 + HOUR)])
    run.refresh_daily(spark, at, OPTIONS)
    counts = {r["committee_id"]: r["contribution_count"]
              for r in dicts(run.daily_mart(spark, at, OPTIONS))}
    assert counts == {None: 1, "C1": 2}


def test_untouched_keys_of_a_touched_date_stay(spark, root):
    at = deployed(spark, root)
    append(spark, at, [fact("a", committee="C1"), fact("b", committee="C2")])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("c", committee="C1", loaded=T0 + HOUR)])
    assert run.refresh_daily(spark, at, OPTIONS).touched_keys == 1
    counts = {r["committee_id"]: r["contribution_count"]
              for r in dicts(run.daily_mart(spark, at, OPTIONS))}
    assert counts == {"C1": 2, "C2": 1}


@pytest.mark.parametrize("step", ["write_version", "commit", "put_once"])
def test_a_run_broken_off_at_any_step_leaves_the_old_mart(spark, root, monkeypatch, step):
    at = deployed(spark, root)
    first, second, _ = batches(3, moves=True)
    append(spark, at, first)
    run.refresh_daily(spark, at, OPTIONS)
    mark, before = daily_mark(spark, at), mart_rows(spark, at)
    append(spark, at, second)
    done = getattr(versions, step)

    def broken(*args, **more):
        if step == "write_version":
            done(*args, **more)  # the data is there, the commit is not
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(versions, step, broken)
        run.refresh_daily(spark, at, OPTIONS, repair_moved_keys=True)
    assert daily_mark(spark, at) == mark and mart_rows(spark, at) == before
    assert run.refresh_daily(spark, at, OPTIONS, repair_moved_keys=True).touched_keys > 0
    assert mart_rows(spark, at) == full_rows(spark, at)
    assert run.refresh_daily(spark, at, OPTIONS).touched_keys == 0
    versions.vacuum(spark, at.daily, keep=1)
    assert mart_rows(spark, at) == full_rows(spark, at)


def test_a_reader_keeps_its_state_while_a_run_commits(spark, root):
    at = deployed(spark, root)
    first, second, _ = batches(5, moves=True)
    append(spark, at, first)
    run.refresh_daily(spark, at, OPTIONS)
    reader, before = run.daily_mart(spark, at, OPTIONS), mart_rows(spark, at)
    append(spark, at, second)
    run.refresh_daily(spark, at, OPTIONS, repair_moved_keys=True)
    assert sorted(map(tuple, reader.select(*CHECKED).collect()), key=str) == before
    assert mart_rows(spark, at) == full_rows(spark, at) != before


def test_repair_drops_a_partition_that_lost_its_rows(spark, root):
    later = DAY + dt.timedelta(days=3)
    at = deployed(spark, root)
    append(spark, at, [fact("a"), fact("b", day=later)])
    run.refresh_daily(spark, at, OPTIONS)
    append(spark, at, [fact("a", day=later, loaded=T0 + HOUR)])
    run.refresh_daily(spark, at, OPTIONS, repair_moved_keys=True)
    assert mart_rows(spark, at) == full_rows(spark, at)
    assert {r[staging.DATE] for r in dicts(run.daily_mart(spark, at, OPTIONS))} == {later}


def test_only_touched_records_are_shuffled(spark, root):
    """A scope of one date: the history stays in its buckets."""
    at = deployed(spark, root, "month")
    days = [DAY + dt.timedelta(days=d % 20) for d in range(6000)]
    append(spark, at, [fact(f"r{i}", day=d) for i, d in enumerate(days)]
           + [fact("one", day=DAY + dt.timedelta(days=25))])
    raw, lookup = run.raw_facts(spark, at), record_versions(spark, at)
    touched = DAY + dt.timedelta(days=25)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            rows = staging.stg_contributions_within(raw, lambda c: c.isin([touched]), OPTIONS, lookup=lookup)
            assert [r["sub_id"] for r in rows.collect()] == ["one"]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        moved = shuffled_rows(rows)
        assert moved and max(moved) < 10


def shuffled_rows(df):
    """Rows written by each shuffle of the executed plan."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_lazy_merge_equals_stored_merge(spark, root):
    at = deployed(spark, root)
    first, second, _ = batches(4, moves=True)
    append(spark, at, first)
    run.refresh_daily(spark, at, OPTIONS)
    mart = run.daily_mart(spark, at, OPTIONS)
    dims = staging.stg_committees(run.raw_committees(spark, at), OPTIONS)
    raw = facts(spark, first + second)
    lazy = marts.daily_merged(raw, dims, mart, OPTIONS).select(*CHECKED).collect()
    append(spark, at, second)
    run.refresh_daily(spark, at, OPTIONS)
    assert sorted(map(tuple, lazy), key=str) == mart_rows(spark, at)


# ---- marks and windows -----------------------------------------------------------------------

def test_high_water_mark(spark):
    df = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(days=9),), (None,)], "d date")
    assert inc.high_water_mark(df, "d", F.lit(DAY)).first()[0] == DAY
    assert inc.high_water_mark(df.filter("false"), "d", F.lit(DAY)).first()[0] is None


def test_watermark_window(spark):
    df = spark.createDataFrame([(DAY,)], "d date")
    row = inc.watermark_window(df, "d", F.lit(DAY), 7).first()
    assert row["min_date"] == dt.date(2024, 2, 23) and row["mode"] == "watermark"
    assert inc.watermark_window(df.filter("false"), "d", F.lit(DAY)).first()["mode"] == "bootstrap"


def test_window_precedence():
    day, today = dt.date(2024, 5, 1), dt.date(2024, 6, 1)
    with pytest.raises(ValueError):
        inc.resolve_window(since_watermark=True, min_date=day, cycle=2024)
    window = inc.resolve_window(since_watermark=True, mark=day, lookback_days=3, cycle=2024)
    assert (window.min_date, window.allow_empty) == (dt.date(2024, 4, 28), True)
    window = inc.resolve_window(since_watermark=True, cycle=2024, today=today, bootstrap_days=365)
    assert (window.min_date, window.mode) == (dt.date(2023, 6, 2), "bootstrap")
    assert inc.resolve_window(min_date=day, cycle=2024).min_date == day
    assert inc.resolve_window(from_file=True, cycle=2024).min_date is None
    window = inc.resolve_window(cycle=2026, today=dt.date(2025, 3, 1), bootstrap_days=365)
    assert (window.min_date, window.allow_empty) == (dt.date(2025, 1, 1), False)


def test_empty_loads(spark):
    window = inc.Window(None, None, True, "watermark")
    assert inc.should_load(spark.range(0), window) is False
    assert inc.should_load(spark.range(1), window) is True
    with pytest.raises(inc.EmptyLoadError):
        inc.should_load(spark.range(0), inc.Window(None, None, False, "explicit"))


def test_rows_after_mark_of_an_empty_mart(spark):
    rows = spark.createDataFrame([(T0,)], "t timestamp")
    mart = spark.createDataFrame([], "m timestamp")
    assert inc.rows_after_mark(rows, "t", mart, "m").count() == 1


# ---- dimension refresh -----------------------------------------------------------------------

def plan_of(spark, existing, now):
    needed = spark.createDataFrame([("a",), ("b",), ("",), (None,), ("a",)], "k string")
    have = spark.createDataFrame(existing, "k string, t timestamp")
    return {(r["k"], r["mode"]) for r in
            dicts(inc.dimension_refresh_plan(needed, have, "k", "t", now, 7))}


def test_dimension_refresh_modes(spark):
    week = dt.timedelta(days=7)
    assert plan_of(spark, [], T0) == {("a", "full: nothing loaded"), ("b", "full: nothing loaded")}
    assert plan_of(spark, [("", T0)], T0) == {("a", "full: nothing loaded"),
                                              ("b", "full: nothing loaded")}
    assert plan_of(spark, [("a", T0)], T0 + week) == {("b", "delta")}
    assert plan_of(spark, [("a", T0)], T0 + week + HOUR) == {("a", "full: stale"),
                                                             ("b", "full: stale")}
    # The newest load of any row sets the clock.
    assert plan_of(spark, [("a", T0), ("z", T0 + week)], T0 + week + HOUR) == {("b", "delta")}
    assert plan_of(spark, [("a", T0), ("b", T0)], T0) == set()
