"""Versioned tables, the batch ledger, and the counted summary state."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import DAY, T0, committee, committees, fact, facts, plan
from tributary.operators.quality import QualityError
from tributary.options import Options, Thresholds
from tributary.plans import check_state, marts, run, staging, summary_state
from tributary.plans.stored import append_facts
from tributary.sources import export, layers as tables, ledger, versions
from tributary.sources.layers import Layers

OPTIONS = Options(amount_type="decimal(18,2)", as_of=dt.date(2024, 12, 31))
HOUR = dt.timedelta(hours=1)


# ---- versions --------------------------------------------------------------------------------

SCHEMA = {"k": "string", "d": "date"}


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, d date")


def content(spark, path):
    return sorted(map(tuple, versions.read(spark, path, SCHEMA, "d").collect()), key=str)


def test_partitions_change_in_one_step(spark, root):
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    assert versions.read(spark, root, SCHEMA, "d") is None
    versions.replace(table(spark, [("a", days[0]), ("b", days[1]), ("c", None)]), root, "d")
    old = versions.read(spark, root, SCHEMA, "d")
    state = versions.replace(table(spark, [("x", days[1]), ("y", days[2])]), root, "d",
                             touched=[str(days[0]), str(days[1]), str(days[2])], notes={"mark": "1"})
    assert state.number == 2 and state.notes == {"mark": "1"}
    assert content(spark, root) == sorted([("x", days[1]), ("y", days[2]), ("c", None)], key=str)
    assert len(old.collect()) == 3 and {r["k"] for r in old.collect()} == {"a", "b", "c"}
    only = versions.read(spark, root, SCHEMA, "d", only=[str(days[2])])
    assert [r["k"] for r in only.collect()] == ["y"]


def test_two_writers_from_one_state(spark, root):
    base = versions.replace(table(spark, [("a", DAY)]), root, "d")
    versions.replace(table(spark, [("b", DAY)]), root, "d", base)
    with pytest.raises(versions.CommitConflict):
        versions.replace(table(spark, [("c", DAY)]), root, "d", base)
    assert content(spark, root) == [("b", DAY)]


def test_vacuum_keeps_the_newest_states(spark, root):
    for k in "abcd":
        versions.replace(table(spark, [(k, DAY)]), root, "d")
    kept = versions.read(spark, root, SCHEMA, "d", state=versions.Commit(**versions.head(spark, root).__dict__))
    versions.write_version(table(spark, [("lost", DAY)]), root, "d")
    versions.vacuum(spark, root, keep=2)
    assert len([p for p in (Path(root) / "data").iterdir() if p.is_dir()]) == 2
    assert len([p for p in (Path(root) / "_commits").iterdir() if p.name.endswith(".json")]) == 2
    assert content(spark, root) == [("d", DAY)] and kept.count() == 1


def test_empty_tables(spark, root):
    versions.replace(table(spark, []), root, "d")
    assert content(spark, root) == []
    versions.replace(table(spark, []), f"{root}-plain")
    assert versions.read(spark, f"{root}-plain", SCHEMA).count() == 0


# ---- publishing ------------------------------------------------------------------------------

def test_publishing_switches_all_snapshots_at_once(spark, root, monkeypatch):
    def write(n):
        days = spark.range(n).select(*[F.lit(None).cast(t).alias(c) for c, t in export.EXPORT_DAILY.items()])
        sums = spark.range(n).select(*[F.lit(None).cast(t).alias(c) for c, t in export.EXPORT_SUMMARY.items()])
        meta = spark.range(n).select(*[F.lit(None).cast(t).alias(c) for c, t in export.EXPORT_META.items()])
        export.write_snapshots(root, days, sums, meta)

    def rows():
        return {name: spark.read.text(path).count() for name, path in export.published(spark, f"{root}-out").items()}

    assert export.published(spark, f"{root}-out") == {}
    write(1)
    export.publish(spark, root, f"{root}-out")
    write(2)
    for step in ("commit", "put_once"):
        def broken(*args, **more):
            raise OSError("lost")

        with monkeypatch.context() as patch, pytest.raises(OSError):
            patch.setattr(versions, step, broken)
            export.publish(spark, root, f"{root}-out")
        assert set(rows().values()) == {1}
    export.publish(spark, root, f"{root}-out")
    assert set(rows().values()) == {2} and len(rows()) == 3


# ---- batches ---------------------------------------------------------------------------------

def test_a_batch_is_loaded_once(spark, root):
    at = Layers(root, buckets=4)
    rows = facts(spark, [fact("a"), fact("b", day=DAY + dt.timedelta(days=1))])
    assert append_facts(rows, at, "one") and not append_facts(rows, at, "one")
    assert append_facts(facts(spark, [fact("c", loaded=T0 + HOUR)]), at, "a/b c%2F'\u00e9")
    assert run.raw_facts(spark, at).count() == 3 and ledger.index(spark, at).count() == 3
    assert [(b.number, b.batch, len(b.dates)) for b in ledger.entries(spark, at)] == [
        (1, "one", 2), (2, "a/b c%2F'\u00e9", 1)]
    assert append_facts(facts(spark, []), at, "nothing") and run.raw_facts(spark, at).count() == 3


@pytest.mark.parametrize("step", ["_add_to_index", "put_once"])
def test_a_broken_batch_is_never_read(spark, root, monkeypatch, step):
    at = Layers(root, buckets=4)
    assert append_facts(facts(spark, [fact("a")]), at, "one")
    where = ledger if step == "_add_to_index" else versions

    def broken(*args, **more):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(where, step, broken)
        append_facts(facts(spark, [fact("b"), fact("c")]), at, "two")
    assert run.raw_facts(spark, at).count() == 1 and ledger.index(spark, at).count() == 1
    assert append_facts(facts(spark, [fact("b")]), at, "two")
    assert run.raw_facts(spark, at).count() == 2 and ledger.index(spark, at).count() == 2


def test_a_first_batch_that_broke_off_is_no_table(spark, root, monkeypatch):
    at = Layers(root, buckets=4)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(ledger, "_add_to_index", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        append_facts(facts(spark, [fact("a")]), at, "one")
    assert run.raw_facts(spark, at) is None


# ---- counted summary -------------------------------------------------------------------------

def moving_batches(seed, n=4):
    """Records that come again, move between committees, change state, donor, amount and date."""
    rng, made, out = random.Random(seed), [], []
    for b in range(n):
        rows = []
        for i in range(60):
            sid = rng.choice(made) if made and rng.random() < 0.5 else f"b{b}-{i}"
            made.append(sid)
            rows.append(fact(sid, committee=rng.choice(["C1", "C2", "C3", "", None]), amount=float(rng.randrange(-50, 400)) / 4,
                             day=DAY + dt.timedelta(days=rng.randrange(300)), loaded=T0 + HOUR * (rng.randrange(100 * n)),
                             state=rng.choice(["OR", "WA", "", None]), name=rng.choice(["A", "B", "C", "", None])))
        rows += rows[:5]
        out.append(rows)
    return out


def full_summary(spark, at, options):
    rows = marts.committee_summary(staging.stg_contributions(run.raw_facts(spark, at), options),
                                   staging.stg_committees(run.raw_committees(spark, at), options), options)
    return sorted(map(tuple, rows.collect()), key=str)


def summary(spark, at, options):
    return sorted(map(tuple, run.summary_mart(spark, at, options).collect()), key=str)


@pytest.mark.parametrize("options", [OPTIONS, Options(as_of=dt.date(2024, 12, 31)),
                                     Options(amount_type="decimal(18,2)", average_type="double", as_of=dt.date(2024, 12, 31))])
def test_counted_summary_equals_a_rebuild(spark, root, options):
    at = Layers(root, grain="month", buckets=4)
    tables.write_dimension(committees(spark, [committee("C1"), committee("C2")]), at.committees, append=False)
    for rows in moving_batches(11):
        append_facts(facts(spark, rows), at)
        assert run.update_summary(spark, at, options) > 0
        assert summary(spark, at, options) == full_summary(spark, at, options)
    assert run.update_summary(spark, at, options) == 0


def test_counted_summary_of_dates_that_come(spark, root):
    at = Layers(root, buckets=4)
    tables.write_dimension(committees(spark, [committee("C1")]), at.committees, append=False)
    append_facts(facts(spark, [fact("a"), fact("a", day=DAY + dt.timedelta(days=9), loaded=T0 + HOUR, amount=3.0),
                               fact("b", day=DAY + dt.timedelta(days=20))]), at)
    for days in (0, 5, 9, 30):
        options = Options(amount_type="decimal(18,2)", as_of=DAY + dt.timedelta(days=days))
        run.update_summary(spark, at, options)
        assert summary(spark, at, options) == full_summary(spark, at, options)
    with pytest.raises(ValueError):
        run.update_summary(spark, at, Options(amount_type="decimal(18,2)", as_of=DAY))


def test_an_update_replaces_only_touched_shards(spark, root, monkeypatch):
    at = Layers(root, buckets=4)
    tables.write_dimension(committees(spark, [committee(f"C{i}") for i in range(40)]), at.committees, append=False)
    append_facts(facts(spark, [fact(f"s{i}", committee=f"C{i}") for i in range(40)]), at)
    run.update_summary(spark, at, OPTIONS)
    before = versions.head(spark, at.summary_state).parts
    append_facts(facts(spark, [fact("s3", committee="C5", loaded=T0 + HOUR)]), at)
    read = []
    real = versions.read
    monkeypatch.setattr(versions, "read", lambda *a, **k: (read.append(a[-1] if len(a) > 6 else k.get("only")), real(*a, **k))[1])
    assert run.update_summary(spark, at, OPTIONS) == 2
    after = versions.head(spark, at.summary_state).parts
    changed = {p for p in after if after[p] != before.get(p)} | (set(before) - set(after))
    assert 0 < len(changed) <= 4
    assert {p for p in read[0] if p.startswith("cells-")} == {p for p in changed if p.startswith("cells-")}
    assert summary(spark, at, OPTIONS) == full_summary(spark, at, OPTIONS)
    assert summary_state.stats(spark, at, OPTIONS).filter("committee_id = 'C3'").count() == 0


# ---- counted assertions ----------------------------------------------------------------------

def verdicts(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return dict(rows)


def whole_suite(spark, at, options, thresholds):
    return verdicts(run.check_marts(spark, at, run.staged_for_marts(spark, at, options), options, thresholds))


def test_counted_assertions_equal_the_whole_suite(spark, root):
    at = Layers(root, grain="month", buckets=4)
    limits = Thresholds(min_volume=150, max_orphan_ratio=0.3)
    tables.write_dimension(committees(spark, [committee("C1"), committee("C2"), committee("C9", name=None)]),
                           at.committees, append=False)
    for rows in moving_batches(5, n=3):
        append_facts(facts(spark, rows), at)
        run.refresh_daily(spark, at, OPTIONS)
        run.update_summary(spark, at, OPTIONS)
        check_state.update(spark, at, OPTIONS)
        got = verdicts(check_state.results(spark, at, OPTIONS, limits))
        assert got == whole_suite(spark, at, OPTIONS, limits)
    assert got["not_null:stg_contributions.committee_id"] > 0 and got["not_null:stg_committees.committee_name"] == 1
    number = versions.head(spark, at.check_state).number
    assert check_state.update(spark, at, OPTIONS) == [] and versions.head(spark, at.check_state).number == number


def test_assertions_read_touched_partitions_only(spark, root, monkeypatch):
    at = Layers(root, buckets=4)
    days = [DAY + dt.timedelta(days=i) for i in range(6)]
    tables.write_dimension(committees(spark, [committee("C1")]), at.committees, append=False)
    append_facts(facts(spark, [fact(f"s{i}", day=d) for i, d in enumerate(days)]), at)
    run.build_and_check(spark, at, OPTIONS, Thresholds(min_volume=1), counted_summary=True)
    append_facts(facts(spark, [fact("new", day=days[2], loaded=T0 + HOUR)]), at)
    run.refresh_daily(spark, at, OPTIONS)
    run.update_summary(spark, at, OPTIONS)
    read, real = [], versions.read
    monkeypatch.setattr(versions, "read", lambda *a, **k: (read.append((a[1], k.get("only"))), real(*a, **k))[1])
    monkeypatch.setattr(check_state, "raw_facts", lambda *a: pytest.fail("raw facts are read"))
    assert check_state.update(spark, at, OPTIONS) == [str(days[2])]
    assert [only for path, only in read if path == at.daily] == [[str(days[2])]]
    monkeypatch.undo()
    assert verdicts(check_state.results(spark, at, OPTIONS)) == whole_suite(spark, at, OPTIONS, Thresholds())
    with pytest.raises(QualityError, match="min_volume"):
        run.build_and_check(spark, at, OPTIONS, counted_summary=True)


def test_assertions_after_partitions_go_and_dates_come(spark, root):
    at = Layers(root, buckets=4)
    tables.write_dimension(committees(spark, [committee("C1")]), at.committees, append=False)
    append_facts(facts(spark, [fact("a"), fact("b", day=DAY + dt.timedelta(days=9)), fact("a", day=DAY + dt.timedelta(days=3),
                                                                                          loaded=T0 + HOUR)]), at)
    for days in (1, 5, 9):
        options = Options(amount_type="decimal(18,2)", as_of=DAY + dt.timedelta(days=days))
        run.refresh_daily(spark, at, options, full_refresh=True)
        run.update_summary(spark, at, options)
        check_state.update(spark, at, options)
        assert verdicts(check_state.results(spark, at, options)) == whole_suite(spark, at, options, Thresholds())


# ---- marts from the index --------------------------------------------------------------------

def test_newest_versions_come_from_the_index_in_place(spark, root):
    at = Layers(root, grain="month", buckets=4)
    for rows in moving_batches(3, n=2):
        append_facts(facts(spark, rows), at)
    found = run.staged_for_marts(spark, at, OPTIONS)
    assert "Exchange" not in plan(found)
    whole = staging.stg_contributions(run.raw_facts(spark, at), OPTIONS).select(*run.STAGED_FOR_MARTS)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_counted_state_has_one_row_for_records_that_are_alike(spark, root):
    at = Layers(root, buckets=4)
    tables.write_dimension(committees(spark, [committee("C1")]), at.committees, append=False)
    # A state of other rows, as an earlier release left it, is built anew.
    old = spark.createDataFrame([("C9", "amount", 1, "cells-0")], "committee_id string, kind string, n bigint, piece string")
    versions.replace(old, at.summary_state, "piece", notes={"batch": "1", "as_of": "2024-12-31"})
    append_facts(facts(spark, [fact("a"), fact("b"), fact("c", amount=3.0), fact("d", name="B")]), at)
    assert run.update_summary(spark, at, OPTIONS) == 1
    state = versions.head(spark, at.summary_state)
    cells = [p for p in state.parts if p.startswith("cells-")]
    rows = versions.read(spark, at.summary_state, {"n": "bigint"}, "piece", "string", state, cells)
    assert sorted(r["n"] for r in rows.collect()) == [1, 1, 2]
    assert summary(spark, at, OPTIONS) == full_summary(spark, at, OPTIONS)
    append_facts(facts(spark, [fact("b", name="B", loaded=T0 + HOUR)]), at)
    assert run.update_summary(spark, at, OPTIONS) == 1
    assert summary(spark, at, OPTIONS) == full_summary(spark, at, OPTIONS)
