"""Whole runs over landed records, in batch and as a stream."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import committee, committees, dicts, lines
from tributary.operators.incremental import EmptyLoadError
from tributary.operators.quality import QualityError
from tributary import __main__ as cli
from tributary.options import Options, Thresholds
from tributary.plans import ingest, marts, run, staging
from tributary.plans.ingest import FactRequest
from tributary.sources import export, layers as tables
from tributary.sources.layers import Layers
from tributary.streaming.landing_stream import start_refresh

OPTIONS = Options(amount_type="decimal(18,2)", as_of=dt.date(2024, 6, 30))
RUN = dt.datetime(2024, 6, 30, 8, tzinfo=dt.UTC)
SMALL = Thresholds(min_volume=2)


def record(sid, cid="C1", day="2024-06-01", amount=10, **more):
    return {"sub_id": sid, "committee_id": cid, "contribution_receipt_date": day,
            "contribution_receipt_amount": amount, "two_year_transaction_period": 2024,
            "contributor_state": "OR", "contributor_name": f"N{sid}"} | more


CATALOGUE = [{"committee_id": f"C{i}", "name": f"Committee {i}", "party": "DFL"}
             for i in range(5)]


def go(spark, at, records, run_at=RUN, thresholds=SMALL, **request):
    wanted = FactRequest(cycle=2024, since_watermark=True, **request)
    return run.run_batch(spark, at, lines(spark, records), lines(spark, CATALOGUE), wanted,
                         run_at=run_at, options=OPTIONS, thresholds=thresholds)


def read_json(path):
    return [json.loads(line) for part in sorted(Path(path).glob("part-*"))
            for line in part.read_text().splitlines()]


def read_published(spark, target, name):
    return read_json(export.published(spark, str(target))[name].removeprefix("file:"))


def test_two_runs(spark, root):
    at = Layers(root)
    first = go(spark, at, [record(1), record(2, "C2"), record(3, day=None), record(None),
                           record(4, is_individual=False),
                           record(5, two_year_transaction_period=2020)])
    assert first.facts.loaded and first.facts.window.mode == "bootstrap"
    assert first.dimension.mode == "full: nothing loaded" and first.daily.mode == "full"
    assert run.raw_facts(spark, at).count() == 2

    second = go(spark, at, [record(2, "C2", amount=99), record(6, "C3", "2024-06-02"),
                            record(7, "C1", "2024-01-01")], RUN + dt.timedelta(hours=1))
    assert second.facts.window.min_date == dt.date(2024, 5, 25)
    assert second.dimension.mode == "delta" and second.daily.mode == "incremental"
    assert second.daily.touched_keys == 2
    summary = {r["committee_id"]: r for r in dicts(run.summary_mart(spark, at, OPTIONS))}
    assert {c: float(r["total_raised"]) for c, r in summary.items()} == {
        "C1": 10, "C2": 99, "C3": 10}
    assert summary["C3"]["committee_name"] == "Committee 3"

    meta = read_published(spark, at.export_path("published"), "meta")[0]
    assert (meta["daily_contributions_rows"], meta["committee_summary_rows"]) == (3, 3)
    assert (meta["date_min"], meta["date_max"], meta["total_raised"]) == (
        "2024-06-01", "2024-06-02", 119.0)
    daily = read_published(spark, at.export_path("published"), "daily_contributions")
    assert [(r["contribution_receipt_date"], r["committee_id"]) for r in daily] == [
        ("2024-06-01", "C1"), ("2024-06-01", "C2"), ("2024-06-02", "C3")]
    ordered = read_published(spark, at.export_path("published"), "committee_summary")
    assert ordered[0]["committee_id"] == "C2" and set(ordered[0]) >= {"party", "donor_states"}

    third = go(spark, at, [record(9, day="2023-01-01")], RUN + dt.timedelta(hours=2))
    assert not third.facts.loaded and third.dimension.mode == "up to date"


def test_cap_takes_the_newest(spark, root):
    at = Layers(root)
    report = go(spark, at, [record(i, day=f"2024-06-{i:02d}") for i in range(1, 10)],
                max_records=3)
    assert report.facts.rows_cut == 6
    assert {r["sub_id"] for r in dicts(run.raw_facts(spark, at))} == {"7", "8", "9"}


@pytest.mark.parametrize("cap", [None, 2_999, 3_000, 100_001])
def test_record_counts_do_not_depend_on_the_cap(spark, root, cap):
    lot = spark.range(3000).selectExpr(
        """concat('{"sub_id":', id + 1, ',"committee_id":"C1","contribution_receipt_date":',
           '"2024-06-01","contribution_receipt_amount":1,"two_year_transaction_period":2024}')
           AS value""")
    load = ingest.ingest_facts(spark, Layers(root), FactRequest(2024, max_records=cap),
                               run_at=RUN, lines=lot, options=OPTIONS, dry_run=True)
    assert load.records == {"n_records": 3000, "n_skipped": 0, "n_unreadable": 0}
    kept = min(3000, cap or 3000)
    assert load.summary["totals"]["n_records"] == kept and load.rows_cut == 3000 - kept


def test_unreadable_committees_are_counted_and_kept(spark, root, tmp_path):
    at = Layers(root)
    ingest_lines(spark, at, [record(1), record(2, "C2")], FactRequest(2024))
    load = ingest.ingest_committees(
        spark, at, lines(spark, [CATALOGUE[1], {"committee_id": "C2", "first_file_date": "x"},
                                 "{bad", {}]), now=RUN, quarantine_path=str(tmp_path / "bad"))
    assert load.records == {"n_records": 4, "n_skipped": 1, "n_unreadable": 2}
    assert {r["reject_reason"] for r in dicts(spark.read.json(str(tmp_path / "bad")))} == {
        "bad date", "malformed json"}


def ingest_lines(spark, at, records, request, **more):
    return ingest.ingest_facts(spark, at, request, run_at=RUN, lines=lines(spark, records),
                               options=OPTIONS, **more)


def test_dry_run_writes_nothing(spark, root):
    at = Layers(root)
    load = ingest_lines(spark, at, [record(1), record(2, ""), record(None), "{bad"],
                        FactRequest(2024), dry_run=True)
    assert load.records == {"n_records": 4, "n_skipped": 1, "n_unreadable": 1}
    assert not load.loaded and not Path(root).exists()
    assert load.summary["totals"]["n_records"] == 2 and load.summary["totals"]["n_entities"] == 1
    assert load.summary["peak"]["is_concentrated"]


def test_request_filters(spark, root, tmp_path):
    at = Layers(root)
    request = FactRequest(2024, min_date=dt.date(2024, 5, 1), max_date=dt.date(2024, 6, 1),
                          state="OR", min_amount=5, max_records=2)
    ingest_lines(spark, at, [
        record(1), record(2, amount=4), record(3, contributor_state="WA"),
        record(4, day="2024-04-30"), record(5, day="2024-06-02"), record(6, day="2024-05-02"),
        record(7, day="2024-05-01"), record(8, amount="much")], request,
        sample_path=str(tmp_path / "sample"), quarantine_path=str(tmp_path / "bad"))
    assert [r["reject_reason"] for r in dicts(spark.read.json(str(tmp_path / "bad")))] == [
        "bad amount"]
    assert {r["sub_id"] for r in dicts(run.raw_facts(spark, at))} == {"1", "6"}
    assert spark.read.json(str(tmp_path / "sample")).count() == 2


def test_empty_window(spark, root):
    at = Layers(root)
    load = ingest_lines(spark, at, [], FactRequest(2024, since_watermark=True))
    assert not load.loaded and load.summary is None
    with pytest.raises(EmptyLoadError):
        ingest_lines(spark, at, [], FactRequest(2024))
    with pytest.raises(ValueError):
        ingest_lines(spark, at, [record(1)],
                     FactRequest(2024, since_watermark=True, min_date=dt.date(2024, 1, 1)))


def test_input_file_is_loaded_as_it_is(spark, root, tmp_path):
    at = Layers(root)
    path = tmp_path / "cached.ndjson"
    path.write_text(json.dumps(record(1, None, "1999-01-01", is_individual=False)) + "\n")
    ingest.ingest_facts(spark, at, FactRequest(2024), run_at=RUN, input_file=str(path))
    row = dicts(run.raw_facts(spark, at))[0]
    assert row["committee_id"] is None and row["contributor_city"] is None


def test_committees_of_a_cycle_replace_the_dimension(spark, root, tmp_path):
    at = Layers(root)
    records = [{"committee_id": f"C{i}", "cycles": [2022, 2024] if i % 2 else [2022],
                "name": f"N{i}"} for i in range(6)] + [{"committee_id": "C9", "cycle": 2024}, {}]
    for cap, want in ((None, {"C1", "C3", "C5", "C9"}), (2, {"C1", "C3"})):
        load = ingest.ingest_committees_of_cycle(at, lines(spark, records), 2024,
                                                 max_records=cap)
        assert load.records == {"n_records": 8, "n_skipped": 1, "n_unreadable": 0}
        assert {r["committee_id"] for r in dicts(run.raw_committees(spark, at))} == want
    path = tmp_path / "committees.ndjson"
    path.write_text(json.dumps({"committee_id": "C7"}) + "\n")
    load = ingest.ingest_committee_file(spark, at, str(path), dry_run=True,
                                        sample_path=str(tmp_path / "sample"))
    assert not load.loaded and load.summary == {"committees": 1, "parties": {"Unknown": 1}}
    assert spark.read.json(str(tmp_path / "sample")).count() == 1
    assert run.raw_committees(spark, at).count() == 2
    ingest.ingest_committee_file(spark, at, str(path))
    assert [r["committee_id"] for r in dicts(run.raw_committees(spark, at))] == ["C7"]
    with pytest.raises(EmptyLoadError):
        ingest.ingest_committees_of_cycle(at, lines(spark, records), 1990)


def test_dimension_summary(spark):
    rows = committees(spark, [committee("C1", party=""), committee("C2"), committee("C3")])
    assert ingest.dimension_summary(rows) == {"committees": 3,
                                              "parties": {"DEM": 2, "Unknown": 1}}


def test_command_line(spark, root, tmp_path, capsys):
    facts_file, dims_file = tmp_path / "f.ndjson", tmp_path / "c.ndjson"
    facts_file.write_text("\n".join(json.dumps(record(i)) for i in range(1, 6)) + "\n")
    dims_file.write_text("\n".join(json.dumps(c) for c in CATALOGUE))
    load_time = dt.datetime(2024, 6, 30, 8, tzinfo=dt.UTC)

    def call(*words, now=load_time):
        args = cli.arguments().parse_args(["--root", root, "--grain", "month", *words])
        return cli.perform(spark, args, OPTIONS, SMALL, now)

    assert call("freshness") == 1
    assert call("contributions", "--records", str(facts_file), "--cycle", "2024",
                "--min-date", "2024-01-01") == 0
    assert call("committees", "--records", str(dims_file), "--from-contributions") == 0
    assert call("marts") == 0 and call("marts", "--full-refresh") == 0
    assert call("export", "--publish-to", str(tmp_path / "site")) == 0
    assert read_published(spark, tmp_path / "site", "meta")[0]["total_contributions"] == 5
    assert call("freshness", now=load_time + dt.timedelta(hours=24, minutes=59)) == 0
    assert call("freshness", "--hours", "1", now=load_time + dt.timedelta(hours=2)) == 1
    facts_file.write_text(json.dumps(record(9, day="2024-06-03")))
    assert call("batch", "--records", str(facts_file), "--committee-records", str(dims_file),
                "--cycle", "2024", "--since-watermark",
                now=load_time + dt.timedelta(days=1)) == 0
    assert "incremental" in capsys.readouterr().out
    assert read_published(spark, Path(root) / "export/published", "meta")[0]["date_max"] == "2024-06-03"


def test_failed_assertion_stops_the_run(spark, root):
    at = Layers(root)
    with pytest.raises(QualityError, match="min_volume"):
        go(spark, at, [record(1)], thresholds=Thresholds(min_volume=100))
    assert not Path(at.export_path("current")).exists()


def test_orphans_stop_the_run(spark, root):
    with pytest.raises(QualityError, match="orphan_ratio"):
        go(spark, Layers(root), [record(1), record(2, "C99")])


def test_dimension_needs_facts(spark, root):
    with pytest.raises(EmptyLoadError):
        ingest.ingest_committees(spark, Layers(root), lines(spark, []), now=RUN)


def test_stream_feeds_the_mart(spark, root, tmp_path):
    at = Layers(root)
    incoming = tmp_path / "incoming"
    (incoming / "one").mkdir(parents=True)
    options = Options(amount_type="decimal(18,2)")
    tables.write_dimension(committees(spark, [committee("C1")]), at.committees, append=False)

    counts = []

    def drop(name, records):
        path = incoming / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(json.dumps(r) for r in records) + "\n\n")
        query = start_refresh(spark, at, str(incoming), str(tmp_path / "ckpt"), options, 1,
                              quarantine_path=str(tmp_path / "bad"), on_batch=counts.append)
        query.awaitTermination(300)
        assert query.exception() is None

    drop("one/a.ndjson", [record(1), record(2, "C2"), record(None), record(8, amount="much")])
    assert counts == [{"n_records": 4, "n_skipped": 1, "n_unreadable": 1}]
    assert spark.read.json(str(tmp_path / "bad")).count() == 1
    drop("two/b.ndjson", [record(1, amount=25), record(3, day="2024-06-02")])
    drop("two/c.ndjson", [record(3, day="2024-06-02", amount=7)])
    got = {(str(r["contribution_receipt_date"]), r["committee_id"]): float(r["total_amount"])
           for r in dicts(run.daily_mart(spark, at, options))}
    assert got == {("2024-06-01", "C1"): 25, ("2024-06-01", "C2"): 10, ("2024-06-02", "C1"): 7}
    whole = marts.daily_contributions(
        staging.stg_contributions(run.raw_facts(spark, at), options),
        staging.stg_committees(run.raw_committees(spark, at), options), options)
    assert whole.agg(F.sum("total_amount")).first()[0] == 42
