"""Latest versions in a stream, and counts from footers."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq

from helpers import plan
from tributary.sources import footers
from tributary.streaming.latest import latest_versions, start_latest

SCHEMA = "sub_id string, at timestamp, amount double"


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("sub_id", "at", "amount"), r))) for r in rows))


def test_versions_inside_and_outside_the_bound(spark, tmp_path):
    came, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(came))
        query = start_latest(stream, out, str(tmp_path / "ckpt"), ["sub_id"], ["at", "amount"], "at", "1 hour")
        query.awaitTermination()
        return sorted((r["sub_id"], r["at"].hour, r["amount"], r["n_versions"])
                      for r in spark.read.parquet(out).collect() if r["sub_id"])

    land(came, "1", ("a", "2024-03-01 10:00:00", 1.0), ("a", "2024-03-01 10:20:00", 2.0),
         ("a", "2024-03-01 10:20:00", 2.0), ("b", None, 9.0), (None, "2024-03-01 10:00:00", 5.0))
    land(came, "2", ("a", "2024-03-01 10:10:00", 3.0))  # an older version that comes late, inside the bound
    assert run() == []
    land(came, "3", ("z", "2024-03-01 20:00:00", 1.0))
    assert run() == [("a", 10, 2.0, 4)]
    land(came, "4", ("a", "2024-03-01 10:30:00", 7.0))  # outside: the session is closed
    land(came, "5", ("a", "2024-03-01 20:30:00", 4.0), ("y", "2024-03-02 09:00:00", 1.0))
    rows = spark.read.parquet(out)
    assert run() == [("a", 10, 2.0, 4), ("a", 20, 4.0, 1), ("z", 20, 1.0, 1)]
    assert rows.filter("sub_id is null").count() == 1 and rows.columns == ["sub_id", "at", "amount", "n_versions"]


def test_a_table_gives_the_same(spark):
    at = dt.datetime(2024, 3, 1, 10)
    rows = spark.createDataFrame([("a", at, 1.0), ("a", at + dt.timedelta(minutes=59), 2.0),
                                  ("a", at + dt.timedelta(hours=5), 0.5), ("b", at, None), ("b", at, 1.0)], SCHEMA)
    got = latest_versions(rows, ["sub_id"], ["at", "amount"], "at", "1 hour").collect()
    assert sorted((r["sub_id"], r["amount"], r["n_versions"]) for r in got) == [
        ("a", 0.5, 1), ("a", 2.0, 2), ("b", 1.0, 2)]
    assert latest_versions(rows.limit(0), ["sub_id"], ["at"], "at", "1 hour").count() == 0


def dates(path, values, **options):
    pq.write_table(pa.table({"d": pa.array(values, pa.date32()), "k": list(range(len(values)))}), path, **options)
    return [str(path)]


def test_extremes_come_from_footers(spark, tmp_path):
    days = [dt.date(2024, 3, d) for d in (5, 1, 9)]
    good = dates(tmp_path / "good.parquet", [*days, None])
    text = plan(footers.extremes(footers.footer_session(spark), good, "d"))
    assert "PushedAggregation: [COUNT(*), MIN(d), MAX(d)]" in text
    assert tuple(footers.extremes_now(spark, good, "d")) == (4, days[1], days[2])
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert footers.newest_up_to(spark, good, "d", days[2]) == days[2]
    assert footers.newest_up_to(spark, good, "d", dt.date(2024, 3, 8)) == days[0]
    assert footers.newest_up_to(spark, good, "d", dt.date(2024, 2, 1)) is None


def test_files_without_statistics_are_scanned(spark, tmp_path):
    days = [dt.date(2024, 3, 5), dt.date(2024, 3, 1)]
    bare = dates(tmp_path / "bare.parquet", days, write_statistics=False)
    assert tuple(footers.extremes_now(spark, bare, "d")) == (2, days[1], days[0])
    nothing = dates(tmp_path / "nothing.parquet", [None, None])
    assert tuple(footers.extremes_now(spark, nothing, "d")) == (2, None, None)
    assert footers.newest_up_to(spark, nothing, "d", days[0]) is None
