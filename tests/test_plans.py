"""Plan shape: what reaches the scan, what is shuffled, what is broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from helpers import DAY, T0, fact, facts, plan
from tributary.operators.quality import coverage
from tributary.operators.selection import windowed_fetch
from tributary.plans import marts, run, staging
from tributary.plans.stored import append_facts, record_versions
from tributary.registry import adapters
from tributary.registry.queries import REGISTRY
from tributary.sources import layers as tables, ledger
from tributary.sources.layers import Layers

SF = "/root/testdata/sf0.001"


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<(.*)>", text)


@pytest.mark.parametrize("key", sorted(set(REGISTRY) - {"incremental_run", "scan_ndjson"}))
def test_no_product_joins_and_no_python(spark, key):
    text = plan(REGISTRY[key](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "EvalPython" not in text and "InPandas" not in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(staging.stg_contributions(adapters.contributions(spark, SF), adapters.OPTIONS))
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_aggregate_comes_before_the_dimension_join(spark):
    staged = staging.stg_contributions(adapters.contributions(spark, SF), adapters.OPTIONS)
    dims = staging.stg_committees(adapters.committees(spark, SF), adapters.OPTIONS)
    tree = plan(marts.committee_summary(staged, dims, adapters.OPTIONS)).split("\n(1)")[0]
    assert tree.index("Join LeftOuter") < tree.index("HashAggregate")


def test_orphans_are_counted_per_key_before_the_join(spark):
    left = spark.range(10).select((F.col("id") % 3).alias("k"))
    tree = plan(coverage(left, spark.range(2).withColumnRenamed("id", "k"), "k")).split("\n(1)")[0]
    join = tree.index("LeftOuter")
    assert "HashAggregate" in tree[join:]


def test_month_total_reads_one_month_of_few_columns(spark):
    text = plan(REGISTRY["month_total_pruned"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-07-01T00:00)" in text
    for schema in read_schemas(text):
        assert not {"o_custkey", "o_orderpriority"} & set(re.findall(r"(o_\w+):", schema))


def test_scoped_staging_reads_whole_rows_only_in_scope(spark, root):
    days = [DAY.replace(day=d) for d in range(1, 7)]
    at = Layers(root)
    tables.append_by_date(facts(spark, [fact(f"s{d}", day=d) for d in days]), at.facts,
                          staging.DATE)
    raw = run.raw_facts(spark, at)
    staged = staging.stg_contributions_within(raw, lambda c: c.isin(days[:2]))
    text = plan(marts.daily_stats(staged))
    # the rows in scope were read once and kept; the plan reads others by three columns
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", text)
    assert len(filters) == 1 and "NOT" in filters[0] and "Scan ExistingRDD" in text
    assert len(read_schemas(text)) == 1 and "committee_id" not in read_schemas(text)[0]


def test_stored_history_is_looked_up_in_its_buckets(spark, root):
    """No row of the history is exchanged, only buckets of the touched ids are read, in any session's settings."""
    at = Layers(root, grain="month", buckets=8)
    days = [DAY + dt.timedelta(days=d) for d in range(20)]
    append_facts(facts(spark, [fact(f"s{i}", day=days[i % 19]) for i in range(400)]), at)
    append_facts(facts(spark, [fact("s1", day=days[19], loaded=T0 + dt.timedelta(hours=1)), fact("new", day=days[19])]), at)
    lookup = record_versions(spark, at)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.createDataFrame([("s1",), ("new",)], "sub_id string")
        found = lookup(ids)
        text = plan(found)
        assert "Bucketed: true" in text
        history, touched = text.split("\n(1)")[0].split("Exchange")
        assert "Scan parquet" in history and "Scan parquet" not in touched  # only the ids are exchanged
        buckets = {r[0] for r in ids.select(ledger.bucket_of(F.col("sub_id"), 8)).collect()}
        assert {int(re.search(r"bucket=(\d+)", x)[1]) for x in found.inputFiles()} <= buckets
        staged = staging.stg_contributions_within(run.raw_facts(spark, at), lambda c: c.isin(days[1:2]), lookup=lookup)
        assert sorted(r["sub_id"] for r in staged.collect()) == sorted(
            f"s{i}" for i in range(400) if i % 19 == 1 and i != 1)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_new_rows_push_the_mark_to_the_scan(spark, root):
    at = Layers(root)
    tables.append_by_date(facts(spark, [fact("a")]), at.facts, staging.DATE)
    fresh = run.raw_facts(spark, at).filter(F.col("_loaded_at") > F.lit("2024-03-01").cast(
        "timestamp"))
    assert "GreaterThan(_loaded_at," in plan(staging.stg_contributions(fresh))


def test_capped_fetch_counts_before_it_reads(spark, root):
    days = [DAY.replace(day=d) for d in range(1, 7)]
    at = Layers(root)
    tables.append_by_date(facts(spark, [fact(f"s{d}", day=d) for d in days]), at.facts,
                          staging.DATE)
    rows = windowed_fetch(run.raw_facts(spark, at), record_id="sub_id", event_date=staging.DATE,
                          amount="contribution_receipt_amount", max_records=2)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[.*2024-03-05", text)
    assert "TakeOrderedAndProject" in text and "Window" not in text
    assert {r["sub_id"] for r in rows.collect()} == {f"s{d}" for d in days[-2:]}
