"""Raw facts as batches: a ledger of batch ids, and an index of record versions in buckets.

A batch is written to ``data/batch=<id>/`` by date and, narrowed to what the marts read, to the index.
Its ledger entry, renamed into place last, makes both visible. A batch whose id is in the ledger is
not loaded again; one that broke off left no entry, so its rows are never read and the next try
replaces them. Ledger entries are numbered, and tell which dates a batch brought and how new it is.

The index is a bucketed table over its folder, declared in the session's catalog when it is needed:
bucket of a record id = folder of its hash. A lookup of ids therefore reads only their buckets, and
joins them without moving the index, in any session.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.schemas import RAW_FACTS, ddl
from tributary.sources import layers as tables, versions
from tributary.sources.layers import Layers

DATE = "contribution_receipt_date"
#: Columns of the raw facts that decide a record's version and that the marts aggregate.
INDEXED = ["sub_id", "_loaded_at", DATE, "contribution_receipt_amount", "committee_id", "contributor_state",
           "contributor_name"]


@dataclass(frozen=True)
class Batch:
    number: int
    batch: str
    dates: tuple[dt.date | None, ...]
    loaded_at: dt.datetime | None


def _folder_name(batch: str) -> str:
    """A batch's folder; ids may hold any characters."""
    return hashlib.md5(batch.encode()).hexdigest()


def entries(spark: SparkSession, layers: Layers) -> list[Batch]:
    """Committed batches in order; one small entry each."""
    if not [x for x in versions.listed(spark, layers.ledger) if x.endswith(".json") and x[0] != "."]:
        return []
    rows = spark.read.schema("number long, batch string, dates array<date>, loaded_at timestamp").json(
        layers.ledger).collect()
    return sorted((Batch(r["number"], r["batch"], tuple(r["dates"]), r["loaded_at"]) for r in rows),
                  key=lambda b: b.number)


def _index_name(layers: Layers) -> str:
    return "record_versions_" + hashlib.md5(layers.fact_index.encode()).hexdigest()


def _declare(spark: SparkSession, layers: Layers) -> str:
    name = _index_name(layers)
    columns = {c: RAW_FACTS[c] for c in INDEXED} | {"batch": "string", "bucket": "int"}
    where = layers.fact_index.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(columns)}) USING parquet PARTITIONED BY (batch, bucket) "
              f"CLUSTERED BY (sub_id) SORTED BY (sub_id) INTO {layers.buckets} BUCKETS LOCATION '{where}'")
    return name


def bucket_of(record_id: Column, buckets: int) -> Column:
    """The bucket that Spark files a record id under."""
    return F.pmod(F.hash(record_id), F.lit(buckets)).cast("int")


def _add_to_index(loaded: DataFrame, layers: Layers, name: str) -> None:
    """Write a batch's rows to its own partitions of the index, in place of what a broken run left there."""
    spark, table = loaded.sparkSession, _declare(loaded.sparkSession, layers)
    narrow = loaded.select(*INDEXED, bucket_of(F.col("sub_id"), layers.buckets).alias("bucket"))
    view = f"batch_{uuid.uuid4().hex}"
    narrow.repartition(layers.buckets, "sub_id").createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch = '{name}', bucket) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def append(rows: DataFrame, layers: Layers, batch: str | None = None) -> bool:
    """Load a batch once; False if its id is in the ledger already."""
    spark = rows.sparkSession
    batch = uuid.uuid4().hex if batch is None else batch
    known = entries(spark, layers)
    if batch in {b.batch for b in known}:
        return False
    name = _folder_name(batch)
    folder = f"{layers.facts}/data/batch={name}"
    tables.overwrite_by_date(rows.select(*RAW_FACTS), folder, DATE, layers.grain, ["committee_id"])
    loaded = tables.read_by_date(spark, folder, RAW_FACTS, DATE, layers.grain)
    _add_to_index(loaded, layers, name)
    dates = loaded.groupBy(DATE).agg(F.max("_loaded_at").alias("newest")).collect()
    times = [r["newest"] for r in dates if r["newest"] is not None]
    number = max((b.number for b in known), default=0) + 1
    files, at = versions.files_of(spark, layers.ledger)
    files.mkdirs(at)
    versions.put_once(spark, f"{layers.ledger}/{number:08d}.json", json.dumps({
        "number": number, "batch": batch, "dates": sorted(str(r[DATE]) for r in dates if r[DATE] is not None),
        "loaded_at": max(times).isoformat() if times else None}))
    return True


def read(spark: SparkSession, layers: Layers, batches: Iterable[Batch] | None = None) -> DataFrame | None:
    """The raw facts of all or some committed batches; None before the first one."""
    chosen = entries(spark, layers) if batches is None else list(batches)
    if not chosen:
        return None
    part = tables.grain_column(DATE, layers.grain)
    columns = RAW_FACTS if part == DATE else {**RAW_FACTS, part: "date"}
    found = [f"{layers.facts}/data/batch={_folder_name(b.batch)}" for b in chosen]
    found = [x for x in found if any("=" in name for name in versions.listed(spark, x))]
    if not found:  # batches without rows
        return spark.createDataFrame([], ddl(columns))
    rows = spark.read.schema(ddl(columns)).option("basePath", f"{layers.facts}/data").parquet(*found)
    return rows.select(*columns)


def index(spark: SparkSession, layers: Layers, batches: Iterable[Batch] | None = None) -> DataFrame:
    """(``INDEXED``, batch number, bucket) of all versions in committed batches, bucketed by ``sub_id``."""
    chosen = entries(spark, layers) if batches is None else list(batches)
    name = _declare(spark, layers)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name).filter(F.col("batch").isin([_folder_name(b.batch) for b in chosen]))


def versions_of(ids: DataFrame, found: DataFrame, buckets: int) -> DataFrame:
    """Rows of the index ``found`` whose record is in ``ids`` (sub_id), from their buckets only."""
    touched = [r[0] for r in ids.select(bucket_of(F.col("sub_id"), buckets).alias("b")).distinct().collect()]
    return found.filter(F.col("bucket").isin(touched)).join(ids.select("sub_id"), "sub_id", "left_semi")
