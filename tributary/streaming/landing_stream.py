"""Landed NDJSON as a file stream that feeds the raw table and the daily mart."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.options import Options, Thresholds
from tributary.plans.normalise import accepted, classify_facts, quarantined, record_counts
from tributary.plans.run import build_and_check, refresh_daily
from tributary.plans.stored import append_facts
from tributary.schemas import RAW_FACTS
from tributary.session import stored
from tributary.sources.layers import Layers


def landed_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New landing files as they appear; a bounded number of files per micro-batch."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", "true").text(path)
            .filter(F.trim("value") != ""))


def start_refresh(spark: SparkSession, layers: Layers, landing: str, checkpoint: str,
                  options: Options = Options(), max_files: int = 1000,
                  quarantine_path: str | None = None, thresholds: Thresholds | None = None,
                  on_batch: Callable[[dict[str, int]], None] | None = None) -> StreamingQuery:
    """Load everything landed so far, then stop.

    Each micro-batch is parsed once into a stored table, counted (``on_batch`` gets the counts),
    its unreadable records go to ``quarantine_path``, the others to the raw table and the daily
    mart. With ``thresholds`` the summary is rebuilt and every assertion checked as well. A
    micro-batch that runs again after a failure is a batch of the same id, which the ledger of the
    raw table admits once.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()

    def apply(batch: DataFrame, batch_id: int) -> None:
        with stored(classify_facts(batch, F.current_timestamp()), "records") as rows:
            if on_batch:
                on_batch(record_counts(rows))
            if quarantine_path:
                quarantined(rows).write.mode("append").json(quarantine_path)
            append_facts(accepted(rows).select(*RAW_FACTS), layers, f"stream {stream} {batch_id}")
        if thresholds is None:
            refresh_daily(spark, layers, options)
        else:
            build_and_check(spark, layers, options, thresholds)

    return (landed_lines(spark, landing, max_files).writeStream
            .foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
