"""NDJSON landing files: scan, append, sample."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.schemas import ddl


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per non-blank line, column ``value``; for records that still need normalising."""
    return spark.read.text(path).filter(F.trim("value") != "")


def scan_ndjson(spark: SparkSession, path: str | list[str], schema: dict[str, str]) -> DataFrame:
    """Already normalised NDJSON with a declared schema; blank lines are skipped.

    Scalars are read as text and then cast, so quoted numbers load like bare ones. A malformed
    line or a value that does not fit its type fails the query, as a load job would.
    """
    text = ddl({name: "string" for name in schema})
    rows = spark.read.schema(text).option("mode", "FAILFAST").json(path)
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema.items()])


def run_stamp(run_at: dt.datetime) -> str:
    """UTC second of a run, used as its folder name."""
    return run_at.astimezone(dt.UTC).strftime("%Y%m%dT%H%M%S")


def land(df: DataFrame, root: str, run_at: dt.datetime) -> str:
    """Append one run to the landing area as its own folder; a run is never overwritten."""
    path = f"{root.rstrip('/')}/{run_stamp(run_at)}"
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def write_sample(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
