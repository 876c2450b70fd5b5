"""Mart snapshots as JSON for a dashboard."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.functions.cleaning import zero_if_null
from tributary.functions.labels import NO_NAME
from tributary.schemas import EXPORT_DAILY, EXPORT_META, EXPORT_SUMMARY, ddl
from tributary.sources import versions

# Snapshot name -> (columns, sort order); fixed names.
SNAPSHOTS = {
    "daily_contributions": (EXPORT_DAILY, ["contribution_receipt_date", "committee_id"]),
    "committee_summary": (EXPORT_SUMMARY, ["-total_raised", "committee_id"]),
    "meta": (EXPORT_META, []),
}


def _plain(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Dates as ISO text and decimals as doubles."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])


def _ordered(df: DataFrame, order: list[str]) -> DataFrame:
    if not order:
        return df
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in order])


def export_daily(daily: DataFrame, summary: DataFrame) -> DataFrame:
    """Daily rows with names and parties taken fresh from the summary."""
    names = summary.select("committee_id", "committee_name", "party", "party_full")
    rows = daily.drop("committee_name", "party", "party_full").join(names, "committee_id", "left")
    named = rows.withColumn("committee_name", F.coalesce("committee_name", F.lit(NO_NAME)))
    return _ordered(_plain(named, EXPORT_DAILY), SNAPSHOTS["daily_contributions"][1])


def export_summary(summary: DataFrame) -> DataFrame:
    return _ordered(_plain(summary, EXPORT_SUMMARY), SNAPSHOTS["committee_summary"][1])


def export_meta(daily: DataFrame, summary: DataFrame, *, project: str, dataset: str,
                exported_at: dt.datetime | Column | None = None) -> DataFrame:
    """One row about both snapshots."""
    if exported_at is None:
        exported_at = F.current_timestamp()
    elif not isinstance(exported_at, Column):
        exported_at = F.lit(exported_at)
    days = daily.agg(F.struct(
        F.count("*").alias("n"),
        F.min("contribution_receipt_date").alias("first"),
        F.max("contribution_receipt_date").alias("last"),
    ).alias("d")).scalar()
    totals = summary.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("total_raised").cast("double"), F.lit(0.0)).alias("raised"),
        zero_if_null(F.sum("total_contributions")).alias("contributions"),
    )
    return totals.select("*", days.alias("d")).select(
        F.date_format(exported_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("exported_at"),
        F.lit(project).alias("project"),
        F.lit(dataset).alias("dataset"),
        F.col("d.n").alias("daily_contributions_rows"),
        F.col("n").alias("committee_summary_rows"),
        F.col("d.first").cast("string").alias("date_min"),
        F.col("d.last").cast("string").alias("date_max"),
        F.col("raised").alias("total_raised"),
        F.col("contributions").alias("total_contributions"),
    )


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_snapshots(root: str, daily: DataFrame, summary: DataFrame, meta: DataFrame) -> None:
    """One folder of JSON lines per snapshot."""
    for name, df in (("daily_contributions", daily), ("committee_summary", summary),
                     ("meta", meta)):
        _write(df, f"{root.rstrip('/')}/{name}")


def publish(spark: SparkSession, root: str, target: str) -> list[str]:
    """Publish the three snapshots as one on any Hadoop file system; fails if one is missing.

    Executors write them again, in their order, into the folders of a new version. One commit then
    makes all three current, so a reader who asks ``published`` never sees two versions mixed, and a
    run that breaks off leaves the last ones. Their folders are returned.
    """
    top = target.rstrip("/")
    for name in SNAPSHOTS:
        files, path = versions.files_of(spark, f"{root.rstrip('/')}/{name}")
        if not files.exists(path):
            raise FileNotFoundError(f"missing export: {path.toString()}")
    base, version = versions.head(spark, top), uuid.uuid4().hex
    for name, (columns, order) in SNAPSHOTS.items():
        rows = spark.read.schema(ddl(columns)).option("mode", "FAILFAST").json(f"{root.rstrip('/')}/{name}")
        _write(_ordered(rows, order), f"{top}/data/version={version}/snapshot={name}")
    versions.commit(spark, top, base, version, list(SNAPSHOTS), [], {})
    return list(published(spark, top).values())


def published(spark: SparkSession, target: str) -> dict[str, str]:
    """Folder of each snapshot in the version that is current now; empty before the first."""
    top = target.rstrip("/")
    state = versions.head(spark, top)
    return {name: f"{top}/data/version={state.parts[name]}/snapshot={name}" for name in SNAPSHOTS} if state else {}
