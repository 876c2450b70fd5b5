"""Counts and extremes of stored tables from Parquet footers, without reading rows.

Spark pushes COUNT, MIN and MAX of numbers and dates into Parquet's statistics when a table is read
through the second version of its source interface. That takes two session settings, so these frames
belong to a session of their own with the same catalog and time zone. Types without usable statistics
(texts, timestamps) are scanned by the same frames; files that lack statistics make the pushed form fail,
and ``extremes_now`` then scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

#: How Spark names the failure of a file without statistics (fixed value).
NO_STATISTICS = "aggregatePushdown"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that answers plain aggregates from footers."""
    own = spark.newSession()
    kept = [x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def extremes(own: SparkSession, paths: Sequence[str], column: str) -> DataFrame:
    """One row: rows of the table, least and greatest value of a column."""
    return own.read.parquet(*paths).agg(
        F.count("*").alias("n_rows"), F.min(column).alias("least"), F.max(column).alias("greatest"))


def table_extremes(spark: SparkSession, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(layer, n_rows, least, greatest) of some tables, each named with its path and a whole-number column."""
    own, out = footer_session(spark), None
    for layer, (path, column) in columns.items():
        one = extremes(own, [path], column).select(
            F.lit(layer).alias("layer"), "n_rows", *[F.col(c).cast("long").alias(c) for c in ("least", "greatest")])
        out = one if out is None else out.unionByName(one)
    return out


def extremes_now(spark: SparkSession, paths: Sequence[str], column: str) -> Row:
    """``extremes`` as values: from footers, or from a scan where files lack statistics."""
    try:
        return extremes(footer_session(spark), paths, column).first()
    except (PySparkException, Py4JJavaError) as error:
        if NO_STATISTICS not in str(error):
            raise
    return extremes(spark, paths, column).first()


def newest_up_to(spark: SparkSession, paths: Sequence[str], event_date: str, today: dt.date) -> dt.date | None:
    """The greatest date not after ``today``; rows are read only if there are later ones."""
    greatest = extremes_now(spark, paths, event_date)["greatest"]
    if greatest is None or greatest <= today:
        return greatest
    rows = spark.read.parquet(*paths).filter(F.col(event_date) <= F.lit(today))
    return rows.agg(F.max(event_date)).first()[0]
