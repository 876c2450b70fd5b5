"""Aggregations: per-key statistics, counts, summaries and top-n reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.cleaning import null_if_blank, zero_if_null


def average(amount: str, average_type: str) -> Column:
    """Mean of a decimal column: exact sum as a double over the count, or a decimal mean."""
    if average_type == "double":
        return F.sum(amount).cast("double") / F.count(amount)
    return F.avg(amount).cast(average_type)


def grouped_stats(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Named aggregates per key. Partial aggregation shrinks hot keys before the shuffle."""
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def ranked(df: DataFrame, by: Column, n: int, tie_break: Sequence[str]) -> DataFrame:
    """Top ``n`` rows by a descending measure; ties fall to the tie-break columns."""
    return df.orderBy(by.desc(), *tie_break).limit(n)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One (layer, row_count) row per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def summary_cells(df: DataFrame, entity_id: str, region: str, event_date: str,
                  amount: str) -> DataFrame:
    """Rows and amounts per (entity, region, date): what both summaries of a batch need.

    Three distinct counts over raw rows would copy every row four times; over these cells the
    copies are few.
    """
    return df.groupBy(entity_id, region, event_date).agg(
        F.count("*").alias("_n"), F.sum(amount).alias("_total"), F.count(amount).alias("_n_amount"))


def summary_of_cells(cells: DataFrame, entity_id: str, region: str, event_date: str) -> DataFrame:
    """One row about a batch; empty texts do not count as values."""
    totals = cells.agg(
        zero_if_null(F.sum("_n")).alias("n_records"),
        F.count_distinct(null_if_blank(F.col(entity_id))).alias("n_entities"),
        F.count_distinct(null_if_blank(F.col(region))).alias("n_regions"),
        F.min(event_date).alias("first_date"),
        F.max(event_date).alias("last_date"),
        F.count_distinct(event_date).alias("n_dates"),
        F.sum("_total").alias("total_amount"),
        F.sum("_n_amount").alias("_n_amount"),
    )
    mean = F.try_divide(F.col("total_amount").cast("double"), F.col("_n_amount"))
    return totals.withColumn("avg_amount", mean).drop("_n_amount")


def peak_of_cells(cells: DataFrame, event_date: str, warn_share: float = 0.5) -> DataFrame:
    """Most frequent date with its count, share and amount; ties go to the newest date."""
    per_date = cells.groupBy(event_date).agg(F.sum("_n").alias("n"), F.sum("_total").alias("amount"))
    peak = per_date.agg(
        F.max(F.struct("n", F.col(event_date).alias("date"), "amount")).alias("peak"),
        F.sum("n").alias("everything"),
    ).filter(F.col("everything") > 0)
    share = F.col("peak.n") / F.col("everything")
    return peak.select(
        F.col("peak.date").alias("peak_date"), F.col("peak.n").alias("peak_count"),
        share.alias("peak_share"), F.col("peak.amount").alias("peak_amount"),
        (share >= warn_share).alias("is_concentrated"),
    )


def load_summary(df: DataFrame, *, entity_id: str, region: str, event_date: str,
                 amount: str) -> DataFrame:
    return summary_of_cells(summary_cells(df, entity_id, region, event_date, amount), entity_id,
                            region, event_date)


def date_concentration(df: DataFrame, event_date: str, amount: str,
                       warn_share: float = 0.5) -> DataFrame:
    cells = df.groupBy(event_date).agg(F.count("*").alias("_n"), F.sum(amount).alias("_total"))
    return peak_of_cells(cells, event_date, warn_share)


def category_counts(df: DataFrame, category: str, n: int = 5, missing: str = "Unknown") -> DataFrame:
    """Most frequent categories; null and '' count under ``missing``."""
    label = F.coalesce(null_if_blank(F.col(category)), F.lit(missing))
    counts = df.groupBy(label.alias(category)).agg(F.count("*").alias("n_rows"))
    return ranked(counts, F.col("n_rows"), n, [category])


def category_totals(df: DataFrame, label: Column, amount: str, alias: str) -> DataFrame:
    """Amount (null as 0) and row count per label, largest amount first."""
    totals = df.groupBy(label.alias(alias)).agg(
        F.sum(zero_if_null(F.col(amount))).alias("total_raised"), F.count("*").alias("committees")
    )
    return totals.orderBy(F.desc("total_raised"), alias)
