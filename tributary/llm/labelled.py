"""Held-out rule and the bounded sample that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5; null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(text, y) of at most ``max_rows`` labelled rows, those of smallest id hash.

    Held-out ids, null labels and ids with contradictory labels are left out. Labels are counted
    per id before the join, and the chosen ids are bounded, so only their texts move.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("__label_id")).agg(F.min(label).alias("y"), F.max(label).alias("__y"))
    chosen = (known.filter(F.col("y") == F.col("__y")).select("__label_id", F.col("y").cast("int").alias("y"))
              .orderBy(F.xxhash64("__label_id"), "__label_id").limit(max_rows))
    return (docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), F.col("__id") == F.col("__label_id"))
            .orderBy(F.xxhash64("__id"), "__id", "text").limit(max_rows).select("text", "y"))
