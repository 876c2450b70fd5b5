"""Data-quality assertions. Each gives the failing rows; no rows means it holds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.calendar import hours_between
from tributary.operators.dedupe import duplicate_keys


def not_unique(df: DataFrame, column: str) -> DataFrame:
    return duplicate_keys(df, [column])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold nulls, with how many; one pass over the table for all of them."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows"))
                      for c in columns])
    return counts.select(F.inline(pairs)).filter("null_rows > 0")


def dated_after(df: DataFrame, record_id: str, event_date: str, today: Column) -> DataFrame:
    return df.filter(F.col(event_date) > today).select(record_id, event_date)


def below_volume(df: DataFrame, minimum: int = 100) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") < minimum)


def not_positive(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0).select(*keys, column)


def coverage(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: facts, facts without a dimension row, and their ratio (NULL when no facts).

    Facts are counted per key first, so the join sees one row per key and no hot key.
    """
    return coverage_of_counts(facts.groupBy(key).agg(F.count("*").alias("_n")), dimension, key, "_n")


def coverage_of_counts(per_key: DataFrame, dimension: DataFrame, key: str, n: str) -> DataFrame:
    """``coverage`` from one row per key, with its number of facts in the column ``n``."""
    known = dimension.select(key).distinct().withColumn("_known", F.lit(True))
    joined = per_key.join(known, key, "left")
    totals = joined.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_facts"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col(n))), F.lit(0))
        .alias("n_orphans"),
    )
    return totals.withColumn("orphan_ratio", F.try_divide("n_orphans", "n_facts"))


def coverage_breach(facts: DataFrame, dimension: DataFrame, key: str,
                    limit: float = 0.05) -> DataFrame:
    return over_limit(coverage(facts, dimension, key), limit)


def over_limit(covered: DataFrame, limit: float) -> DataFrame:
    return covered.filter((F.col("n_facts") > 0) & (F.col("orphan_ratio") > limit))


def orphan_keys(facts: DataFrame, dimension: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Keys missing from the dimension with the most facts."""
    per_key = facts.groupBy(key).agg(F.count("*").alias("n_orphans"))
    missing = per_key.join(dimension.select(key), key, "left_anti")
    return missing.orderBy(F.desc("n_orphans"), key).limit(n)


def freshness(df: DataFrame, loaded_at: str, now: dt.datetime | None = None,
              max_age_hours: int = 24) -> DataFrame:
    """One row: newest load, its age in whole hours, and whether that is too old.

    An empty table is stale. Exactly ``max_age_hours`` whole hours still pass.
    """
    kind = df.schema[loaded_at].dataType
    clock = (F.current_timestamp() if now is None else F.lit(now)).cast(kind)
    newest = df.agg(F.max(loaded_at).alias("last_loaded_at"))
    age = hours_between(F.col("last_loaded_at"), clock)
    return newest.withColumn("hours_since_load", age).withColumn(
        "is_stale", F.coalesce(F.col("hours_since_load") > max_age_hours, F.lit(True))
    )


def stale(df: DataFrame, loaded_at: str, now: dt.datetime | None = None,
          max_age_hours: int = 24) -> DataFrame:
    return freshness(df, loaded_at, now, max_age_hours).filter("is_stale")


def column_checks(df: DataFrame, table: str, *, not_null: Sequence[str] = (),
                  no_future: tuple[str, Column] | None = None, positive: Sequence[str] = (),
                  minimum_rows: int | None = None) -> DataFrame:
    """Row-wise assertions of one table in a single pass: (assertion, failing_rows)."""
    tests: list[tuple[str, Column]] = []
    for c in not_null:
        tests.append((f"not_null:{table}.{c}", F.count_if(F.col(c).isNull())))
    if no_future:
        tests.append((f"no_future:{table}.{no_future[0]}",
                      F.count_if(F.col(no_future[0]) > no_future[1])))
    for c in positive:
        tests.append((f"positive:{table}.{c}", F.count_if(F.col(c) <= 0)))
    if minimum_rows is not None:
        short = F.when(F.count("*") < minimum_rows, 1).otherwise(0).cast("bigint")
        tests.append((f"min_volume:{table}", short))
    counts = df.agg(*[test.alias(f"t{i}") for i, (_, test) in enumerate(tests)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("assertion"), F.col(f"t{i}").alias("failing_rows"))
        for i, (name, _) in enumerate(tests)
    ])
    return counts.select(F.inline(rows))


def failing_row_counts(assertions: Mapping[str, DataFrame]) -> DataFrame:
    """(assertion, failing_rows) for assertions that need a query of their own."""
    parts = [
        failing.agg(F.count("*").alias("failing_rows"))
        .select(F.lit(name).alias("assertion"), "failing_rows")
        for name, failing in assertions.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


class QualityError(RuntimeError):
    """Raised when at least one assertion has failing rows."""


def require_clean(results: DataFrame) -> None:
    """Fail on any assertion with failing rows (one small row per assertion is collected)."""
    broken = results.filter("failing_rows > 0").collect()
    if broken:
        raise QualityError("; ".join(f"{r['assertion']}: {r['failing_rows']}" for r in broken))
