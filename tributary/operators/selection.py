"""Filters, bounded fetches and key sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T

from tributary.session import settle


def is_valid_record(record_id: Column, event_date: Column, amount: Column) -> Column:
    """Identifier and date present, amount not null; never null itself.

    Text fields are empty when '' and a numeric identifier is empty when 0 or null; the
    identifier is expected in its raw type.
    """
    present = F.coalesce(record_id.cast("string"), F.lit("")) != ""
    dated = F.coalesce(event_date.cast("string"), F.lit("")) != ""
    return present & dated & amount.isNotNull()


def valid_and_skipped(df: DataFrame, record_id: str, event_date: str, amount: str) -> DataFrame:
    """One row: records kept and records skipped."""
    ok = is_valid_record(F.col(record_id), F.col(event_date), F.col(amount))
    return df.agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_skipped"))



#: Rows that one task ranks, digits of a digest that one round looks at, and pivots of a round.
SMALL, DIGITS, PIVOTS = 50_000, 3, 255


def newest_rows(df: DataFrame, event_date: str, record_id: str, n: int | None,
                ties: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """The ``n`` newest rows by calendar day, or all rows for ``n`` None.

    Within the day that the cap falls into, rows go by the digest of their identifier, then by
    the tie columns. The edge is found by radix selection: rows are counted per day, then per
    leading digits of the digest, and on into the group that the cap falls into until that holds
    at most ``small`` rows. A group of one identifier is split by pivots among its tie values,
    and equal rows by their place in the stored group, so a record with very many versions never
    meets in one task. Each round counts narrow columns; newer days and smaller groups go whole.
    """
    if n is None:
        return df
    day = F.col(event_date).cast("date")
    place = F.coalesce(F.md5(F.col(record_id).cast("string")), F.lit(""))
    days = df.groupBy(day.alias("at")).agg(F.count("*").alias("n")).collect()
    days.sort(key=lambda r: (r["at"] is not None, r["at"] or dt.date.min), reverse=True)
    at, kept = _edge(days, n)
    if at is None:
        return df
    edge, size, one_id = at["at"], at["n"], False
    same_day = day.eqNullSafe(F.lit(edge).cast("date"))
    newer = day.isNotNull() if edge is None else F.coalesce(day > F.lit(edge), F.lit(False))
    prefix, length = "", 0
    while size > small and not one_id:
        length += DIGITS
        groups = df.filter(same_day & (F.substring(place, 1, length - DIGITS) == prefix)).groupBy(
            F.substring(place, 1, length).alias("at")).agg(
            F.count("*").alias("n"), (F.min(place) == F.max(place)).alias("one_id")).collect()
        at, before = _edge(sorted(groups, key=lambda r: r["at"]), n - kept)
        prefix, size, one_id, kept = at["at"], at["n"], at["one_id"], kept + before
    lead = F.substring(place, 1, length)
    whole = df.filter(newer | (same_day & (lead < prefix)))
    group = df.filter(same_day & (lead == prefix))
    if size > small:
        return whole.unionByName(_least(group, n - kept, size, ties, small))
    return whole.unionByName(group.orderBy(place, *ties).limit(n - kept))


def _edge(groups: Sequence[Row], n: int) -> tuple[Row | None, int]:
    """The group at which the running count reaches ``n``, and the rows before it.

    Groups are days, 4,096 leading digits or the rows between two pivots.
    """
    before = 0
    for group in groups:
        if before + group["n"] >= n:
            return group, before
        before += group["n"]
    return None, before


def _least(group: DataFrame, n: int, size: int, ties: Sequence[str], small: int) -> DataFrame:
    """``n`` least rows by the tie columns of a group of one identifier."""
    key = F.struct(*[F.col(c) for c in ties], F.xxhash64(*group.columns), "__row")
    rest = settle(group.withColumn("__row", F.monotonically_increasing_id())).withColumn("__key", key)
    taken: list[DataFrame] = []
    while size > small and n:
        pivots = rest.orderBy(F.xxhash64("__row", F.lit(size))).limit(PIVOTS).agg(
            F.array_sort(F.collect_list("__key")).alias("pivots"))
        below = F.size(F.filter("__pivots", lambda p: p < F.col("__key")))
        counted = settle(rest.withColumn("__pivots", settle(pivots).scalar()).withColumn("__below", below).drop("__pivots"))
        at, before = _edge(counted.groupBy("__below").agg(F.count("*").alias("n")).orderBy("__below").collect(), n)
        taken.append(counted.filter(F.col("__below") < at["__below"]))
        rest, n, size = counted.filter(F.col("__below") == at["__below"]).drop("__below"), n - before, at["n"]
    taken.append(rest.orderBy("__key").limit(n))
    rows = [part.select(*group.columns) for part in taken]
    return reduce(DataFrame.unionByName, rows)


def windowed_fetch(df: DataFrame, *, record_id: str, event_date: str, amount: str,
                   max_records: int | None = None, period: tuple[str, int] | None = None,
                   individuals_only: str | None = None, region: tuple[str, str] | None = None,
                   min_amount: float | None = None, min_date: dt.date | None = None,
                   max_date: dt.date | None = None) -> DataFrame:
    """Valid records inside the window; with ``max_records`` only that many of the newest.

    Records that fail the basic checks are dropped before a cap counts them. A capped fetch
    counts before it reads whole records, so records should be stored in columns by then.
    """
    if period:
        df = df.filter(F.col(period[0]) == period[1])
    if individuals_only:
        df = df.filter(F.col(individuals_only))
    if region:
        df = df.filter(F.col(region[0]) == region[1])
    if min_amount is not None:
        df = df.filter(F.col(amount) >= min_amount)
    if min_date is not None:
        df = df.filter(F.col(event_date) >= F.lit(min_date))
    if max_date is not None:
        df = df.filter(F.col(event_date) <= F.lit(max_date))
    valid = df.filter(is_valid_record(F.col(record_id), F.col(event_date), F.col(amount)))
    return newest_rows(valid, event_date, record_id, max_records, [amount])


def rows_for_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the key set."""
    return df.join(keys.select(key), key, "left_semi")


def rows_for_cycle(df: DataFrame, cycles: str, cycle: int) -> DataFrame:
    """Rows of one cycle; the cycle column may be a number or an array of numbers."""
    if isinstance(df.schema[cycles].dataType, T.ArrayType):
        return df.filter(F.array_contains(cycles, F.lit(cycle)))
    return df.filter(F.col(cycles) == cycle)


def distinct_nonempty(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def keys_missing_from(needed: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Set difference of two key sets."""
    return needed.select(key).distinct().join(existing.select(key), key, "left_anti")


def total_between(df: DataFrame, amount: Column, date_col: str, start: dt.date | None = None,
                  end: dt.date | None = None, alias: str = "total_amount") -> DataFrame:
    """Sum over the table or over an inclusive date range (prunes a table partitioned by it)."""
    if start is not None:
        df = df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))
    return df.agg(F.sum(amount).alias(alias))
