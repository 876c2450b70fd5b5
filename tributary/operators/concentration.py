"""How much of a total the largest entities hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.functions.cleaning import zero_if_null
from tributary.functions.labels import name_or_id
from tributary.session import settle

# Sizes of the leading groups, and the texts of the report (fixed values).
STEPS = (1, 5, 12)
BAND_TOP1 = ("top1", "#1")
BAND_TOP5 = ("top5", "#2–5", "Next four by raised")
BAND_TOP12 = ("top12", "#6–12", "Rest of top 12")
BAND_REST = ("rest", "Rest (%d)", "All other committees")
NO_LEADER = "Largest committee"
LADDER = ("#1 committee", "Top 5", "Top 12", "All %d")


def _overview(df: DataFrame, amount: str, entity_id: str, name: str) -> DataFrame:
    """One row: totals of the whole table and of its top 1, 5 and 12 rows.

    Only the twelve largest rows are ever ranked; the rest enters through the total. Rows
    are ordered by the raw amount and counted with negative amounts as zero.
    """
    raw = zero_if_null(F.col(amount))
    zero = F.lit(0).cast(df.schema[amount].dataType)
    counted = F.greatest(raw, zero)
    leaders = (
        df.select(raw.alias("_raw"), counted.alias("_amount"), F.col(entity_id).alias("_id"),
                  name_or_id(F.col(name), F.col(entity_id)).alias("_name"))
        .orderBy(F.desc("_raw"), "_id").limit(STEPS[-1])
        .withColumn("_place", F.row_number().over(Window.orderBy(F.desc("_raw"), "_id")))
    )
    tops = leaders.agg(F.struct(
        *[F.sum(F.when(F.col("_place") <= k, F.col("_amount"))).alias(f"top{k}") for k in STEPS],
        F.max(F.when(F.col("_place") == 1, F.col("_name"))).alias("leader"),
    ).alias("tops"))
    whole = df.agg(F.sum(counted).alias("total"), F.count("*").alias("n"))
    return whole.select(
        "n", F.coalesce("total", zero).alias("total"), tops.scalar().alias("t")
    ).select("n", "total", F.col("t.leader").alias("leader"),
             *[F.coalesce(F.col(f"t.top{k}"), zero).alias(f"top{k}") for k in STEPS])


def _share(amount: Column) -> Column:
    ratio = amount.cast("double") / F.col("total").cast("double")
    return F.when(F.col("total") > 0, ratio).otherwise(0.0)


def concentration_summary(df: DataFrame, amount: str, entity_id: str, name: str) -> DataFrame:
    return _overview(df, amount, entity_id, name).select(
        "total", F.col("n").alias("committees"), _share(F.col("top12")).alias("top12_share")
    )


def concentration_bands(df: DataFrame, amount: str, entity_id: str, name: str,
                        hide_empty: bool = False) -> DataFrame:
    """Exclusive bands #1, #2-5, #6-12 and the rest. Zero bands go, except the rest.

    ``hide_empty`` gives no rows at all when there is nothing to share out.
    """
    one = _overview(df, amount, entity_id, name)
    kind = one.schema["total"].dataType

    def band(position: int, key: str, label, detail, value: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(key).alias("band"),
            F.lit(label).alias("label"), F.lit(detail).alias("detail"),
            value.cast(kind).alias("amount"), _share(value).alias("share"),
        )

    leader = F.coalesce("leader", F.lit(NO_LEADER))
    others = F.greatest(F.lit(0).cast("bigint"), F.col("n") - STEPS[-1])
    rest_key, rest_label, rest_detail = BAND_REST
    bands = F.array(
        band(1, *BAND_TOP1, leader, F.col("top1")),
        band(2, *BAND_TOP5, F.col("top5") - F.col("top1")),
        band(3, *BAND_TOP12, F.col("top12") - F.col("top5")),
        band(4, rest_key, F.format_string(rest_label, others), rest_detail,
             F.col("total") - F.col("top12")),
    )
    if hide_empty:
        one = one.filter("n > 0 AND total > 0")
    return one.select(F.inline(bands)).filter("amount > 0 OR band = 'rest'")


def concentration_ladder(df: DataFrame, amount: str, entity_id: str, name: str,
                         hide_empty: bool = False) -> DataFrame:
    """Cumulative top 1, 5, 12 and all; the share of "all" is always 1."""
    one = _overview(df, amount, entity_id, name)
    kind = one.schema["total"].dataType

    def step(position: int, label, value: Column, share: Column) -> Column:
        return F.struct(F.lit(position).alias("position"), F.lit(label).alias("label"),
                        value.cast(kind).alias("amount"), share.alias("share"))

    everything = F.format_string(LADDER[-1], F.col("n"))
    steps = F.array(
        *[step(i + 1, LADDER[i], F.col(f"top{k}"), _share(F.col(f"top{k}")))
          for i, k in enumerate(STEPS)],
        step(4, everything, F.col("total"), F.lit(1.0)),
    )
    if hide_empty:
        one = one.filter("n > 0 AND total > 0")
    return one.select(F.inline(steps))


def ranked_shares(df: DataFrame, amount: str, entity_id: str) -> DataFrame:
    """(entity, amount, place, running, running_share) of every row, largest amounts first.

    Rows are range partitioned and written once. Each range's count and sum, one row per range, give
    the ranges after it their start; within a range a window numbers and adds. No task holds more
    than a range, and rows of equal amounts are parted by the identifier.
    """
    raw = zero_if_null(F.col(amount))
    counted = F.greatest(raw, F.lit(0).cast(df.schema[amount].dataType))
    order = [F.desc("_raw"), F.asc_nulls_first(entity_id)]
    rows = settle(df.select(entity_id, raw.alias("_raw"), counted.alias("_amount"))
                  .repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = sorted(rows.groupBy("_range").agg(F.count("*"), F.sum("_amount")).collect())  # one row per range
    kind = rows.agg(F.sum("_amount").alias("total")).schema["total"].dataType
    starts, place, total = [], 0, 0
    for at, n, own in sums:
        starts.append((at, place, total))
        place, total = place + n, total + own
    before = df.sparkSession.createDataFrame(
        [(at, n, str(own)) for at, n, own in starts], "_range int, _n long, _sum string").withColumn(
        "_sum", F.col("_sum").cast(kind))
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = F.lit(str(total)).cast(kind)
    running = (F.col("_sum") + F.sum("_amount").over(upto)).cast(kind)
    ranked = rows.join(before, "_range").select(
        entity_id, F.col("_raw").alias(amount), (F.col("_n") + F.count("*").over(upto)).alias("place"),
        running.alias("running"))
    share = F.when(whole > 0, F.col("running").cast("double") / whole.cast("double")).otherwise(0.0)
    return ranked.withColumn("running_share", share)
