"""Text forms for reports. Ties round away from zero, as in the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DASH = "—"
ELLIPSIS = "…"


def grouped_int(value: Column) -> Column:
    return F.format_number(F.round(value, 0), 0)


def usd(value: Column, cents: bool = False) -> Column:
    digits = 2 if cents else 0
    body = F.format_number(F.round(F.abs(value), digits), digits)
    return F.concat(F.when(value < 0, "-$").otherwise("$"), body)


def compact_usd(value: Column) -> Column:
    """1.2M, 340k or whole units."""
    size = F.abs(value)
    text = (
        F.when(size >= 1_000_000,
               F.concat(F.round(size / 1_000_000, 1).cast("decimal(38,1)").cast("string"), F.lit("M")))
        .when(size >= 1000,
              F.concat(F.round(size / 1000, 0).cast("bigint").cast("string"), F.lit("k")))
        .otherwise(F.round(size, 0).cast("bigint").cast("string"))
    )
    return F.concat(F.when(value < 0, "-").otherwise(""), text)


def percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share.cast("double") * 100)


def calendar_day(text: Column) -> Column:
    """``Mon D, YYYY``; a dash for missing text, the text itself when it is not a date."""
    day = F.when(F.length(text) == 10, F.try_to_date(text, "yyyy-MM-dd")) \
        .when(text.rlike("^[0-9]{4}-"), F.to_date(F.try_to_timestamp(text)))
    return (
        F.when(text.isNull() | (text == ""), DASH)
        .otherwise(F.coalesce(F.date_format(day, "MMM d, yyyy"), text))
    )


def shortened(text: Column, limit: int = 42) -> Column:
    return F.when(F.length(text) > limit,
                  F.concat(F.substring(text, 1, limit - 1), F.lit(ELLIPSIS))).otherwise(text)


def date_prefix(iso_text: Column) -> Column:
    """Day part of an ISO timestamp text."""
    return F.substring(iso_text, 1, 10)
