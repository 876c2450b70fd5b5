"""Cleaning of loosely typed scalars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# JSON texts of the non-string values that count as "empty" (fixed values).
EMPTY_TOKENS = ("0", "-0", "0.0", "-0.0", "false", "[]", "{}")


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def null_if_blank(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def iso_date(text: Column, strict: bool = True) -> Column:
    """``yyyy-MM-dd`` text to a date; strict fails the query on bad text, else gives NULL."""
    return F.to_date(text, "yyyy-MM-dd") if strict else F.try_to_date(text, "yyyy-MM-dd")


def as_utc(value: Column, zone: str | None = None) -> Column:
    """Wall-clock time to a UTC instant: ``zone`` where known, else the time is UTC already."""
    return F.to_utc_timestamp(value, zone) if zone else value.cast("timestamp")


class JsonRecord:
    """Fields of JSON lines that were parsed once into a VARIANT column.

    ``parse`` adds the parsed record and the text of each field as columns; the other methods
    give expressions over those columns. The record comes out of a generator: filters are not
    pushed below one, while below a projection they would parse the line again for every use.
    """

    RECORD = "_record"

    @classmethod
    def parse(cls, lines: DataFrame, fields: Iterable[str]) -> DataFrame:
        record = F.struct(F.try_parse_json("value").alias(cls.RECORD))
        parsed = lines.select("value", F.inline(F.array(record)))
        return parsed.select("*", *[
            F.try_variant_get(F.col(cls.RECORD), f"$.{f}", "string").alias(f"_raw_{f}")
            for f in fields
        ])

    @classmethod
    def unreadable(cls) -> Column:
        return F.col(cls.RECORD).isNull()

    @classmethod
    def _value(cls, field: str) -> Column:
        return F.try_variant_get(F.col(cls.RECORD), f"$.{field}", "variant")

    @classmethod
    def _is_text(cls, field: str) -> Column:
        return F.schema_of_variant(cls._value(field)) == "STRING"

    @staticmethod
    def raw(field: str) -> Column:
        """Text of the value; NULL when it is absent or null."""
        return F.col(f"_raw_{field}")

    @classmethod
    def absent(cls, field: str) -> Column:
        """The field is not in the record at all; a null member is present."""
        return cls.raw(field).isNull() & cls._value(field).isNull()

    @classmethod
    def truth(cls, field: str) -> Column:
        """Absent, null, false, 0, '' and empty containers are false."""
        text = cls.raw(field)
        return (
            F.when(text.isNull() | (text == ""), False)
            .when(text.isin(*EMPTY_TOKENS), cls._is_text(field))
            .otherwise(True)
        )

    @classmethod
    def text(cls, field: str) -> Column:
        """Text of the value, '' when it counts as empty.

        The text alone cannot tell the number 0 from the text "0", so the kind of the value is
        looked at, but only when the text is one of EMPTY_TOKENS.
        """
        text = cls.raw(field)
        return (
            F.when(text.isNull(), "")
            .when(text.isin(*EMPTY_TOKENS), F.when(cls._is_text(field), text).otherwise(""))
            .otherwise(text)
        )

    @classmethod
    def number(cls, field: str) -> Column:
        """Number, or text that reads as one, else NULL. A d or f suffix is not a number."""
        return F.when(~cls.raw(field).rlike("[0-9.][dDfF]$"),
                      F.try_variant_get(F.col(cls.RECORD), f"$.{field}", "double"))

    @classmethod
    def whole_number(cls, field: str) -> Column:
        """Whole number, 0 when the value counts as empty, NULL when it is not a number."""
        text = cls.text(field)
        return F.when(text == "", F.lit(0).cast("bigint")).otherwise(
            F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")))
