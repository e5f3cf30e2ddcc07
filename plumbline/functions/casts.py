"""Tolerant casts and small column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as surrounding white space, and the text forms of numbers.
SPACE = " \t\n\r\x0b\x0c"
INTEGER_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_NUMBER_TEXT = r"^[+-]?(?i:nan|inf|infinity)$"

MONEY = "decimal(18,4)"


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(SPACE))


def blank_to_null(column: Column) -> Column:
    """Trimmed text, with the empty text as NULL."""
    return F.nullif(strip(column), F.lit(""))


def is_blank(column: Column) -> Column:
    """NULL or the empty text."""
    return column.isNull() | (column.cast("string") == "")


def number_text(column: Column) -> Column:
    """Trimmed text if it spells a finite number, else NULL.

    The guard matters: a plain cast also takes Java forms such as ``1.5d``.
    """
    text = strip(column.cast("string"))
    return F.when(text.rlike(DECIMAL_TEXT), text)


def to_float(column: Column, default: float | None = 0.0) -> Column:
    value = number_text(column).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def to_money(column: Column, default: float | None = 0.0, scale: int = 2) -> Column:
    """Exact decimal rounded to ``scale``; unreadable text becomes ``default``.

    The decimal cast skips white space and takes just the forms of ``DECIMAL_TEXT``, so no
    pattern has to be matched per value.
    """
    value = F.round(column.try_cast(MONEY), scale).cast(MONEY)
    return value if default is None else F.coalesce(value, F.lit(default).cast(MONEY))


def to_int(column: Column, default: int | None = 0) -> Column:
    """Whole number by cutting off the fraction, so ``1e3`` is 1000 and ``6.9`` is 6."""
    value = column.try_cast("decimal(38,18)").try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def safe_cast_numeric(column: Column, to: str = MONEY) -> Column:
    """Digits, dots and minus signs of a text as a number; nothing left, or no number, is NULL."""
    kept = F.regexp_replace(column.cast("string"), r"[^0-9.\-]", "")
    return F.nullif(kept, F.lit("")).try_cast(to)


def to_timestamp(column: Column) -> Column:
    """Wall-clock timestamp of ISO text; a zone mark is read over, as in a zone-less SQL cast."""
    return column.try_cast("timestamp_ntz")


def to_date(column: Column) -> Column:
    return column.try_cast("date")


def to_bool(column: Column) -> Column:
    return column.try_cast("boolean")


def date_from_ts(column: Column) -> Column:
    """Date part of a timestamp text by its shape, ``unknown`` when there is none."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return (
        F.when(text.contains("T"), F.split_part(text, F.lit("T"), F.lit(1)))
        .when(text.contains(" "), F.split_part(text, F.lit(" "), F.lit(1)))
        .when(F.length(text) >= 10, F.substring(text, 1, 10))
        .otherwise("unknown")
    )


def surrogate_key(*columns: Column) -> Column:
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 unless the denominator is positive."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def count_when(condition: Column) -> Column:
    """Rows where ``condition`` holds; 0, not NULL, on empty input."""
    return F.count_if(condition)


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 over a row; lengths are part of the text, so NULL, '' and shifted values differ."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)
