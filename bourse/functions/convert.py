"""Conversions from raw JSON values to typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bourse.fixed_values import DATE_FORMATS

_MS_PER_DAY = 86_400_000

# Contract type hint -> physical type. A field without a hint is a number.
SPARK_TYPES = {
    "timestamp_ms_to_datetime": "timestamp",
    "timestamp_ms_to_date": "date",
    "string_to_date": "date",
    "string": "string",
    "float": "double",
    "integer": "bigint",
    "int": "bigint",
    "bool": "boolean",
    None: "double",
}


def spark_type(hint: str | None) -> str:
    try:
        return SPARK_TYPES[hint]
    except KeyError:
        raise ValueError(f"unknown contract type {hint!r}") from None


def ms_to_timestamp(ms: Column) -> Column:
    """Epoch milliseconds to an instant; 0 and null give null."""
    return F.timestamp_millis(F.nullif(ms.cast("bigint"), F.lit(0).cast("bigint")))


def ms_to_date(ms: Column) -> Column:
    """Epoch milliseconds to the UTC day, whatever the session time zone."""
    value = F.nullif(ms.cast("bigint"), F.lit(0).cast("bigint"))
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(value / _MS_PER_DAY).cast("int"))


def text_to_date(text: Column) -> Column:
    """First accepted date form that parses; null when none does."""
    return F.coalesce(*[F.try_to_date(text, form) for form in DATE_FORMATS])


_CONVERTERS: dict[str | None, Callable[[Column], Column]] = {
    "timestamp_ms_to_datetime": ms_to_timestamp,
    "timestamp_ms_to_date": ms_to_date,
    "string_to_date": text_to_date,
}


def convert(value: Column, hint: str | None, is_array: bool = False) -> Column:
    """Apply a contract type, element by element when ``value`` is an array."""

    def one(v: Column) -> Column:
        converter = _CONVERTERS.get(hint)
        return converter(v) if converter else v.try_cast(spark_type(hint))

    return F.transform(value, one) if is_array else one(value)


def scaled_units(raw: Column, decimals: Column | int) -> Column:
    """An on-chain integer amount in whole tokens.

    256-bit amounts exceed any decimal type, so text is read as a double; a
    value that is no number gives null.
    """
    exponent = decimals if isinstance(decimals, Column) else F.lit(decimals)
    return raw.try_cast("double") / F.pow(F.lit(10.0), exponent.cast("double"))
