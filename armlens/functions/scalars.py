"""Small column helpers shared by all layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_second(text: Column) -> Column:
    """ISO-8601 text to a UTC timestamp with the fraction dropped; NULL when it cannot be read."""
    return F.date_trunc("SECOND", F.try_to_timestamp(text))


def ratio(numerator: Column, denominator: Column, places: int = 4) -> Column:
    """Rounded quotient in double arithmetic; NULL when the denominator is zero or NULL."""
    return F.round(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), places
    )


def fixed(value: Column, places: int) -> Column:
    """Decimal text with a fixed number of places."""
    return F.format_number(value, places)


def percent_text(value: Column) -> Column:
    return F.concat(fixed(value * 100, 1), F.lit("%"))


def literal_map(mapping: dict[str, object]) -> Column:
    """A constant map column from a Python dict."""
    parts: list[Column] = []
    for key, value in mapping.items():
        parts.append(F.lit(key))
        parts.append(
            F.array(*[F.lit(v) for v in value]).cast("array<string>")
            if isinstance(value, (tuple, list)) else F.lit(value)
        )
    return F.create_map(*parts)
