"""Number parsing and arithmetic that give NULL, never an error, under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civica.fixed_values import CORRELATION_STEPS


def to_double(value: Column) -> Column:
    """Value as double; text that is no number gives NULL."""
    return value.try_cast("double")


def parse_decimal_comma(text: Column) -> Column:
    """``'1234,5'`` as 1234.5; a thousands dot makes the text unreadable, hence NULL."""
    return to_double(F.replace(text, F.lit(","), F.lit(".")))


def decimal_comma_text(value: Column, digits: int = 4) -> Column:
    """Number as text with a decimal comma and a fixed number of digits."""
    fixed = F.round(value, digits).cast(f"decimal(30,{digits})").cast("string")
    return F.replace(fixed, F.lit("."), F.lit(","))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, NULL where the divisor is zero."""
    return F.try_divide(top, bottom)


def percentage(share: Column) -> Column:
    return share * F.lit(100)


def step_class(value: Column, scale: tuple[float, float, int] = CORRELATION_STEPS) -> Column:
    """Number 1..steps of the equal-width step holding ``value``; both ends included."""
    low, high, steps = scale
    bucket = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(steps))
    return F.when(value.isNotNull(), F.greatest(F.least(bucket, F.lit(steps)), F.lit(1)))


def map_values(key: Column, values: dict[str, str]) -> Column:
    """Replace ``key`` by its entry in ``values``; keys without an entry give NULL."""
    pairs = [F.lit(item) for entry in values.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), key)
