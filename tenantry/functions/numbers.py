"""Rounding of doubles by their exact binary value, ties to even.

Spark's ``round`` works on the shortest decimal text of a double, so 2.675
becomes 2.68 although the double lies below 2.675.  Scores and durations here
follow the exact value instead, as C's printf does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 55  # fraction bits kept; exact for values of 1/8 and above


def _units(x: Column, digits: int) -> Column:
    """Number of 10**-digits units in a non-negative double, as BIGINT."""
    if digits not in (1, 2):
        raise ValueError("digits must be 1 or 2")
    scale = 10**digits
    whole = F.floor(x)
    fraction = ((x - whole.cast("double")) * F.lit(float(2**_BITS))).cast("bigint") * F.lit(scale)
    units = whole * F.lit(scale) + F.shiftright(fraction, _BITS)
    rest = fraction - F.shiftleft(F.shiftright(fraction, _BITS), _BITS)
    half = F.lit(2 ** (_BITS - 1))
    up = (rest > half) | ((rest == half) & (units % 2 == 1))
    return units + up.cast("bigint")


def round_exact(x: Column, digits: int) -> Column:
    """``x`` rounded to one or two decimals, as DOUBLE."""
    rounded = _units(F.abs(x), digits).cast("double") / F.lit(float(10**digits))
    return F.when(x < 0, -rounded).otherwise(rounded)


def one_decimal(x: Column) -> Column:
    """A non-negative double as text with one decimal."""
    tenths = _units(x, 1)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def duration_text(seconds: Column) -> Column:
    """Seconds below a minute, minutes below an hour, else hours."""
    return (
        F.when(seconds < 60, F.concat(one_decimal(seconds), F.lit(" seconds")))
        .when(seconds < 3600, F.concat(one_decimal(seconds / 60), F.lit(" minutes")))
        .otherwise(F.concat(one_decimal(seconds / 3600), F.lit(" hours")))
    )
