"""Month buckets and elapsed time on timestamps without a zone."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaarlens.functions.numeric import exact_ratio

_MICROS_PER_SECOND = 1_000_000
_MICROS_PER_DAY = 86_400 * _MICROS_PER_SECOND


def month_of(moment: Column) -> Column:
    """First day of the month, as a date: a zoned type would move with the session zone."""
    return F.trunc(F.to_date(moment), "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with all six decimals; NULL if either is.

    Twelve whole digits hold any two timestamps, and the value fits eight bytes.
    """
    return (end - start).cast(DecimalType(18, 6))


def mean_days(start: Column, end: Column, digits: int) -> Column:
    """Aggregate mean of the fractional days between two timestamps, NULL spans left out.

    Whole seconds and what is left of them are summed apart, each in eight bytes, and put together
    once the sums are there: that holds nine times 10^18 seconds.
    """
    micros = (elapsed_seconds(start, end) * _MICROS_PER_SECOND).cast("bigint")
    seconds = F.call_function("div", micros, F.lit(_MICROS_PER_SECOND))
    total = F.sum(seconds).cast(DecimalType(20, 0)) * F.lit(Decimal(_MICROS_PER_SECOND)) + F.sum(
        micros % _MICROS_PER_SECOND
    ).cast(DecimalType(20, 0))
    return exact_ratio(total, F.count(micros).cast(DecimalType(20, 0)) * F.lit(Decimal(_MICROS_PER_DAY)), digits)
