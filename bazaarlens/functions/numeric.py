"""Decimal arithmetic that rounds half away from zero at the last step only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY_TOTAL = DecimalType(30, 2)

_WHOLE = DecimalType(38, 0)


def exact_ratio(num: Column, den: Column, digits: int, num_scale: int = 0, den_scale: int = 0) -> Column:
    """``num / den`` as a decimal rounded half away from zero to ``digits``; NULL where ``den`` is 0 or NULL.

    ``num_scale`` and ``den_scale`` are the decimal places the two sides carry. Both become whole numbers
    of up to 38 digits, and one division without rest decides the last digit, so nothing is rounded
    twice. Only the result must fit eight bytes; what does not raises under ANSI mode.
    """
    places = digits + den_scale - num_scale
    top = _shifted(num, num_scale) * F.lit(Decimal(10 ** max(places, 0)))
    bottom = F.nullif(_shifted(den, den_scale), F.lit(Decimal(0)).cast(_WHOLE)) * F.lit(Decimal(10 ** max(-places, 0)))
    halves = F.abs(top) * F.lit(Decimal(2)) + F.abs(bottom)
    nearest = F.call_function("div", halves, F.abs(bottom) * F.lit(Decimal(2)))
    signed = nearest * (F.signum(top) * F.signum(bottom)).cast("bigint")
    return _with_point(signed, digits)


def _shifted(value: Column, scale: int) -> Column:
    """A value with ``scale`` decimal places as a whole number of its smallest units."""
    return (value * F.lit(Decimal(10**scale))).cast(_WHOLE) if scale else value.cast(_WHOLE)


def _with_point(whole: Column, digits: int) -> Column:
    return (whole.cast(DecimalType(20, 0)) * F.lit(Decimal(1).scaleb(-digits))).cast(DecimalType(20 + digits, digits))


def exact_mean(column: Column, digits: int, scale: int = 0) -> Column:
    """Aggregate mean of the non-NULL values.

    ``avg`` would not do: it gives six digits for money and a double for small integers.
    """
    return exact_ratio(F.sum(column), F.count(column), digits, num_scale=scale)


def percent(part: Column, whole: Column, digits: int, scale: int = 0) -> Column:
    """``part`` in percent of ``whole``, both with ``scale`` decimal places."""
    return exact_ratio(part * 100, whole, digits, num_scale=scale, den_scale=scale)


def cents(amount: Column) -> Column:
    """An amount with two decimals in whole cents.

    Sums are taken in cents: they are exact, need eight bytes in every buffer and shuffle, and no
    decimal arithmetic per row. They hold up to 9e16 units of money; past that ANSI mode raises.
    """
    return (amount * 100).cast("bigint")


def from_cents(whole: Column) -> Column:
    return (whole.cast(DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(MONEY_TOTAL)


def money_sum(amount: Column) -> Column:
    """Aggregate sum of amounts with two decimals."""
    return from_cents(F.sum(cents(amount)))


def money_mean(amount: Column) -> Column:
    """Aggregate mean, to the cent, of the non-NULL amounts."""
    return exact_ratio(money_sum(amount), F.count(amount), 2, num_scale=2)
