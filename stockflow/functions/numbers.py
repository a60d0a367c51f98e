"""Numbers out of text and out of integer cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY
from .text import strip


def money(c: Column) -> Column:
    """Text with optional leading dollar signs to money; null when it is not a number.

    Most amounts are plain numbers and never reach the second attempt.
    """
    return F.coalesce(c.try_cast(MONEY), strip(F.ltrim(strip(c), F.lit("$"))).try_cast(MONEY))


def integer(c: Column, kind: str = "int") -> Column:
    """Text such as `12` or `2011.0` to an integer; null when it is no whole number."""
    exact = strip(c).try_cast("decimal(38,18)")
    return F.coalesce(c.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def cents(c: Column) -> Column:
    """Integer cents to money."""
    return (c * F.lit(Decimal("0.01"))).try_cast(MONEY)


def to_cents(amount: Column) -> Column:
    """Money with two decimals as integer cents, exactly."""
    return (amount * F.lit(100)).cast("bigint")


def money_sum(cents_: Column) -> Column:
    """The sum of integer cents as money.

    Adding longs takes about half the time of adding decimals and is as exact. A total that no
    longer fits 64 bits stops the query, it does not wrap.
    """
    return (F.sum(cents_) * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole; null when the whole is zero."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def net_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    return F.round(quantity * (unit_price - discount), 2).cast("decimal(18,2)")
