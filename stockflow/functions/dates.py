"""Dates out of text and out of epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The date formats an export may mix.
ISO_FORMAT = "yyyy-M-d"
US_FORMAT = "M/d/yyyy"

_DAY_MS = 86_400_000


def mixed_date(c: Column) -> Column:
    """Text in either format to a date; null when neither fits.

    A plain ISO date takes the cast. The rest is parsed once, by the one format its separator
    allows, since a failed parse is far slower than a successful one.
    """
    text = strip(c)
    return (
        F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), c.try_cast("date"))
        .when(F.contains(text, F.lit("/")), F.try_to_date(text, US_FORMAT))
        .otherwise(F.try_to_date(text, ISO_FORMAT))
    )


def utc_date(epoch_ms: Column) -> Column:
    """UTC calendar day of an epoch in milliseconds, whatever the session time zone."""
    days = F.floor(epoch_ms / F.lit(_DAY_MS)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def epoch_ms(day: Column) -> Column:
    """Epoch in milliseconds of the UTC midnight that starts `day`."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * F.lit(_DAY_MS)


def month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
