"""Scalar expressions used by more than one operator."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspan.schemas import MAX_PRICE, MIN_PRICE, UNIT_PRICES


def unit_price(type_col: Column) -> Column:
    """List price of a type, NULL for an unknown one."""
    entries = chain.from_iterable((F.lit(k), F.lit(v).cast("long")) for k, v in UNIT_PRICES.items())
    return F.try_element_at(F.create_map(*entries), type_col)


def active_value(renewable: Column, price: Column) -> Column:
    """Price if the licence is active, else 0; NULL if an active price is NULL."""
    return F.when(renewable, price).otherwise(F.lit(0).cast("long"))


def is_accepted_type(type_col: Column) -> Column:
    return F.coalesce(type_col.isin(list(UNIT_PRICES)), F.lit(False))


def is_accepted_price(price: Column) -> Column:
    return F.coalesce(price.between(MIN_PRICE, MAX_PRICE), F.lit(False))


def utc_timestamp(text: Column) -> Column:
    """ISO text without an offset, read as UTC whatever the session's zone.

    Only a full date, alone or with a time, is read.  All else gives NULL: text that names
    a zone or an offset in any form instead of losing it, and a time without a date instead
    of taking the date from the clock.
    """
    whole = text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$")
    size = F.length(text)
    rest = F.when(size == 10, F.lit("T00:00:00Z")).when(size == 16, F.lit(":00Z")).otherwise(F.lit("Z"))
    zoned = F.concat(text, rest)
    return F.when(whole, zoned.try_cast("timestamp"))


def is_weekday(day: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(day) < 5


def is_first_quarter(day: Column) -> Column:
    return F.quarter(day) == 1


def share(part: Column, whole: Column) -> Column:
    """part / whole with six digits, 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))
