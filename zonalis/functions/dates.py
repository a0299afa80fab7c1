"""Date expressions. "Today" is always the argument ``as_of``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions.values import at_least_zero


def instant(as_of: str | dt.date) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def safe_timestamp(c: Column) -> Column:
    """Timestamp, or null for text that is none."""
    return c.try_cast("timestamp_ntz")


def construction_year(c: Column) -> Column:
    """The year in a year number, a year text or a date text."""
    text = c.cast("string")
    return F.coalesce(text.try_cast("int"), F.year(text.try_cast("date")))


def age_years(year: Column, as_of: str | dt.date) -> Column:
    return at_least_zero(F.year(instant(as_of)) - year).cast("int")


def days_on_market(listed: Column, sold: Column, cancelled: Column,
                   contract_end: Column, as_of: str | dt.date) -> Column:
    """Whole days from listing to the first known end: sold, cancelled, contract end, today."""
    end = F.coalesce(sold, cancelled, contract_end, instant(as_of))
    return at_least_zero(F.timestamp_diff("DAY", listed, end))


def in_years(c: Column, years: Iterable[int]) -> Column:
    """Year membership as date ranges, which parquet and JDBC readers can skip on."""
    spans: list[tuple[int, int]] = []
    for y in sorted(set(years)):
        if spans and spans[-1][1] == y:
            spans[-1] = (spans[-1][0], y + 1)
        else:
            spans.append((y, y + 1))
    hit = F.lit(False)
    for first, after in spans:
        hit = hit | ((c >= instant(f"{first:04d}-01-01")) & (c < instant(f"{after:04d}-01-01")))
    return hit


def in_last_months(c: Column, months: int, as_of: str | dt.date) -> Column:
    start = F.add_months(F.lit(str(as_of)).cast("date"), -months).cast("timestamp_ntz")
    return c >= start
