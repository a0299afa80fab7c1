"""Price expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions.values import null_if_zero


def is_department(subtype: Column, department_subtypes: Iterable[str]) -> Column:
    names = sorted({s.lower() for s in department_subtypes})
    return F.coalesce(F.lower(subtype).isin(names), F.lit(False))


def price_per_m2(department: Column, built: Column, total: Column,
                 closing: Column, listing: Column) -> Column:
    """Price over built area (departments) or total area (others).

    The closing price counts unless it is null or 0, then the listing price.
    Null when the area or the price is not positive.
    """
    area = F.when(department, built).otherwise(total)
    price = F.coalesce(null_if_zero(closing), listing)
    return F.when((area > 0) & (price > 0), price / area)


def relative_difference(value: Column, mean: Column) -> Column:
    """``(value - mean) / mean``; 0 without a positive mean."""
    return F.when(mean > 0, (value - mean) / mean).otherwise(F.lit(0.0))


def effective_price(sale: Column, rent: Column) -> Column:
    """Sale price, or the rent where there is no sale price; null when both are null or 0."""
    return F.coalesce(null_if_zero(sale), null_if_zero(rent))


def price_band(price: Column, share: float) -> tuple[Column, Column]:
    """Lower and upper end of the band around a price, to 2 decimals."""
    return F.round(price * (1 - share), 2), F.round(price * (1 + share), 2)
