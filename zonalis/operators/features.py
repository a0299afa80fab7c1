"""Derived listing features and the projection onto the analytics table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis import config
from zonalis.functions import dates, prices
from zonalis.functions.values import with_bounded_ints

DEPARTMENT_SUBTYPES = tuple(
    s for s, kind in config.SUBTYPE_TO_TYPE.items() if kind == config.DEPARTMENT)
SALE, RENTAL = (d.label for d in config.DEALS)


def with_market_time(df: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Age of the building, days on the market, month and year of listing."""
    moments = {c: dates.safe_timestamp(F.col(c)) for c in
               ("date_of_listing", "sold_date", "cancellation_date", "contract_end_date")}
    df = df.withColumns({**moments,
                         "year_construction": dates.construction_year(F.col("year_construction"))})
    return df.withColumns({
        "antiguedad": dates.age_years(F.col("year_construction"), as_of),
        "tiempo_en_mercado": dates.days_on_market(
            *[F.col(c) for c in moments], as_of=as_of),
        "mes_publicacion": F.month("date_of_listing"),
        "anio_publicacion": F.year("date_of_listing"),
    })


def with_price_per_m2(df: DataFrame,
                      department_subtypes: Iterable[str] = DEPARTMENT_SUBTYPES) -> DataFrame:
    return df.withColumn("precio_m2", prices.price_per_m2(
        prices.is_department(F.col("subtipo_original"), department_subtypes),
        F.col("construction_area_m"), F.col("total_area"),
        F.col("precio_cierre"), F.col("precio_publicacion")))


def split_closing_price(df: DataFrame, other_is_rental: bool = True) -> DataFrame:
    """The closing price as sale price or as monthly rent.

    For the load every transaction that is not a sale counts as a rental; the
    training set takes only the named ones.
    """
    sale = F.col("tipo_transaccion") == SALE
    rental = ~F.coalesce(sale, F.lit(False)) if other_is_rental else F.col("tipo_transaccion") == RENTAL
    return df.withColumns({
        "precio_venta": F.when(sale, F.col("precio_cierre")),
        "precio_alquiler_mes": F.when(rental, F.col("precio_cierre")),
    })


def load_projection(df: DataFrame, columns: Sequence[str] = config.ANALYTICS_COLUMNS,
                    limits: Mapping[str, tuple[int, int]] = config.INTEGER_LIMITS) -> DataFrame:
    """The rows as they are loaded: prices, dates, limits, columns in order.

    A column the input lacks is null. Missing values are null already: the
    cleaning job sees to it at the source (``missing_to_null``).
    """
    df = split_closing_price(df).withColumn(
        "fecha_venta", F.to_date("sold_date"))
    if "numero_reducciones" not in df.columns:
        df = df.withColumn("numero_reducciones", F.lit(0))
    df = with_bounded_ints(df, limits)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in columns])


def training_rows(df: DataFrame) -> DataFrame:
    """Rows with the closing price of their own transaction type."""
    split = split_closing_price(df, other_is_rental=False).withColumnRenamed(
        "sold_date", "fecha_venta")
    return split.filter(F.coalesce("precio_venta", "precio_alquiler_mes").isNotNull())
