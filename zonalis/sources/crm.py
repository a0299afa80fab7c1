"""Reads from the listings database: its twelve tables and the joins over them.

Every function works on all cities and all transaction types at once. The
tables keyed by listing are joined on the listing id, so they shuffle once on
the same key; lookup tables are plain scans whose size Spark knows, so it
broadcasts them by itself while they are small.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis import config
from zonalis.config import City, Deal
from zonalis.functions.dates import in_last_months, in_years
from zonalis.functions.values import ratio
from zonalis.operators.lookups import lookup_join
from zonalis.sources.session import constant_frame

TABLES = ("listings", "listing_transaction_types", "status_listings", "listings_information",
          "subtype_properties", "state_properties", "properties_category", "listing_prices",
          "locations", "cities", "areas", "transactions")

Tables = Mapping[str, DataFrame]


def read_tables(read: Callable[[str], DataFrame], names: Sequence[str] = TABLES) -> Tables:
    """All tables through one reader, e.g. ``lambda n: spark.read.parquet(f"{root}/{n}")``."""
    return {n: read(n) for n in names}


def jdbc_reader(spark: SparkSession, url: str, properties: Mapping[str, str],
                split_by: Mapping[str, tuple[str, int, int]],
                partitions: int) -> Callable[[str], DataFrame]:
    """A reader over JDBC. ``split_by`` names a numeric column and its range for big tables,
    which are then read in ``partitions`` parallel parts."""

    def read(table: str) -> DataFrame:
        if table not in split_by:
            return spark.read.jdbc(url, table, properties=dict(properties))
        column, low, high = split_by[table]
        return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high,
                               numPartitions=partitions, properties=dict(properties))

    return read


def city_frame(spark: SparkSession, cities: Iterable[City]) -> DataFrame:
    rows = [(c.name, c.tier, c.n_clusters, *c.lat, *c.lng) for c in cities]
    return constant_frame(spark, rows, """ciudad string, tier int, n_clusters int,
        lat_min double, lat_max double, lng_min double, lng_max double""")


def deal_frame(spark: SparkSession, deals: Iterable[Deal]) -> DataFrame:
    rows = [(d.type_id, d.closed_status_id, d.label, d.closed_status) for d in deals]
    return constant_frame(spark, rows, """deal_id int, closed_id int, tipo_transaccion string,
        closed_status string""")


def within_city_bbox(df: DataFrame, boxes: DataFrame, at_most: int | None = None,
                     lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """Rows inside the bounding box of their own city (inclusive).

    ``at_most`` is a known bound on the rows of ``boxes``; without one they are counted.
    """
    inside = (F.col(lat).between(F.col("lat_min"), F.col("lat_max"))
              & F.col(lng).between(F.col("lng_min"), F.col("lng_max")))
    box = boxes.select("ciudad", "lat_min", "lat_max", "lng_min", "lng_max")
    return lookup_join(df, box, "ciudad", "inner", at_most=at_most).filter(inside).select(*df.columns)


def _located(t: Tables) -> DataFrame:
    """Listing id, city name and coordinates."""
    named = t["cities"].select(F.col("id").alias("city_id"), F.col("name").alias("ciudad"))
    return (t["locations"].join(named, "city_id")
            .select("listing_id", "ciudad", "latitude", "longitude"))


def _named(t: Tables, table: str, key: str, name: str, alias: str) -> DataFrame:
    return t[table].select(F.col("id").alias(key), F.col(name).alias(alias))


def _closed_transactions(t: Tables, deals: Iterable[Deal],
                         statuses: Sequence[int]) -> DataFrame:
    rows = t["transactions"]
    return rows.filter(F.col("transaction_type_id").isin([d.type_id for d in deals])
                       & F.col("transaction_status_id").isin(list(statuses)))


def _any_deal(deals: Iterable[Deal]) -> Column:
    hit = F.lit(False)
    for d in deals:
        hit = hit | ((F.col("transaction_type_id") == d.type_id)
                     & (F.col("status_listing_id") == d.closed_status_id))
    return hit


def extract_listings(t: Tables, cities: Iterable[City] = config.CITIES,
                     deals: Iterable[Deal] = config.DEALS,
                     years: Iterable[int] = config.SALE_YEARS,
                     statuses: Sequence[int] = config.CLOSED_TRANSACTION_STATUS_IDS,
                     newest_first: bool = False) -> DataFrame:
    """Closed listings of all cities and transaction types with all their attributes.

    One query in place of one per city and transaction type. Rows need a
    transaction, a place inside the box of their city and a known transaction
    type; all other attributes may be missing. A listing with several matching
    transactions yields several rows.
    """
    cities, deals = tuple(cities), tuple(deals)
    spark = t["listings"].sparkSession
    deal = F.broadcast(deal_frame(spark, deals).select(
        F.col("deal_id").alias("transaction_type_id"), "tipo_transaccion"))
    sold = (_closed_transactions(t, deals, statuses).filter(in_years(F.col("sold_date"), years))
            .select("listing_id", F.col("transaction_type_id").alias("sold_type_id"), "sold_date",
                    F.col("current_listing_price").alias("precio_cierre")))
    # Written as a difference, the second condition is no join key: all big tables
    # are then partitioned by listing alone, and none is shuffled twice.
    same_type = (F.col("transaction_type_id") - F.col("sold_type_id")) == 0
    placed = within_city_bbox(_located(t), city_frame(spark, cities), len(cities))

    info = t["listings_information"]
    rows = (
        t["listings"].filter(_any_deal(deals)).withColumnRenamed("id", "listing_id")
        .join(sold, "listing_id").filter(same_type)
        .join(placed, "listing_id")
        .join(info, "listing_id", "left")
        .join(t["listing_prices"].select("listing_id", F.col("amount").alias("precio_publicacion")),
              "listing_id", "left")
        .join(deal, "transaction_type_id")
        .join(_named(t, "listing_transaction_types", "transaction_type_id", "name",
                     "transaction_type"), "transaction_type_id")
        .join(_named(t, "status_listings", "status_listing_id", "name", "status"),
              "status_listing_id", "left")
        .join(_named(t, "areas", "area_id", "name", "segmento"), "area_id", "left")
        .join(_named(t, "subtype_properties", "subtype_property_id", "name", "subtipo_original"),
              "subtype_property_id", "left")
        .join(_named(t, "state_properties", "state_property_id", "name_state_properties",
                     "estado_propiedad"), "state_property_id", "left")
        .join(_named(t, "properties_category", "property_category_id",
                     "name_properties_categories", "categoria_propiedad"),
              "property_category_id", "left")
    )
    result = rows.select(
        F.col("listing_id").cast("string").alias("id_propiedad"),
        F.col("MLSID").alias("mlsid"),
        "date_of_listing", "cancellation_date", "contract_end_date",
        "segmento", "transaction_type", "status", "subtipo_original",
        "categoria_propiedad", "estado_propiedad", "ciudad",
        "construction_area_m", "total_area", "land_m2",
        F.col("number_bedrooms").alias("dormitorios"),
        F.col("number_bathrooms").alias("banos"),
        F.col("parking_slots").alias("estacionamientos"),
        "year_construction", "precio_publicacion", "latitude", "longitude",
        "sold_date", "precio_cierre", "tipo_transaccion",
        *(["listing_id"] if newest_first else []))
    return result.orderBy(F.desc("listing_id")).drop("listing_id") if newest_first else result


def status_points(t: Tables, deals: Iterable[Deal] = config.DEALS,
                  active: str = config.ACTIVE_STATUS) -> DataFrame:
    """Place and status of every active or closed listing, per city and transaction type."""
    deals = tuple(deals)
    deal = F.broadcast(deal_frame(t["listings"].sparkSession, deals).select(
        F.col("deal_id").alias("transaction_type_id"), "tipo_transaccion", "closed_status"))
    known = t["listing_transaction_types"].select(F.col("id").alias("transaction_type_id"))
    return (t["listings"].filter(F.col("transaction_type_id").isin([d.type_id for d in deals]))
            .select(F.col("id").alias("listing_id"), "transaction_type_id", "status_listing_id")
            .join(deal, "transaction_type_id")
            .join(known, "transaction_type_id")
            .join(_named(t, "status_listings", "status_listing_id", "name", "status"),
                  "status_listing_id")
            .filter((F.col("status") == active) | (F.col("status") == F.col("closed_status")))
            .join(_located(t), "listing_id")
            .select("ciudad", "tipo_transaccion", "latitude", "longitude",
                    (F.col("status") == active).alias("activa")))


def recent_prices(t: Tables, as_of: str | dt.date, deals: Iterable[Deal] = config.DEALS,
                  months: int = config.PRICE_WINDOW_MONTHS,
                  statuses: Sequence[int] = config.CLOSED_TRANSACTION_STATUS_IDS) -> DataFrame:
    """Place and price per built m² of recent transactions.

    Each deal states its source: the listing price (sales), or the transaction price while the listing has
    the closed status (rentals). Any number of deals is one query.
    """
    deals = tuple(deals)
    spark = t["listings"].sparkSession
    source = F.broadcast(constant_frame(
        spark, [(d.type_id, d.label, d.closed_status_id, int(d.listed_price)) for d in deals],
        "transaction_type_id int, tipo_transaccion string, closed_id int, listed int"))
    sold = (_closed_transactions(t, deals, statuses)
            .filter(in_last_months(F.col("sold_date"), months, as_of))
            .select("listing_id", F.col("transaction_type_id").alias("sold_type_id"), "current_listing_price"))
    built = (t["listings_information"].filter(F.col("construction_area_m") > 0)
             .select("listing_id", "construction_area_m"))
    known = t["listing_transaction_types"].select(F.col("id").alias("transaction_type_id"))
    listed = t["listing_prices"].filter(F.col("amount") > 0).select(F.col("listing_id").alias("priced_id"), "amount")
    # Differences are no join keys: the big tables stay partitioned by listing alone.
    same_type = (F.col("transaction_type_id") - F.col("sold_type_id")) == 0
    # A listing's own prices only meet the rows that are priced by them.
    own = (F.col("listing_id") == F.col("priced_id")) & ((F.col("listed") - 1) == 0)
    price = F.when(F.col("listed") == 1, F.col("amount")).otherwise(F.col("current_listing_price"))
    counts = (F.col("listed") == 1) | (F.col("status_listing_id") == F.col("closed_id"))
    return (t["listings"].select(F.col("id").alias("listing_id"), "transaction_type_id", "status_listing_id")
            .join(source, "transaction_type_id").filter(counts)
            .join(known, "transaction_type_id")
            .join(sold, "listing_id").filter(same_type)
            .join(listed, own, "left")
            .withColumn("price", price).filter(F.col("price") > 0)
            .join(built, "listing_id").join(_located(t), "listing_id")
            .select("ciudad", "tipo_transaccion", "latitude", "longitude",
                    ratio(F.col("price"), F.col("construction_area_m")).alias("precio_m2")))


def zone_points(t: Tables, cities: Iterable[City] = config.CITIES,
                deals: Iterable[Deal] = config.DEALS,
                years: Iterable[int] = config.SALE_YEARS,
                statuses: Sequence[int] = config.CLOSED_TRANSACTION_STATUS_IDS) -> DataFrame:
    """Distinct closed listings with their coordinates: the input of the zone set-up."""
    cities, deals = tuple(cities), tuple(deals)
    sold = (t["transactions"].filter(F.col("transaction_status_id").isin(list(statuses)))
            .filter(in_years(F.col("sold_date"), years)).select("listing_id"))
    closed_ids = [d.closed_status_id for d in deals]
    wanted = (F.col("transaction_type_id").isin([d.type_id for d in deals])
              & F.col("status_listing_id").isin(closed_ids))
    spark = t["listings"].sparkSession
    return (t["listings"].filter(wanted).select(F.col("id").alias("listing_id"),
                                                "transaction_type_id")
            .join(_named(t, "listing_transaction_types", "transaction_type_id", "name",
                         "tipo_transaccion"), "transaction_type_id")
            .join(sold, "listing_id", "left_semi")
            .join(within_city_bbox(_located(t), city_frame(spark, cities), len(cities)), "listing_id")
            # Distinct on the join key: the rows are partitioned by it already.
            .select("listing_id", "ciudad", "latitude", "longitude", "tipo_transaccion").distinct()
            .withColumn("id_propiedad", F.col("listing_id").cast("string")).drop("listing_id"))
