"""The zone job: points of closed listings, elbow table, zones, stored table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zonalis import config
from zonalis.config import City
from zonalis.functions.dates import instant
from zonalis.operators import clustering
from zonalis.operators.upsert import referring, set_null_where_changed
from zonalis.sources import crm, versions
from zonalis.sources.session import staged


@dataclass(frozen=True)
class Zones:
    table: DataFrame
    summary: DataFrame


def elbow(tables: crm.Tables, cities: Iterable[City] = config.CITIES,
          years: Iterable[int] = config.SALE_YEARS, **options) -> DataFrame:
    """Inertia per number of zones for the cities that have several zones."""
    large = [c for c in cities if c.tier == 1]
    return clustering.elbow_table(crm.zone_points(tables, large, years=years), **options)


def build_zones(tables: crm.Tables, as_of: str | dt.date, cities: Iterable[City] = config.CITIES,
                years: Iterable[int] = config.SALE_YEARS, country: str = config.COUNTRY,
                **options) -> Zones:
    """Zones of every city with enough points; ``n_clusters`` of the cities decides how many."""
    cities = tuple(cities)
    spark = tables["listings"].sparkSession
    settings = crm.city_frame(spark, cities)
    points = staged(crm.zone_points(tables, cities, years=years), "zone_points")
    found = clustering.city_zones(points, settings, **options)
    return Zones(clustering.zone_table(found, country, instant(as_of)),
                 clustering.zone_summary(found, settings))


def cascade(spark: SparkSession, path: str, changes: DataFrame, key: str = config.ANALYTICS_KEY) -> tuple[int, ...]:
    """Take the zone from stored properties that refer to a changed zone (``upsert.zone_changes``); the buckets written.

    Only city and zone of the stored rows are read to find the buckets; buckets without such a row stay as they lie.
    """
    found = versions.manifest(spark, path)
    if found is None:
        return ()
    changes = staged(changes, "zone_changes")
    stored = versions.read(spark, path).select(key, "ciudad", "cluster_zona")
    touched = tuple(versions.buckets_of(referring(stored, changes), key, found[3]))
    if touched:
        rows = set_null_where_changed(versions.read(spark, path, touched), changes)
        versions.replace_buckets(spark, path, rows, touched, key)
    return touched
