"""The load job: extract, clean, derive features, place in zones, upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis import config
from zonalis.config import City, Deal
from zonalis.operators import features, zones
from zonalis.operators.lookups import row_count_up_to
from zonalis.operators.quality import load_violations, reject_rows
from zonalis.operators.reports import reject_detail, reject_summary
from zonalis.operators.upsert import action_counts, merge, set_null_without_parent
from zonalis.plans.cleaning import Cleaned, CleaningRules, clean
from zonalis.sources import crm, versions
from zonalis.sources.session import staged

CENTROID_LIMIT = 100_000


@dataclass(frozen=True)
class Load:
    """Result of a load: the new analytics rows and everything that was left out."""

    analytics: DataFrame
    actions: DataFrame
    cleaned: Cleaned
    not_loaded: DataFrame
    training: DataFrame

    @property
    def detail(self) -> DataFrame:
        return reject_detail(self.cleaned.rejects)

    @property
    def summary(self) -> DataFrame:
        return reject_summary(self.cleaned.rejects)


def zone_statistics(status: DataFrame, prices: DataFrame,
                    centroids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Active/closed ratio and mean price per m² of every zone of every city."""
    box = zones.centroid_bbox(centroids)
    n_zones = row_count_up_to(centroids, CENTROID_LIMIT)
    known = n_zones if n_zones <= CENTROID_LIMIT else None

    def placed(points: DataFrame) -> DataFrame:
        return zones.assign_nearest(crm.within_city_bbox(points, box, known), centroids)

    return zones.active_closed_ratio(placed(status)), zones.mean_price_per_m2(placed(prices))


def derive_features(kept: DataFrame, centroids: DataFrame, ratios: DataFrame, means: DataFrame,
                    as_of: str | dt.date, n_deals: int = len(config.DEALS),
                    department_subtypes: Iterable[str] = features.DEPARTMENT_SUBTYPES) -> DataFrame:
    """Market time, zone, price per m² and zone features of clean listings."""
    timed = features.with_market_time(kept, as_of)
    zoned = zones.assign_nearest(timed, centroids)
    priced = features.with_price_per_m2(zoned, department_subtypes)
    n_zones = row_count_up_to(centroids, CENTROID_LIMIT)
    return zones.enrich_zone_features(
        priced, ratios, means, at_most=n_zones * n_deals if n_zones <= CENTROID_LIMIT else None)


@dataclass(frozen=True)
class Arriving:
    """Rows ready to be loaded, and all that was left out on the way."""

    rows: DataFrame
    featured: DataFrame
    cleaned: Cleaned
    not_loaded: DataFrame


def prepare(tables: crm.Tables, centroids: DataFrame, as_of: str | dt.date, cities: Iterable[City] = config.CITIES,
            deals: Iterable[Deal] = config.DEALS, years: Iterable[int] = config.SALE_YEARS,
            rules: CleaningRules = CleaningRules(),
            department_subtypes: Iterable[str] = features.DEPARTMENT_SUBTYPES, country: str = config.COUNTRY,
            extracted: DataFrame | None = None) -> Arriving:
    """Extract, clean, derive features and place in zones. ``extracted`` stands for the extract (see ``plans.extract``)."""
    deals = tuple(deals)
    raw = crm.extract_listings(tables, cities, deals, years) if extracted is None else extracted
    cleaned = clean(raw, rules)
    ratios, means = zone_statistics(crm.status_points(tables, deals),
                                    crm.recent_prices(tables, as_of, deals), centroids)
    featured = staged(derive_features(cleaned.kept, centroids, ratios, means, as_of, len(deals), department_subtypes),
                      "featured")
    rows = features.load_projection(featured).withColumn("pais", F.lit(country))
    # The cleaning job leaves one row per property.
    checked = staged(load_violations(rows, unique=None), "load")
    accepted = checked.filter(F.size("violaciones") == 0).drop("violaciones")
    return Arriving(set_null_without_parent(accepted, centroids), featured, cleaned, reject_rows(checked, "violaciones"))


def load(tables: crm.Tables, centroids: DataFrame, target: DataFrame, as_of: str | dt.date, *args, **options) -> Load:
    """The whole job on a frame. Nothing is written but stages; other arguments are those of ``prepare``."""
    ready = prepare(tables, centroids, as_of, *args, **options)
    merged = staged(merge(target, ready.rows, as_of=as_of), "merge")
    return Load(analytics=merged.drop("accion"), actions=action_counts(merged), cleaned=ready.cleaned,
                not_loaded=ready.not_loaded, training=features.training_rows(ready.featured))


@dataclass(frozen=True)
class StoredLoad:
    """A load into a stored table: its new version, the buckets that were written, rows by action."""

    version: str
    touched: tuple[int, ...]
    actions: DataFrame
    cleaned: Cleaned
    not_loaded: DataFrame
    training: DataFrame


def merge_into(spark: SparkSession, path: str, incoming: DataFrame, as_of: str | dt.date,
               key: str = config.ANALYTICS_KEY) -> tuple[str, tuple[int, ...], DataFrame]:
    """Upsert into a table in key buckets: (version, buckets written, rows by action among the buckets written).

    Only the buckets that hold an arriving key are read and written; the next manifest links the others as they lie.
    """
    found = versions.manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table in {path}; write it with versions.write_buckets first")
    touched = tuple(versions.buckets_of(incoming, key, found[3]))
    merged = staged(merge(versions.read(spark, path, touched), incoming, key=key, as_of=as_of), "merge")
    version = versions.replace_buckets(spark, path, merged.drop("accion"), touched, key)
    return version, touched, action_counts(merged)


def load_into(tables: crm.Tables, centroids: DataFrame, path: str, as_of: str | dt.date, *args, **options) -> StoredLoad:
    """The whole job into a stored table; other arguments are those of ``prepare``."""
    ready = prepare(tables, centroids, as_of, *args, **options)
    version, touched, actions = merge_into(centroids.sparkSession, path, ready.rows, as_of)
    return StoredLoad(version, touched, actions, ready.cleaned, ready.not_loaded, features.training_rows(ready.featured))
