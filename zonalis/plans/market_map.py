"""The map job: every table a price map shows, for one city or all."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators import hull, market
from zonalis.sources.session import staged
from zonalis.sources.tables import map_rows, zone_centroids


@dataclass(frozen=True)
class MarketMap:
    records: DataFrame
    summary: DataFrame
    zones: DataFrame
    hulls: DataFrame
    activity: DataFrame
    facets: DataFrame
    extent: DataFrame


def market_map(analytics: DataFrame, centroids: DataFrame, city: str | None = None,
               facets: Mapping[str, object] | None = None, cell: float = 0.01) -> MarketMap:
    rows = staged(map_rows(analytics, city, ordered=False), "map")
    zones = zone_centroids(centroids, city)
    chosen = market.facet_filter(market.price_records(rows), facets or {})
    zone_prices = market.zone_price_summary(chosen, zones)
    outlines = hull.group_hulls(
        rows.filter(F.col("cluster_zona").isNotNull())
            .select("ciudad", "cluster_zona", F.col("latitude").cast("double").alias("latitude"),
                    F.col("longitude").cast("double").alias("longitude")),
        ["ciudad", "cluster_zona"], "longitude", "latitude")
    return MarketMap(
        records=market.price_weight(chosen, "precio"),
        summary=market.price_summary(chosen),
        zones=market.price_weight(zone_prices, "precio_promedio"),
        hulls=outlines,
        activity=market.activity_grid(chosen, cell),
        facets=market.facet_values(
            rows, ["tipo_propiedad", "tipo_transaccion", "anio_venta", "ciudad"], ["anio_venta"]),
        extent=market.extent(rows))
