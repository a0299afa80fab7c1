"""Zones: nearest centroid, zone statistics, zone features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis import config
from zonalis.functions.geo import squared_distance
from zonalis.functions.prices import relative_difference
from zonalis.functions.values import null_if_zero
from zonalis.operators.lookups import (BROADCAST_ROWS, broadcast_if_small, lookup_join,
                                       row_count_up_to)
from zonalis.sources.session import staged

# Arrays of centroids compared at once hold about this many at most.
CENTROIDS_PER_ARRAY = 20_000
# Without a city more centroids than this are looked up by grid cells, this wide for evenly spread ones.
GRID_FROM = 256
CELL = 2.0
# Without a broadcast the points of a city are spread over this many parts.
CITY_PARTS = 64


def _distances(lat: str, lng: str, centroids: str) -> Column:
    """Squared distances to all centroids of an array; null without coordinates."""
    return F.transform(centroids, lambda c: squared_distance(
        F.col(lat), F.col(lng), c["lat"], c["lng"]))


def _nearest_id(centroids: str, distances: str) -> Column:
    """The first of the nearest. The array is sorted by id, so ties go to the lowest id."""
    position = F.array_position(distances, F.array_min(distances))
    return F.get(centroids, (position - 1).cast("int"))["id"]


def _arrays(centroids: DataFrame, *keys: str | Column) -> DataFrame:
    member = F.struct(F.col("cluster_id").cast("int").alias("id"),
                      F.col("centroide_lat").cast("double").alias("lat"),
                      F.col("centroide_lng").cast("double").alias("lng"))
    return centroids.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias("_cents"))


def assign_nearest(points: DataFrame, centroids: DataFrame, by: Sequence[str] = ("ciudad",),
                   lat: str = "latitude", lng: str = "longitude", out: str = "cluster_zona",
                   bound: int = BROADCAST_ROWS) -> DataFrame:
    """The nearest centroid of every point, among those with the same ``by`` columns.

    Null without coordinates or without centroids. The centroids of a city
    travel as one array to the points, which are neither shuffled nor
    multiplied. Beyond ``bound`` centroids the arrays are joined by shuffle,
    with the points of a city spread over parts.
    """
    keys = list(by)
    if not keys:
        return _assign_global(points, centroids, lat, lng, out)

    total = row_count_up_to(centroids, bound)
    arrays = _arrays(centroids, *keys)
    if total <= bound:
        joined = points.join(broadcast_if_small(arrays, at_most=total, bound=bound), keys, "left")
    else:
        part = F.pmod(F.xxhash64(lat, lng), F.lit(CITY_PARTS)).cast("int")
        spread = arrays.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(CITY_PARTS - 1))))
        joined = points.withColumn("_part", part).join(spread, [*keys, "_part"], "left")
    measured = joined.withColumn("_d", _distances(lat, lng, "_cents"))
    return measured.select(*points.columns, _nearest_id("_cents", "_d").alias(out))


def _assign_global(points: DataFrame, centroids: DataFrame, lat: str, lng: str,
                   out: str) -> DataFrame:
    """The nearest of all centroids: by grid cells if they are many, else all in arrays.

    A cell knows the centroids of its own and the eight cells around it. If the nearest of them is less than a cell
    away, no other can be as near; the points left look again in cells four times as wide. Points still left when a
    cell would hold too many centroids, those far from all of them, are compared with all.
    """
    places = centroids.groupBy(F.col("centroide_lat").cast("double").alias("lat"),
                               F.col("centroide_lng").cast("double").alias("lng")).agg(
        F.min(F.col("cluster_id").cast("int")).alias("id")).dropna()
    n, *ends = places.agg(F.count("*"), *(f(c) for c in ("lat", "lng") for f in (
        lambda c: F.percentile_approx(c, 0.02), lambda c: F.percentile_approx(c, 0.98), F.min, F.max))).first()
    if not n:
        return points.withColumn(out, F.lit(None).cast("int"))
    if n <= GRID_FROM:
        return _against_all(points, places, n, lat, lng, out)

    places = staged(places, "centroids")
    inner = max(ends[1] - ends[0], ends[5] - ends[4])
    outer = max(ends[3] - ends[2], ends[7] - ends[6])
    size = CELL * max(inner, outer * 1e-6) / n ** 0.5 or 1.0
    done, left = [], points
    while True:
        spread = _spread(places, size)
        if spread.groupBy("_y", "_x").count().agg(F.max("count")).first()[0] > CENTROIDS_PER_ARRAY:
            break
        cells = staged(spread.groupBy("_y", "_x").agg(
            F.array_sort(F.collect_list(F.struct("id", "lat", "lng"))).alias("_cents")), "centroid-cells")
        found = staged(_in_cells(left, cells, size, 9 * n, lat, lng, out), "nearest")
        done.append(found.filter("_found").drop("_found"))
        left = found.filter(~F.col("_found")).select(*points.columns)
        if size > outer or left.isEmpty():
            break
        size *= 4
    if not left.isEmpty():
        done.append(_against_all(left, places, n, lat, lng, out))
    return reduce(DataFrame.union, done)


def _cell(column: Column, size: float) -> Column:
    return F.floor(column.cast("double") / size)


def _spread(places: DataFrame, size: float) -> DataFrame:
    """Every centroid once for each of the nine cells that know it."""
    around = F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long"))
    return (places.withColumn("_dy", F.explode(around)).withColumn("_dx", F.explode(around))
            .select("id", "lat", "lng", (_cell(F.col("lat"), size) + F.col("_dy")).alias("_y"),
                    (_cell(F.col("lng"), size) + F.col("_dx")).alias("_x")))


def _in_cells(points: DataFrame, cells: DataFrame, size: float, entries: int, lat: str, lng: str,
              out: str) -> DataFrame:
    """``out`` and ``_found``: whether it is certain, which it also is without coordinates."""
    keyed = points.withColumns({"_y": _cell(F.col(lat), size), "_x": _cell(F.col(lng), size)})
    measured = keyed.join(broadcast_if_small(cells, at_most=entries), ["_y", "_x"], "left").withColumn(
        "_d", _distances(lat, lng, "_cents"))
    near = F.coalesce(F.array_min("_d") < (size * (1 - 1e-9)) ** 2, F.lit(False))
    return measured.select(*points.columns, F.when(near, _nearest_id("_cents", "_d")).alias(out),
                           (near | F.col(lat).isNull() | F.col(lng).isNull()).alias("_found"))


def _against_all(points: DataFrame, places: DataFrame, n: int, lat: str, lng: str, out: str) -> DataFrame:
    """Every centroid against every point, array by array; an array is broadcast, its size is bounded."""
    parts = -(-n // CENTROIDS_PER_ARRAY)
    arrays = places.groupBy(F.pmod(F.xxhash64("id", "lat", "lng"), F.lit(parts)).cast("int").alias("_part")).agg(
        F.array_sort(F.collect_list(F.struct("id", "lat", "lng"))).alias("_cents"))
    if parts > 1:
        arrays = staged(arrays, "centroid-arrays")
    measured = points.withColumn("_best", F.lit(None).cast("struct<d:double,id:int>"))
    for i in range(parts):
        one = F.broadcast(arrays.filter(F.col("_part") == i))
        nearest = F.when(F.array_min("_d").isNotNull(), F.struct(F.array_min("_d").alias("d"), _nearest_id("_cents", "_d").alias("id")))
        measured = (measured.withColumn("_part", F.lit(i)).join(one, "_part", "left")
                    .withColumn("_d", _distances(lat, lng, "_cents"))
                    .select(*points.columns, F.least("_best", nearest).alias("_best")))
    return measured.select(*points.columns, F.col("_best.id").alias(out))


def centroid_bbox(centroids: DataFrame, margin: float = config.BBOX_MARGIN) -> DataFrame:
    """Extent of the centroids of every city, widened by ``margin`` degrees."""
    return centroids.groupBy("ciudad").agg(
        (F.min("centroide_lat").cast("double") - margin).alias("lat_min"),
        (F.max("centroide_lat").cast("double") + margin).alias("lat_max"),
        (F.min("centroide_lng").cast("double") - margin).alias("lng_min"),
        (F.max("centroide_lng").cast("double") + margin).alias("lng_max"))


ZONE_KEYS = ("ciudad", "tipo_transaccion", "cluster_zona")


def active_closed_ratio(points: DataFrame, keys: Sequence[str] = ZONE_KEYS) -> DataFrame:
    """Active over closed listings per zone; no closed listing counts as one."""
    return (points.filter(F.col("cluster_zona").isNotNull()).groupBy(*keys)
            .agg(F.count_if("activa").alias("activas"), F.count_if(~F.col("activa")).alias("cerradas"))
            .withColumn("ratio_activas_vendidas_zona",
                        F.col("activas") / F.coalesce(null_if_zero(F.col("cerradas")), F.lit(1))))


def mean_price_per_m2(points: DataFrame, keys: Sequence[str] = ZONE_KEYS) -> DataFrame:
    return (points.filter(F.col("cluster_zona").isNotNull()).groupBy(*keys)
            .agg(F.avg("precio_m2").alias("promedio_m2_zona")))


def enrich_zone_features(df: DataFrame, ratios: DataFrame, means: DataFrame,
                         keys: Sequence[str] = ZONE_KEYS, at_most: int | None = None) -> DataFrame:
    """Zone ratio and relative difference to the zone mean, 0 where the zone has none.

    ``at_most`` bounds the rows of the two statistics (zones x transaction types).
    """
    ratio = ratios.select(*keys, F.col("ratio_activas_vendidas_zona").alias("_ratio"))
    mean = means.select(*keys, F.col("promedio_m2_zona").alias("_mean"))
    joined = lookup_join(lookup_join(df, ratio, keys, at_most=at_most), mean, keys, at_most=at_most)
    return joined.withColumns({
        "ratio_activas_vendidas_zona": F.coalesce("_ratio", F.lit(0.0)),
        "diferencia_vs_promedio_zona": relative_difference(F.col("precio_m2"), F.col("_mean")),
    }).select(*df.columns, "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona")


def zone_feature_means(analytics: DataFrame, by_city: bool = True) -> DataFrame:
    """Mean zone features per zone for scoring; null means 0.

    ``by_city=False`` pools zones with the same number over all cities.
    """
    keys = ["ciudad", "cluster_zona"] if by_city else ["cluster_zona"]
    features = ("ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona")
    return (analytics.filter(F.col("cluster_zona").isNotNull()).groupBy(*keys)
            .agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in features]))
