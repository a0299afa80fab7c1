"""Zone set-up: K-means per city for all cities at once.

Points at the same place count as one place with a weight. All cities, numbers of zones and
restarts are iterated together (``operators.lloyd``); only centroids leave the executors.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis import config
from zonalis.operators.lloyd import iterate
from zonalis.operators.lookups import broadcast_if_small
from zonalis.operators.zones import _arrays, _distances, _nearest_id
from zonalis.sources.session import small_checkpoint, staged

# Centroids are kept with the decimals they are stored with: every partitioning
# of the points then gives the same centroids.
CENTROID_DECIMALS = 7
ITERATIONS = 300


def places(points: DataFrame, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """Distinct places per city with the number of points there."""
    return (points.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
            .groupBy("ciudad", F.col(lat).alias("lat"), F.col(lng).alias("lng"))
            .agg(F.count("*").alias("peso")))


def mean_places(points: DataFrame) -> DataFrame:
    """The single zone of a city: the mean of its points."""
    return (points.groupBy("ciudad")
            .agg(F.round(F.avg("latitude"), CENTROID_DECIMALS).alias("centroide_lat"),
                 F.round(F.avg("longitude"), CENTROID_DECIMALS).alias("centroide_lng"),
                 F.count("*").alias("total_propiedades"))
            .withColumn("cluster_id", F.lit(0)))


def _with_nearest(spots: DataFrame, centroids: DataFrame, keys: Sequence[str],
                  n_centroids: int) -> DataFrame:
    """Every place with the nearest centroid of each run (``keys``) of its city."""
    arrays = broadcast_if_small(_arrays(centroids, *keys), at_most=n_centroids)
    return (spots.join(arrays, "ciudad")
            .select(*keys, "lat", "lng", "peso", "_cents",
                    _distances("lat", "lng", "_cents").alias("_all"))
            .select(*keys, "lat", "lng", "peso", _nearest_id("_cents", "_all").alias("cluster_id"),
                    F.array_min("_all").alias("_d")))


def lloyd(spots: DataFrame, start: DataFrame, keys: Sequence[str] = ("ciudad",), *,
          iterations: int = ITERATIONS, tolerance: float = 1e-4) -> DataFrame:
    """Move centroids to the mean of their places until they stay; see ``operators.lloyd``.

    A centroid without places stays where it is. A run ends when none of its centroids moves
    further than ``tolerance`` degrees; a warning tells if some still move after ``iterations``.
    """
    return lloyd_runs(spots, start, keys, iterations=iterations, tolerance=tolerance).select(
        *keys, "cluster_id", "centroide_lat", "centroide_lng")


def lloyd_runs(spots: DataFrame, start: DataFrame, keys: Sequence[str] = ("ciudad",), *,
               iterations: int = ITERATIONS, tolerance: float = 1e-4) -> DataFrame:
    """The centroids of all runs with ``iteraciones``, ``movimiento`` (of the last one) and ``converge`` of their run."""
    done = small_checkpoint(iterate(spots, start, keys, iterations, tolerance))
    still = done.filter(~F.col("converge")).agg(F.max("movimiento"), F.count_distinct(*keys)).first()
    if still[1]:
        warnings.warn(f"K-means stopped after {iterations} iterations; {still[1]} runs still moved, a centroid by up to "
                      f"{still[0]:.7f} degrees", stacklevel=3)
    return done


def inertia(spots: DataFrame, centroids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of squared distances to the nearest centroid, per run."""
    return (_with_nearest(spots, centroids, keys, centroids.count()).groupBy(*keys)
            .agg(F.sum(F.col("peso") * F.col("_d")).alias("inercia")))


def random_start(spots: DataFrame, runs: DataFrame, restarts: int, seed: int,
                 largest_k: int, n_runs: int) -> DataFrame:
    """``k`` distinct places per run of ``runs`` (ciudad, k) and restart, drawn by hash.

    All places are candidates. Every task keeps its own first ``largest_k`` before
    the shuffle, so ranking needs no cut by size.
    """
    draw = F.xxhash64(F.lit(seed), "intento", "lat", "lng")
    tries = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1)))
    rank = F.row_number().over(Window.partitionBy("ciudad", "intento").orderBy("_draw", "lat", "lng"))
    drawn = (spots.join(broadcast_if_small(runs.select("ciudad").distinct(), at_most=n_runs), "ciudad", "left_semi")
             .select("ciudad", "lat", "lng", tries.alias("intento"))
             .withColumn("_draw", draw)
             .withColumn("_rank", rank).filter(F.col("_rank") <= largest_k))
    return (drawn.join(broadcast_if_small(runs, at_most=n_runs), "ciudad")
            .filter(F.col("_rank") <= F.col("k"))
            .select("ciudad", "k", "intento", (F.col("_rank") - 1).alias("cluster_id"),
                    F.col("lat").alias("centroide_lat"), F.col("lng").alias("centroide_lng")))


RUN = ("ciudad", "k", "intento")


def _best_runs(spots: DataFrame, runs: DataFrame, *, restarts: int, seed: int, iterations: int,
               tolerance: float, largest_k: int) -> tuple[DataFrame, DataFrame]:
    """Centroids of all runs, and the best restart with its inertia per (ciudad, k)."""
    start = random_start(spots, runs, restarts, seed, largest_k, runs.count())
    final = lloyd(spots, start, RUN, iterations=iterations, tolerance=tolerance)
    best = (inertia(spots, final, RUN).groupBy("ciudad", "k")
            .agg(F.min(F.struct("inercia", "intento")).alias("_b"))
            .select("ciudad", "k", "_b.intento", "_b.inercia"))
    return final, small_checkpoint(best)


def city_sizes(spots: DataFrame, min_points: int = config.MIN_ZONE_POINTS) -> DataFrame:
    """Points and distinct places per city; cities with too few points are left out."""
    return (spots.groupBy("ciudad")
            .agg(F.sum("peso").alias("propiedades"), F.count("*").alias("lugares"))
            .filter(F.col("propiedades") >= min_points))


def city_zones(points: DataFrame, cities: DataFrame, *, restarts: int = 10, seed: int = 42,
               iterations: int = ITERATIONS, tolerance: float = 1e-4,
               min_points: int = config.MIN_ZONE_POINTS) -> DataFrame:
    """Zones of every city of ``cities`` (ciudad, n_clusters): centroids and members.

    K-means with restarts; the restart with the lowest inertia counts. One zone
    is the mean of the points.
    """
    spots = staged(places(points), "places")
    runs = small_checkpoint(city_sizes(spots, min_points).join(
        cities.select("ciudad", F.col("n_clusters").alias("k")), "ciudad")
        .select("ciudad", "k", "lugares"))
    largest = runs.agg(F.max("k")).first()[0] or 1
    final, best = _best_runs(spots, runs, restarts=restarts, seed=seed, iterations=iterations,
                             tolerance=tolerance, largest_k=largest)
    chosen = (final.join(best.select(*RUN), list(RUN))
              .select("ciudad", "cluster_id", "centroide_lat", "centroide_lng"))
    return with_members(spots, small_checkpoint(chosen))


def with_members(spots: DataFrame, centroids: DataFrame) -> DataFrame:
    """Centroids with the number of points next to each (0 if none)."""
    total = centroids.count()
    members = (_with_nearest(spots, centroids, ["ciudad"], total)
               .groupBy("ciudad", "cluster_id").agg(F.sum("peso").alias("_n")))
    return (centroids.join(broadcast_if_small(members, at_most=total), ["ciudad", "cluster_id"], "left")
            .select("ciudad", "cluster_id", "centroide_lat", "centroide_lng",
                    F.coalesce("_n", F.lit(0).cast("bigint")).alias("total_propiedades")))


def elbow_runs(points: DataFrame, *, max_k: int = 20, restarts: int = 10, seed: int = 42,
               iterations: int = ITERATIONS, tolerance: float = 1e-4,
               min_points: int = config.MIN_ZONE_POINTS) -> tuple[DataFrame, DataFrame]:
    """The best restart of every city and even number of zones: (ciudad, k, inercia) and its centroids.

    Up to ``max_k`` zones and a tenth of the points.
    """
    spots = staged(places(points), "places")
    limit = F.least(F.lit(max_k), F.floor(F.col("propiedades") / 10)).cast("int")
    runs = small_checkpoint(
        city_sizes(spots, min_points).filter(limit >= 2)
        .select("ciudad", F.explode(F.sequence(F.lit(2), limit, F.lit(2))).alias("k"), "lugares"))
    final, best = _best_runs(spots, runs, restarts=restarts, seed=seed, iterations=iterations,
                             tolerance=tolerance, largest_k=max_k)
    return best.select("ciudad", "k", "inercia"), final.join(best.select(*RUN), list(RUN)).drop("intento")


def elbow_table(points: DataFrame, **options) -> DataFrame:
    """Inertia per city for even numbers of zones."""
    return elbow_runs(points, **options)[0]


def largest_recommended_k(n_clusters, properties):
    """Upper limit for the number of zones: five more than suggested, one per five points."""
    return F.least(n_clusters + 5, F.floor(properties / 5)).cast("bigint")


def zone_table(zones: DataFrame, country: str, generated, mean_prices: DataFrame | None = None) -> DataFrame:
    """Zones in the columns of the stored table."""
    count = zones.groupBy("ciudad").agg(F.count("*").cast("int").alias("n_clusters_ciudad"))
    rows = zones.join(count, "ciudad")
    if mean_prices is not None:
        rows = rows.join(mean_prices.select("ciudad", "cluster_id", "precio_m2_promedio"),
                         ["ciudad", "cluster_id"], "left")
    else:
        rows = rows.withColumn("precio_m2_promedio", F.lit(None).cast("double"))
    return rows.select("cluster_id", "ciudad", F.lit(country).alias("pais"), "centroide_lat",
                       "centroide_lng", "total_propiedades", "precio_m2_promedio",
                       "n_clusters_ciudad", generated.alias("fecha_generacion"))


def zone_summary(zones: DataFrame, cities: DataFrame) -> DataFrame:
    """Properties, number of zones, tier and the largest recommended k per city."""
    per_city = zones.groupBy("ciudad").agg(F.sum("total_propiedades").alias("propiedades"),
                                           F.count("*").alias("clusters"))
    return (per_city.join(cities.select("ciudad", "tier", "n_clusters"), "ciudad")
            .select("ciudad", "tier", "propiedades", "clusters",
                    largest_recommended_k(F.col("n_clusters"), F.col("propiedades"))
                    .alias("k_maximo")))
