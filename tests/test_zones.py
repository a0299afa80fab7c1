import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonalis.operators import clustering, hull, lookups, zones
from zonalis.operators.medians import exact_medians
from tests.conftest import rows

CENTS = "cluster_id int, ciudad string, centroide_lat double, centroide_lng double"


@pytest.fixture(scope="module")
def cents(spark):
    return spark.createDataFrame([(1, "A", 0.0, 0.0), (0, "A", 0.0, 2.0), (2, "A", 9.0, 9.0),
                                  (0, "B", 5.0, 5.0)], CENTS)


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(
        [(1, "A", 0.0, 1.0), (2, "A", 0.1, 0.1), (3, "A", 8.0, 8.0), (4, "B", 0.0, 0.0),
         (5, "C", 0.0, 0.0), (6, "A", None, 1.0), (7, None, 0.0, 0.0)],
        "id int, ciudad string, latitude double, longitude double")


# 1 lies between two centroids: the lower id counts.
NEAREST = [(1, 0), (2, 1), (3, 2), (4, 0), (5, None), (6, None), (7, None)]


def test_nearest_by_city(points, cents):
    assert rows(zones.assign_nearest(points, cents), "id", "cluster_zona") == NEAREST


def test_nearest_by_city_without_broadcast(points, cents):
    assert rows(zones.assign_nearest(points, cents, bound=1), "id", "cluster_zona") == NEAREST


def test_nearest_of_all(points, cents):
    want = [(1, 0), (2, 1), (3, 2), (4, 1), (5, 1), (6, None), (7, 1)]
    assert rows(zones.assign_nearest(points, cents, by=()), "id", "cluster_zona") == want


def test_nearest_of_all_in_several_arrays(points, cents, monkeypatch):
    monkeypatch.setattr(zones, "CENTROIDS_PER_ARRAY", 2)
    want = [(1, 0), (2, 1), (3, 2), (4, 1), (5, 1), (6, None), (7, 1)]
    assert rows(zones.assign_nearest(points, cents, by=()), "id", "cluster_zona") == want


@pytest.mark.parametrize("bound", [zones.BROADCAST_ROWS, 10])
def test_grid_equals_plain_search(spark, monkeypatch, bound):
    monkeypatch.setattr(zones, "GRID_FROM", 0)
    monkeypatch.setattr(lookups.broadcast_if_small, "__kwdefaults__", {"at_most": None, "bound": bound})
    rng = np.random.default_rng(5)
    # Whole numbers: exact ties. A dense patch, a wide field, repeated places, places far from all others.
    cents = np.concatenate([rng.integers(0, 30, (300, 2)), rng.integers(-500, 500, (300, 2)), [[90_000, 90_000], [7, 7], [7, 7]]])
    spots = np.concatenate([rng.integers(-5, 35, (400, 2)), rng.integers(-600, 600, (400, 2)) + 0.5,
                            [[90_001, 90_000], [1e9, -1e9], [-40_000, 3], [1e300, 0]]])
    frame = spark.createDataFrame([("c", 900 - i, float(a), float(b)) for i, (a, b) in enumerate(cents)],
                                  "ciudad string, cluster_id int, centroide_lat double, centroide_lng double")
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(spots)] + [(-1, None, 1.0), (-2, 1.0, None)],
                                   "id int, latitude double, longitude double")
    got = dict(rows(zones.assign_nearest(points, frame, by=()), "id", "cluster_zona"))
    want = {-1: None, -2: None}
    for i, (a, b) in enumerate(spots):
        want[i] = min(((a - y) ** 2 + (b - x) ** 2, 900 - k) for k, (y, x) in enumerate(cents))[1]
    assert got == want


def test_many_zones_without_a_city(spark):
    rng = np.random.default_rng(6)
    cents, spots = rng.integers(0, 2000, (200_000, 2)), rng.integers(0, 2000, (300, 2)) + rng.choice([0.0, 0.5], (300, 2))
    frame = spark.createDataFrame(pd.DataFrame({
        "ciudad": "c", "cluster_id": np.arange(len(cents)), "centroide_lat": cents[:, 0] / 16, "centroide_lng": cents[:, 1] / 16}))
    points = spark.createDataFrame([(i, float(a) / 16, float(b) / 16) for i, (a, b) in enumerate(spots)],
                                   "id int, latitude double, longitude double")
    got = dict(rows(zones.assign_nearest(points, frame, by=()), "id", "cluster_zona"))
    for i, (a, b) in enumerate(spots):
        assert got[i] == int((((cents - (a, b)) / 16) ** 2).sum(axis=1).argmin())


@pytest.mark.parametrize("by", [("ciudad",), ()])
def test_nearest_without_centroids(spark, points, by):
    none = spark.createDataFrame([], CENTS)
    assert {r["cluster_zona"] for r in zones.assign_nearest(points, none, by=by).collect()} == {None}


def test_nearest_does_not_shuffle_points(spark, cents):
    city = F.when(F.col("id") % 2 == 0, "A").otherwise("B")
    big = spark.range(1000).select(city.alias("ciudad"), (F.col("id") / 100).alias("latitude"),
                                   F.lit(0.0).alias("longitude"))
    plan = zones.assign_nearest(big, cents)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bbox_of_centroids(cents):
    got = rows(zones.centroid_bbox(cents, 0.5))
    assert got == [("A", -0.5, 9.5, -0.5, 9.5), ("B", 4.5, 5.5, 4.5, 5.5)]


def test_zone_statistics_and_features(spark):
    keys = "ciudad string, tipo_transaccion string, cluster_zona int"
    status = spark.createDataFrame(
        [("A", "Venta", 0, True), ("A", "Venta", 0, True), ("A", "Venta", 0, False),
         ("A", "Venta", 1, True), ("A", "Venta", None, True)], f"{keys}, activa boolean")
    ratios = zones.active_closed_ratio(status)
    assert rows(ratios) == [("A", "Venta", 0, 2, 1, 2.0), ("A", "Venta", 1, 1, 0, 1.0)]
    means = zones.mean_price_per_m2(spark.createDataFrame(
        [("A", "Venta", 0, 2.0), ("A", "Venta", 0, 4.0), ("A", "Venta", 1, 0.0)],
        f"{keys}, precio_m2 double"))
    listings = spark.createDataFrame(
        [(1, "A", "Venta", 0, 6.0), (2, "A", "Venta", 1, 6.0), (3, "A", "Alquiler", 0, 6.0),
         (4, "A", "Venta", None, 6.0), (5, "A", "Venta", 0, None)], f"id int, {keys}, precio_m2 double")
    got = zones.enrich_zone_features(listings, ratios, means)
    assert rows(got, "id", "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona") == [
        (1, 2.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0), (5, 2.0, None)]
    assert rows(zones.zone_feature_means(got)) == [("A", 0, 4 / 3, 0.5), ("A", 1, 1.0, 0.0)]


# --- set-up -------------------------------------------------------------------

@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    data = []
    for city, middles in (("A", [(0, 0), (10, 0), (0, 10)]), ("B", [(50, 50)])):
        for m in middles:
            data += [(city, float(x), float(y)) for x, y in rng.normal(m, 0.5, (60, 2))]
    data += [("C", 1.0, 1.0)] * 4
    return spark.createDataFrame(data, "ciudad string, latitude double, longitude double")


def brute_inertia(points, centres):
    return sum(min((p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 for c in centres) for p in points)


def test_city_zones_finds_the_blobs(spark, blobs):
    cities = spark.createDataFrame([("A", 1, 3), ("B", 2, 1), ("C", 2, 1), ("D", 2, 1)],
                                   "ciudad string, tier int, n_clusters int")
    found = clustering.city_zones(blobs, cities, restarts=5)
    got = found.collect()
    assert {r["ciudad"] for r in got} == {"A", "B"}  # C has fewer than five points
    a = sorted((round(r["centroide_lat"]), round(r["centroide_lng"]), r["total_propiedades"])
               for r in got if r["ciudad"] == "A")
    assert a == [(0, 0, 60), (0, 10, 60), (10, 0, 60)]
    mean = blobs.filter("ciudad = 'B'").agg(F.avg("latitude")).first()[0]
    assert [r["centroide_lat"] for r in got if r["ciudad"] == "B"] == pytest.approx([mean], abs=1e-6)
    summary = rows(clustering.zone_summary(found, cities))
    assert summary == [("A", 1, 180, 3, 8), ("B", 2, 60, 1, 6)]
    table = clustering.zone_table(found, "X", F.lit(None).cast("timestamp_ntz"))
    assert {(r["ciudad"], r["n_clusters_ciudad"]) for r in table.collect()} == {("A", 3), ("B", 1)}


def test_zones_do_not_depend_on_partitions(spark, blobs):
    cities = spark.createDataFrame([("A", 1, 3), ("B", 2, 1)], "ciudad string, tier int, n_clusters int")
    got = [rows(clustering.city_zones(blobs.repartition(n), cities, restarts=2, iterations=4))
           for n in (1, 7)]
    assert got[0] == got[1]


def test_lloyd_never_raises_inertia(spark, blobs):
    spots = clustering.places(blobs.filter("ciudad = 'A'"))
    start = clustering.random_start(
        spots, spark.createDataFrame([("A", 4, 180)], "ciudad string, k int, lugares int"), 1, 1, 4, 1)
    pts = [(r["latitude"], r["longitude"]) for r in blobs.filter("ciudad = 'A'").collect()]
    seen = []
    for n in (0, 1, 2, 4, 8):
        cents = clustering.lloyd(spots, start, clustering.RUN, iterations=n) if n else start
        centres = [(r["centroide_lat"], r["centroide_lng"]) for r in cents.collect()]
        assert len(centres) == 4
        value = clustering.inertia(spots, cents, clustering.RUN).first()["inercia"]
        assert value == pytest.approx(brute_inertia(pts, centres))
        seen.append(value)
    assert all(b <= a + 1e-6 for a, b in zip(seen, seen[1:]))


def test_random_start_in_a_large_city(spark):
    spots = spark.range(60_000).select(F.lit("A").alias("ciudad"), (F.col("id") * 1.0).alias("lat"),
                                       F.lit(0.0).alias("lng"), F.lit(1).alias("peso"))
    runs = spark.createDataFrame([("A", 3, 60_000), ("A", 5, 60_000)], "ciudad string, k int, lugares int")
    got = clustering.random_start(spots, runs, 4, 9, 5, 2).collect()
    every = clustering.random_start(spots, runs.withColumn("lugares", F.lit(1)), 4, 9, 5, 2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, every))  # as if all places were ranked
    assert len(got) == 4 * (3 + 5)
    for i in range(4):
        assert len({r["centroide_lat"] for r in got if r["intento"] == i and r["k"] == 5}) == 5


def test_lloyd_keeps_a_centroid_without_places(spark):
    spots = spark.createDataFrame([("A", 0.0, 0.0, 2), ("A", 1.0, 0.0, 1)],
                                  "ciudad string, lat double, lng double, peso long")
    start = spark.createDataFrame([(0, "A", 0.5, 0.0), (1, "A", 99.0, 99.0)], CENTS)
    got = rows(clustering.lloyd(spots, start), "cluster_id", "centroide_lat", "centroide_lng")
    assert got == [(0, pytest.approx(1 / 3, abs=1e-6), 0.0), (1, 99.0, 99.0)]


def test_elbow_table(spark, blobs):
    got = {(r["ciudad"], r["k"]): r["inercia"] for r in
           clustering.elbow_table(blobs, max_k=6, restarts=4).collect()}
    assert set(got) == {(c, k) for c in "AB" for k in (2, 4, 6)}  # C is too small
    assert got["A", 4] < got["A", 2] / 5
    assert got["B", 6] < got["B", 2]


def test_largest_recommended_k(spark):
    df = spark.createDataFrame([(10, 1000), (10, 40)], "k int, n int")
    got = [r[0] for r in df.select(clustering.largest_recommended_k(F.col("k"), F.col("n"))).collect()]
    assert got == [15, 8]


# --- hulls ----------------------------------------------------------------------

def hulls(spark, points, n=3):
    df = spark.createDataFrame([(k, float(x), float(y)) for k, x, y in points], "k string, x double, y double")
    out = {}
    for r in hull.group_hulls(df.repartition(n), ["k"], "x", "y").orderBy("k", "orden").collect():
        out.setdefault(r["k"], []).append((r["x"], r["y"]))
    return out


def test_hull_cases(spark):
    square = [("s", x, y) for x in range(5) for y in range(5)]
    data = square + square + [("two", 0, 0), ("two", 1, 1)] + [("line", i, 2 * i) for i in range(9)]
    data += [("one", 1, 1)] * 5
    data += [("tiny", 0, 0), ("tiny", 9e-7, 0), ("tiny", 0, 9e-7)]
    assert hulls(spark, data) == {"s": [(0, 0), (4, 0), (4, 4), (0, 4)],
                                  "tiny": [(0, 0), (9e-7, 0), (0, 9e-7)]}


def test_hull_contains_all_points_on_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(hull, "BUFFERED_POINTS", 50)
    rng = np.random.default_rng(3)
    units = {"g": rng.normal(0, 1e7, (400, 2)).round().astype(int).tolist(),
             "fine": rng.integers(0, 200, (3000, 2)).tolist()}
    pts = [(k, x / 1e7, y / 1e7) for k, places in units.items() for x, y in places]
    found = [hulls(spark, pts, n) for n in (1, 4, 17, 40)]
    assert all(f == found[0] for f in found)
    for k, places in units.items():
        v = [(round(x * 1e7), round(y * 1e7)) for x, y in found[0][k]]
        assert {*v} <= {tuple(p) for p in places}
        for (ax, ay), (bx, by) in zip(v, v[1:] + v[:1]):
            assert all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0 for x, y in places)


# --- medians ----------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 40])
def test_exact_medians(spark, parts):
    rng = np.random.default_rng(1)
    data = [(k, float(v) if i % 7 else None, int(w)) for k, n in (("a", 501), ("b", 40), ("c", 1))
            for i, (v, w) in enumerate(zip(rng.normal(0, 1, n), rng.integers(0, 4, n)))]
    df = spark.createDataFrame(data, "k string, v double, w int").repartition(parts)
    got = {r["k"]: (r["v"], float(r["w"])) for r in
           exact_medians(df, ["v", "w"], ["k"]).collect()}
    for k in "abc":
        vs = [v for key, v, _ in data if key == k and v is not None]
        ws = [w for key, _, w in data if key == k]
        assert got[k][1] == np.median(ws)
        if vs:
            assert got[k][0] == pytest.approx(np.median(vs), abs=0)
