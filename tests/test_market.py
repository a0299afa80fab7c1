import datetime as dt
import json

from pyspark.sql import functions as F

from zonalis.functions.values import has_any
from zonalis.operators import market
from zonalis.plans.market_map import market_map
from zonalis.sources.tables import map_rows, zone_centroids
from tests.conftest import rows

ANALYTICS = ("id_propiedad string, mlsid string, tipo_propiedad string, tipo_transaccion string, "
             "cluster_zona int, ciudad string, latitude double, longitude double, precio_venta double, "
             "precio_alquiler_mes double, precio_m2 double, m2_construidos double, m2_terreno double, "
             "dormitorios int, banos int, fecha_venta date")


def analytics(spark):
    d = dt.date
    return spark.createDataFrame([
        ("1", None, "Casa", "Venta", 0, "A", 1.0, 1.0, 100.0, None, 2.0, 50.0, None, 3, None, d(2024, 5, 1)),
        ("2", "m", "Casa", "Venta", 0, "A", 1.0, 3.0, 0.0, 40.0, None, None, None, None, 1, d(2025, 1, 1)),
        ("3", "m", "Casa", "Alquiler", 1, "A", 3.0, 1.0, None, 60.0, 0.0, 1.0, 1.0, 1, 1, None),
        ("4", "m", "Casa", "Venta", 0, "A", None, 1.0, 9.0, None, 1.0, 1.0, 1.0, 1, 1, d(2024, 1, 1)),
        ("5", "m", "Casa", "Venta", 0, "A", 1.0, 1.0, None, None, 1.0, 1.0, 1.0, 1, 1, d(2024, 1, 1)),
        ("6", "m", "Casa", "Venta", 0, "A", 1.0, 1.0, 0.0, None, 1.0, 1.0, 1.0, 1, 1, d(2024, 1, 1)),
        ("7", "m", "Oficina", "Venta", None, "B", 5.0, 5.0, 10.0, None, 5.0, 1.0, 1.0, 1, 1, d(2024, 1, 1)),
    ], ANALYTICS)


def test_has_any(spark):
    df = spark.createDataFrame([(None, None), (None, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(has_any("a", "b")).collect()] == [False, True, True]


def test_map_rows(spark):
    got = map_rows(analytics(spark)).collect()
    assert [r["id_propiedad"] for r in got][:2] == ["3", "2"]  # null date first, then newest
    assert {r["id_propiedad"] for r in got} == {"1", "2", "3", "6", "7"}
    assert [r["id_propiedad"] for r in map_rows(analytics(spark), "B").collect()] == ["7"]
    assert (got[1]["anio_venta"], got[1]["mes_venta"]) == (2025, 1)


def test_price_records(spark):
    records = market.price_records(map_rows(analytics(spark)))
    got = {(r["mlsid"], r["precio"]): r for r in records.collect()}
    assert set(got) == {("N/A", 100.0), ("m", 40.0), ("m", 60.0), ("m", 10.0)}
    second = got["m", 40.0]
    assert (second["precio_m2"], second["dormitorios"], second["m2_construidos"]) == (0.0, 0, 0.0)
    assert got["m", 10.0]["cluster"] == -1 and got["m", 60.0]["anio"] == 0
    texts = [json.loads(r[0]) for r in market.as_json(records).collect()]
    assert {t["precio"] for t in texts} == {100.0, 40.0, 60.0, 10.0}


def test_facets_and_summaries(spark):
    records = market.price_records(map_rows(analytics(spark)))
    every = market.facet_filter(records, {"transaccion": "todos", "tipo": None, "anio": 0, "ciudad": "todos"})
    assert every.count() == 4
    chosen = market.facet_filter(records, {"transaccion": "Venta", "ciudad": "A"})
    assert rows(market.price_summary(chosen)) == [(2, 70.0, 40.0, 100.0, 2.0)]
    empty = market.facet_filter(records, {"tipo": "nada"})
    assert rows(market.price_summary(empty)) == [(0, None, None, None, 0.0)]
    zones = rows(market.zone_price_summary(records))
    assert zones == [("A", 0, 2, 70.0, 2.0), ("A", 1, 1, 60.0, 0.0), ("B", -1, 1, 10.0, 5.0)]


def test_min_max_weight(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (15.0,), (None,)], "v double")
    assert rows(market.min_max_weight(df, "v"), "peso") == [(0.0,), (0.5,), (1.0,), (None,)]
    same = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    assert rows(market.min_max_weight(same, "v"), "peso") == [(0.0,), (0.0,)]


def test_weights_and_years_of_positive_prices(spark):
    df = spark.createDataFrame([(10.0, 0), (20.0, 0), (0.0, 1), (-5.0, 1), (None, 1)], "v double, dormitorios int")
    assert rows(market.price_weight(df, "v"), "v", "peso") == [(10.0, 0.0), (20.0, 1.0)]
    assert market.facet_filter(df, {"dormitorios": 0}).count() == 2


def test_grid_extent_and_facet_values(spark):
    df = spark.createDataFrame([(-0.1, 0.1), (-0.2, 0.2), (0.3, 0.6)], "lat double, lng double")
    assert rows(market.activity_grid(df, 0.5)) == [(-1, 0, 2), (0, 1, 1)]
    assert rows(market.extent(df, "lat", "lng").select("lat_min", "lat_max", "lng_min")) == [(-0.2, 0.3, 0.1)]
    values = market.facet_values(map_rows(analytics(spark)), ["tipo_propiedad", "anio_venta"], ["anio_venta"])
    assert [tuple(r) for r in values.collect()] == [
        ("anio_venta", "2025"), ("anio_venta", "2024"), ("tipo_propiedad", "Casa"), ("tipo_propiedad", "Oficina")]


def test_market_map(spark):
    centroids = spark.createDataFrame(
        [(0, "A", 1.0, 1.0, 3), (1, "A", 3.0, 1.0, 1), (0, "C", 0.0, 0.0, 0)],
        "cluster_id int, ciudad string, centroide_lat double, centroide_lng double, total_propiedades int")
    assert [r["ciudad"] for r in zone_centroids(centroids).collect()] == ["A", "A", "C"]
    extra = spark.createDataFrame(
        [(str(i), "m", "Casa", "Venta", 0, "A", x, y, 50.0, None, 1.0, 1.0, 1.0, 1, 1, None)
         for i, (x, y) in enumerate([(2.0, 1.0), (2.0, 3.0), (1.5, 2.0)], 20)], ANALYTICS)
    result = market_map(analytics(spark).unionByName(extra), centroids, facets={"transaccion": "Venta"})
    assert result.records.count() == 6
    assert rows(result.zones, "ciudad", "cluster", "operaciones", "peso") == [("A", 0, 5, 0.0)]
    hull = [(r["longitude"], r["latitude"]) for r in result.hulls.orderBy("orden").collect()]
    assert hull == [(1.0, 1.0), (3.0, 1.0), (3.0, 2.0), (1.0, 2.0)]
    assert result.extent.first()["lat_max"] == 5.0
    assert result.activity.agg(F.sum("operaciones")).first()[0] == 6
    assert result.summary.first()["operaciones"] == 6
