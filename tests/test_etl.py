import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.queries import _empty_analytics
from zonalis.config import City, Deal
from zonalis.operators import features
from zonalis.plans.cleaning import CleaningRules
from zonalis.plans.etl import load, zone_statistics
from zonalis.plans.zone_setup import build_zones, elbow
from zonalis.sources import crm, schemas
from tests.conftest import rows

AS_OF = "2026-03-01"
CITIES = (City("A", 1, 2, (-18.0, -17.0), (-64.0, -63.0)), City("B", 2, 1, (-10.0, -9.0), (-64.0, -63.0)))
D = dt.datetime


def database(spark):
    """A small listings database. Listings 1-9 are sales, 21-29 rentals."""
    listings, info, prices, places, deals = [], [], [], [], []

    def add(i, kind, status, city, lat, sold, price=60000.0, area=100.0, t_type=None, t_status=2, closing=None):
        listings.append((i, f"M{i}", D(2025, 1, 1), None, None, kind, status, 1))
        info.append((i, area, 200.0, 50.0, 2, 1, 1, 2000, 1, 1, 1))
        prices.append((i, price))
        places.append((i, lat, -63.5, city))
        if sold:
            deals.append((i, t_type or kind, t_status, sold, closing or price))

    add(1, 1, 8, 10, -17.2, D(2025, 12, 1))
    add(2, 1, 8, 10, -17.3, D(2024, 2, 1))                     # outside the price window
    add(3, 1, 8, 10, -19.0, D(2025, 12, 1))                    # outside the box of its city
    add(4, 1, 8, 10, -17.4, D(2020, 12, 1))                    # other year
    add(5, 1, 8, 10, -17.5, D(2025, 12, 1), t_status=3)        # other transaction status
    add(6, 1, 8, 10, -17.5, D(2025, 12, 1), t_type=2)          # transaction of the other type
    add(7, 1, 1, 10, -17.2, None)                              # active
    add(8, 1, 7, 10, -17.2, D(2025, 12, 1))                    # closed as a rental
    add(9, 1, 8, 30, -17.2, D(2025, 12, 1))                    # city without configuration
    add(21, 2, 7, 20, -9.5, D(2026, 1, 5), price=800.0, closing=700.0)
    add(22, 2, 1, 20, -9.6, D(2026, 1, 5), price=800.0, closing=500.0)  # active, yet a transaction
    add(23, 2, 7, 20, -9.4, D(2026, 1, 6), price=900.0, area=0.0)
    deals.append((1, 1, 5, D(2025, 12, 24), 61000.0))          # second transaction of listing 1

    def frame(data, ddl):
        return spark.createDataFrame(data, ddl)

    def lookup(data, name="name"):
        return frame(data, f"id int, {name} string")

    return {
        "listings": frame(listings, "id long, MLSID string, date_of_listing timestamp_ntz, "
                          "cancellation_date timestamp_ntz, contract_end_date timestamp_ntz, "
                          "transaction_type_id int, status_listing_id int, area_id int"),
        "listings_information": frame(info, "listing_id long, construction_area_m double, total_area double, "
                                      "land_m2 double, number_bedrooms int, number_bathrooms int, "
                                      "parking_slots int, year_construction int, subtype_property_id int, "
                                      "state_property_id int, property_category_id int"),
        "listing_prices": frame(prices, "listing_id long, amount double"),
        "locations": frame(places, "listing_id long, latitude double, longitude double, city_id int"),
        "transactions": frame(deals, "listing_id long, transaction_type_id int, transaction_status_id int, "
                              "sold_date timestamp_ntz, current_listing_price double"),
        "cities": lookup([(10, "A"), (20, "B"), (30, "C")]),
        "areas": lookup([(1, "zona")]),
        "listing_transaction_types": lookup([(1, "En Venta"), (2, "En Alquiler")]),
        "status_listings": lookup([(1, "Activa"), (7, "Alquilado"), (8, "Venta Aceptada/Vendida")]),
        "subtype_properties": lookup([(1, "Casa")]),
        "state_properties": lookup([(1, "bueno")], "name_state_properties"),
        "properties_category": lookup([(1, "cat")], "name_properties_categories"),
    }


@pytest.fixture(scope="module")
def tables(spark):
    data = database(spark)
    return crm.read_tables(lambda name: data[name])


@pytest.fixture(scope="module")
def cents(spark):
    return spark.createDataFrame([(0, "A", -17.2, -63.5), (1, "A", -17.6, -63.5), (0, "B", -9.5, -63.5)],
                                 "cluster_id int, ciudad string, centroide_lat double, centroide_lng double")


def test_extract(tables):
    raw = crm.extract_listings(tables, CITIES)
    assert rows(raw, "id_propiedad", "sold_date", "precio_cierre", "tipo_transaccion") == [
        ("1", D(2025, 12, 1), 60000.0, "Venta"), ("1", D(2025, 12, 24), 61000.0, "Venta"),
        ("2", D(2024, 2, 1), 60000.0, "Venta"), ("21", D(2026, 1, 5), 700.0, "Alquiler"),
        ("23", D(2026, 1, 6), 900.0, "Alquiler")]
    first = raw.filter("id_propiedad = '21'").first()
    assert (first["segmento"], first["status"], first["subtipo_original"], first["estado_propiedad"],
            first["categoria_propiedad"], first["ciudad"]) == ("zona", "Alquilado", "Casa", "bueno", "cat", "B")
    ordered = [r["id_propiedad"] for r in crm.extract_listings(tables, CITIES, newest_first=True).collect()]
    assert ordered == ["23", "21", "2", "1", "1"]


def test_extract_shuffles_each_large_table_once(spark, tables):
    """With broadcasts off every join is a shuffle join; the listing id is the only key of the big ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        big = {k: v.repartition(3) for k, v in tables.items()}
        plan = crm.extract_listings(big, CITIES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "transaction_type_id" not in "".join(
        line for line in plan.splitlines() if "hashpartitioning(listing_id" in line)


def test_status_points_and_prices(tables):
    status = rows(crm.status_points(tables), "ciudad", "tipo_transaccion", "latitude", "activa")
    assert status == [
        ("A", "Venta", -17.2, False), ("A", "Venta", -17.2, True), ("A", "Venta", -17.3, False),
        ("A", "Venta", -17.4, False), ("A", "Venta", -17.5, False), ("A", "Venta", -17.5, False),
        ("A", "Venta", -19.0, False), ("B", "Alquiler", -9.4, False), ("B", "Alquiler", -9.5, False),
        ("B", "Alquiler", -9.6, True), ("C", "Venta", -17.2, False)]
    # Sales with their listing price, also listing 8; rentals with the transaction price, only closed ones.
    prices = rows(crm.recent_prices(tables, AS_OF), "ciudad", "tipo_transaccion", "latitude", "precio_m2")
    assert prices == [
        ("A", "Venta", -17.2, 600.0), ("A", "Venta", -17.2, 600.0), ("A", "Venta", -17.2, 600.0),
        ("A", "Venta", -19.0, 600.0), ("B", "Alquiler", -9.5, 7.0), ("C", "Venta", -17.2, 600.0)]


def test_zone_statistics(tables, cents):
    ratios, means = zone_statistics(crm.status_points(tables), crm.recent_prices(tables, AS_OF), cents)
    assert rows(ratios, "ciudad", "cluster_zona", "activas", "cerradas") == [
        ("A", 0, 1, 3), ("A", 1, 0, 2), ("B", 0, 1, 2)]
    assert rows(means) == [("A", "Venta", 0, 600.0), ("B", "Alquiler", 0, 7.0)]


def test_zone_setup(tables):
    points = crm.zone_points(tables, CITIES)
    assert rows(points, "id_propiedad") == [("1",), ("2",), ("21",), ("23",), ("6",), ("8",)]
    built = build_zones(tables, AS_OF, CITIES, min_points=2, restarts=2)
    assert rows(built.summary, "ciudad", "propiedades", "clusters") == [("A", 4, 2), ("B", 2, 1)]
    stored = schemas.stored(built.table, schemas.CENTROIDS)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.schema_of(schemas.CENTROIDS)] and stored.count() == 3
    assert elbow(tables, CITIES, restarts=1).count() == 0  # too few points for a curve


def test_load(spark, tables, cents):
    rules = CleaningRules(floors={"Venta": {"Casa": 1.0}, "Alquiler": {"Casa": 1.0}})
    result = load(tables, cents, _empty_analytics(spark), AS_OF, CITIES, rules=rules)
    got = {r["id_propiedad"]: r for r in result.analytics.collect()}
    assert set(got) == {"1", "2", "21"}
    one, rent = got["1"], got["21"]
    assert one["precio_venta"] == 61000.0 and one["precio_alquiler_mes"] is None
    assert rent["precio_venta"] is None and rent["precio_alquiler_mes"] == 700.0
    assert one["precio_m2"] == 61000.0 / 200 and one["tiempo_en_mercado"] == 357
    assert (one["cluster_zona"], one["antiguedad"], one["mes_publicacion"]) == (0, 26, 1)
    assert one["ratio_activas_vendidas_zona"] == pytest.approx(1 / 3)
    assert one["diferencia_vs_promedio_zona"] == pytest.approx((305 - 600) / 600)
    assert one["fecha_venta"] == dt.date(2025, 12, 24) and one["fecha_carga"] == D(2026, 3, 1)
    assert {r[0]: r[1] for r in result.actions.collect()} == {"insertado": 3}
    assert rows(result.summary) == [("duplicado", 1), ("m2_construidos <= 0 o nulo", 1)]
    assert rows(result.detail, "id_propiedad", "motivos") == [
        ("1", "duplicado"), ("23", "m2_construidos <= 0 o nulo")]
    assert result.not_loaded.count() == 0

    again = load(tables, cents, result.analytics, "2026-03-02", CITIES, rules=rules)
    assert {r[0]: r[1] for r in again.actions.collect()} == {"actualizado": 3}
    back = {r["id_propiedad"]: r for r in again.analytics.collect()}
    assert back["1"]["fecha_carga"] == D(2026, 3, 1) and back["1"]["fecha_actualizacion"] == D(2026, 3, 2)
    stored = schemas.stored(again.analytics, schemas.ANALYTICS)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.schema_of(schemas.ANALYTICS)] and stored.count() == 3


def test_load_projection_limits(spark):
    df = spark.createDataFrame([("1", "Venta", 5.0, 51, 12.9, None)],
                               "id_propiedad string, tipo_transaccion string, precio_cierre double, "
                               "dormitorios int, mes_publicacion double, sold_date timestamp_ntz")
    got = features.load_projection(df).first()
    assert got["dormitorios"] is None and got["mes_publicacion"] == 12 and got["numero_reducciones"] == 0
    assert got["precio_venta"] == 5.0 and got["mlsid"] is None
    assert len(got) == 31


def test_deals_are_arguments(tables):
    deals = (Deal(1, 1, "Venta", "Activa"), Deal(2, 7, "Alquiler", "Alquilado"))
    assert "7" not in [r[0] for r in crm.extract_listings(tables, CITIES, deals).select("id_propiedad").collect()]


def test_checkpoint_folder_comes_from_the_session(spark):
    from zonalis.sources.session import shared_folder, staged
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    frame = staged(spark.range(3).withColumn("x", F.lit("a")), "probe")
    assert frame.inputFiles()[0].startswith(f"file://{folder}/stage/probe-")
