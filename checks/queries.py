"""Every registered query: an operator of the library on the fixture views, whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from zonalis import config
from zonalis.config import RoadCategory, RoadRule
from zonalis.functions import geo
from zonalis.functions.names import joined_names
from zonalis.functions.values import missing_to_null
from zonalis.operators import clustering, features, hull, market, model, quality, reports, roads
from zonalis.operators import upsert as up
from zonalis.operators import zones
from zonalis.plans import extract
from zonalis.plans.cleaning import Cleaned, CleaningRules, clean
from zonalis.plans.etl import derive_features, load, load_into, prepare, zone_statistics
from zonalis.plans.pricing import score_and_log, score_requests, train_models
from zonalis.plans.zone_setup import build_zones, cascade, elbow
from zonalis.sources import crm, schemas, versions
from zonalis.sources.session import shared_folder, staged
from zonalis.sources.tables import map_rows, zone_centroids

RULES = CleaningRules(subtype_to_type=fx.SUBTYPE_TO_TYPE, floors=fx.FLOORS, sigmas=1.6)
MAIN_CITIES = ("NATION_1", "NATION_2")

ROADS = (
    RoadCategory("principal", "Vías principales", "#DC2626", 5, (
        RoadRule("Red Widget"), RoadRule("old gear"),
        RoadRule("Hot Plate", True, (-18.2, -17.0), (-65.5, -64.0)))),
    RoadCategory("anillo", "Anillos", "#F59E0B", 3, (
        RoadRule("Ring", exact=False),
        RoadRule("gizmo", exact=False, lat=(-18.5, -17.5), lng=(-66.0, -64.5)))),
    RoadCategory("resto", "Otras vías", "#2563EB", 2, (
        RoadRule("small", exact=False), RoadRule("Red Widget"), RoadRule("new bolt"))),
)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- views shared by several queries ----------------------------------------

def _typed(listings: DataFrame) -> DataFrame:
    return quality.with_type_areas(quality.map_category(
        listings, "subtipo_original", "tipo_propiedad", fx.SUBTYPE_TO_TYPE, config.DEFAULT_TYPE))


def _analytics(spark: SparkSession, sf: str) -> DataFrame:
    """Listings as loaded: typed, timed, placed in a zone, priced, projected."""
    timed = features.with_market_time(_typed(fx.listings(spark, sf)), fx.AS_OF)
    zoned = zones.assign_nearest(timed, fx.centroids(spark, sf))
    priced = features.with_price_per_m2(zoned, fx.DEPARTMENT_SUBTYPES)
    return features.load_projection(priced)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return market.price_records(map_rows(_analytics(spark, sf), ordered=False))


def _cleaned(spark: SparkSession, sf: str) -> Cleaned:
    return clean(fx.listings(spark, sf), RULES)


# --- cleaning ---------------------------------------------------------------

def zone_price_by_city_type(spark, sf):
    typed = features.with_price_per_m2(_typed(fx.listings(spark, sf)), fx.DEPARTMENT_SUBTYPES)
    records = typed.withColumn("precio", F.coalesce(F.col("precio_cierre"), F.col("precio_publicacion")))
    return rounded(market.price_summary(records, ["ciudad", "tipo_propiedad"]), 6,
                   "precio_promedio", "precio_m2_promedio")


def dedup_keep_last(spark, sf):
    flagged = quality.flag_last(fx.listings(spark, sf), "id_propiedad",
                                ["sold_date", "precio_cierre"])
    return flagged.select("id_propiedad", "sold_date", "precio_cierre", "precio_publicacion",
                          "segmento", "es_ultimo")


def missing_values(spark, sf):
    dirty = spark.sql(fx.DIRTY, **fx.tables(spark, sf, "lineitem"))
    return missing_to_null(dirty)


def type_areas(spark, sf):
    return _typed(fx.listings(spark, sf)).select(
        "id_propiedad", "subtipo_original", "tipo_propiedad", "m2_construidos", "m2_terreno")


def invalid_area_rejects(spark, sf):
    net = fx.listings(spark, sf).withColumns({
        "construction_area_m": F.col("construction_area_m") - 3,
        "total_area": F.col("total_area") - 10})
    marked = _typed(net).withColumn("motivos", quality.reasons_if(
        (quality.invalid_area(), config.REASON_AREA)))
    return quality.reject_rows(marked, "motivos").drop("segmento")


def required_field_rejects(spark, sf):
    marked = _typed(fx.listings(spark, sf)).withColumn("motivos", quality.missing_field_reasons())
    return quality.reject_rows(marked, "motivos").drop("segmento")


def outlier_removal_price(spark, sf):
    typed = _typed(fx.listings(spark, sf))
    return quality.flag_outliers(
        typed, "precio_cierre", ["tipo_propiedad", "tipo_transaccion"], sigmas=1.6,
        at_most=RULES.groups).select("id_propiedad", "tipo_propiedad", "tipo_transaccion",
                                     "precio_cierre", "es_atipico")


def price_floor_rejects(spark, sf):
    marked = quality.flag_below_floor(_typed(fx.listings(spark, sf)), fx.FLOORS)
    return marked.filter("bajo_minimo").select(
        "id_propiedad", "tipo_propiedad", "tipo_transaccion", "precio_publicacion",
        quality.floor_reason().alias("motivo"))


def clean_chain(spark, sf):
    return _cleaned(spark, sf).checked.select(
        "id_propiedad", "tipo_propiedad", "tipo_transaccion", "m2_construidos", "m2_terreno",
        "precio_publicacion", "precio_cierre", "paso",
        F.array_join(F.array_sort("motivos"), ", ").alias("motivos"))


def reject_detail(spark, sf):
    return reports.reject_detail(_cleaned(spark, sf).rejects)


def reject_summary(spark, sf):
    return reports.reject_summary(_cleaned(spark, sf).rejects)


def step_counters(spark, sf):
    return _cleaned(spark, sf).counters


def load_rejects(spark, sf):
    rows = _typed(fx.listings(spark, sf)).select(
        "id_propiedad", "mlsid", "tipo_propiedad", "tipo_transaccion", "ciudad")
    marked = quality.load_violations(rows, ["id_propiedad", "mlsid"], "id_propiedad")
    return marked.groupBy(F.array_join("violaciones", ", ").alias("violaciones")).agg(
        F.count("*").alias("filas"))


# --- sources and features ---------------------------------------------------

def star_extract(spark, sf):
    return crm.extract_listings(fx.crm(spark, sf), fx.CITIES, years=fx.YEARS)


def extract_counts(spark, sf):
    raw = crm.extract_listings(fx.crm(spark, sf), fx.CITIES, years=fx.YEARS)
    return reports.group_counts(raw, ["tipo_transaccion"], "ciudad")


def market_time(spark, sf):
    texts = fx.listings(spark, sf).withColumns({
        "year_construction": F.col("year_construction").cast("string"),
        "contract_end_date": F.coalesce(F.col("contract_end_date").cast("string"), F.lit("sin fecha"))})
    return features.with_market_time(texts, fx.AS_OF).select(
        "id_propiedad", "year_construction", "antiguedad", "tiempo_en_mercado",
        "mes_publicacion", "anio_publicacion", "date_of_listing", "sold_date")


def load_projection(spark, sf):
    timed = features.with_market_time(_typed(fx.listings(spark, sf)), fx.AS_OF)
    zoned = zones.assign_nearest(timed, fx.centroids(spark, sf))
    priced = features.with_price_per_m2(zoned, fx.DEPARTMENT_SUBTYPES)
    limits = {**config.INTEGER_LIMITS, "dormitorios": (1, 8), "tiempo_en_mercado": (0, 1500)}
    return features.load_projection(priced, limits=limits).withColumn(
        "fecha_venta", F.col("fecha_venta").cast("string"))


def training_split(spark, sf):
    rows = features.training_rows(_typed(fx.listings(spark, sf)))
    return rows.groupBy("tipo_transaccion").agg(
        F.count("*").alias("filas"), F.count("precio_venta").alias("ventas"),
        F.count("precio_alquiler_mes").alias("alquileres"),
        F.max("fecha_venta").alias("ultima_venta"))


# --- zones ------------------------------------------------------------------

def nearest_centroid(spark, sf):
    listings = fx.listings(spark, sf).select("id_propiedad", "ciudad", "latitude", "longitude")
    return zones.assign_nearest(listings, fx.centroids(spark, sf))


def nearest_centroid_global(spark, sf):
    listings = fx.listings(spark, sf).select("id_propiedad", "ciudad", "latitude", "longitude")
    return zones.assign_nearest(listings, fx.centroids(spark, sf), by=())


def _statistics(spark, sf):
    tables = fx.crm(spark, sf)
    return zone_statistics(crm.status_points(tables), crm.recent_prices(tables, fx.AS_OF, months=24),
                           fx.centroids(spark, sf))


def zone_active_closed_ratio(spark, sf):
    return _statistics(spark, sf)[0]


def zone_mean_price_m2(spark, sf):
    return rounded(_statistics(spark, sf)[1], 6, "promedio_m2_zona")


def zone_feature_enrich(spark, sf):
    ratios, means = _statistics(spark, sf)
    enriched = derive_features(fx.listings(spark, sf), fx.centroids(spark, sf), ratios, means,
                               fx.AS_OF, department_subtypes=fx.DEPARTMENT_SUBTYPES)
    return rounded(enriched, 6, "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona").select(
        "id_propiedad", "ciudad", "tipo_transaccion", "cluster_zona", "precio_m2",
        "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona")


def _feature_means(spark, sf, by_city):
    ratios, means = _statistics(spark, sf)
    enriched = derive_features(fx.listings(spark, sf), fx.centroids(spark, sf), ratios, means,
                               fx.AS_OF, department_subtypes=fx.DEPARTMENT_SUBTYPES)
    return rounded(zones.zone_feature_means(enriched, by_city), 6,
                   "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona")


def zone_feature_pooled(spark, sf):
    return _feature_means(spark, sf, by_city=False)


def zone_feature_by_city(spark, sf):
    return _feature_means(spark, sf, by_city=True)


def zones_k1(spark, sf):
    points = crm.zone_points(fx.crm(spark, sf), fx.CITIES, years=fx.YEARS)
    single = clustering.mean_places(points)
    summary = clustering.zone_summary(single, crm.city_frame(spark, fx.CITIES))
    return single.join(summary, "ciudad")


def zones_lloyd_2iter(spark, sf):
    spots = staged(clustering.places(fx.listings(spark, sf)), "places")
    moved = clustering.lloyd(spots, fx.centroids(spark, sf), iterations=2, tolerance=0.0)
    return clustering.with_members(spots, moved)


def zones_kmeans(spark, sf):
    return build_zones(fx.crm(spark, sf), fx.AS_OF, fx.CITIES, fx.YEARS).table


def zone_totals(spark, sf):
    """Zones by city after the whole run: their number and points, and the mean of all points, which K-means keeps."""
    table = build_zones(fx.crm(spark, sf), fx.AS_OF, fx.CITIES, fx.YEARS).table
    n = F.sum("total_propiedades")
    mean = {c: F.round(F.sum(F.col(c).cast("double") * F.col("total_propiedades")) / n, 3)
            for c in ("centroide_lat", "centroide_lng")}
    return table.groupBy("ciudad").agg(
        F.count("*").alias("zonas"), n.alias("propiedades"), F.min("n_clusters_ciudad").alias("n_clusters_ciudad"),
        *(v.alias(c) for c, v in mean.items()))


def elbow_table(spark, sf):
    return elbow(fx.crm(spark, sf), fx.CITIES, fx.YEARS)


def zone_means(spark, sf):
    """Of every zone after the whole run: whether it lies at the mean of its members and counts them all."""
    tables = fx.crm(spark, sf)
    table = build_zones(tables, fx.AS_OF, fx.CITIES, fx.YEARS).table
    points = crm.zone_points(tables, fx.CITIES, years=fx.YEARS)
    members = zones.assign_nearest(points, table, out="cluster_id").groupBy("ciudad", "cluster_id").agg(
        F.count("*").alias("n"), F.avg("latitude").alias("lat"), F.avg("longitude").alias("lng"))
    # The last step of a run moves no centroid further than a ten-thousandth of a degree.
    near = ((F.abs(F.col("centroide_lat") - F.col("lat")) <= 0.001)
            & (F.abs(F.col("centroide_lng") - F.col("lng")) <= 0.001))
    return table.join(members, ["ciudad", "cluster_id"], "left").select(
        "ciudad", "cluster_id", F.coalesce(near, F.lit(False)).alias("es_media"),
        F.coalesce(F.col("total_propiedades") == F.col("n"), F.lit(False)).alias("cuenta_todas"))


def elbow_facts(spark, sf):
    """Of every line of the elbow table: whether its inertia is that of its zones, summed again by zone and point."""
    points = crm.zone_points(fx.crm(spark, sf), [c for c in fx.CITIES if c.tier == 1], years=fx.YEARS)
    table, centroids = clustering.elbow_runs(points)
    at = points.select("ciudad", "latitude", "longitude", F.monotonically_increasing_id().alias("punto"))
    nearest = staged(at, "points").join(centroids, "ciudad").groupBy("ciudad", "k", "punto").agg(F.min(
        F.pow(F.col("latitude") - F.col("centroide_lat"), 2)
        + F.pow(F.col("longitude") - F.col("centroide_lng"), 2)).alias("d"))
    again = nearest.groupBy("ciudad", "k").agg(F.sum("d").alias("suma"))
    around = points.groupBy("ciudad").agg((F.var_pop("latitude") * F.count("*")
                                           + F.var_pop("longitude") * F.count("*")).alias("total"))
    return table.join(again, ["ciudad", "k"]).join(around, "ciudad").select(
        "ciudad", "k", (F.abs(F.col("inercia") - F.col("suma")) <= 1e-6 * F.col("suma")).alias("suma_coincide"),
        (F.col("inercia") < F.col("total")).alias("menor_que_una_zona"))


def fk_violations(spark, sf):
    listings = fx.listings(spark, sf).select("id_propiedad", "ciudad", "latitude", "longitude")
    placed = zones.assign_nearest(listings, fx.centroids(spark, sf))
    remaining = fx.centroids(spark, sf).filter(F.col("cluster_id") != 3)
    return up.reference_violations(placed, remaining).select("id_propiedad", "ciudad", "cluster_zona")


def fk_set_null(spark, sf):
    listings = fx.listings(spark, sf).select("id_propiedad", "ciudad", "latitude", "longitude")
    placed = zones.assign_nearest(listings, fx.centroids(spark, sf))
    remaining = fx.centroids(spark, sf).filter(F.col("cluster_id") != 3)
    return up.set_null_without_parent(placed, remaining).groupBy("ciudad", "cluster_zona").agg(
        F.count("*").alias("filas"))


def replace_city(spark, sf):
    current = fx.centroids(spark, sf)
    points = crm.zone_points(fx.crm(spark, sf), fx.CITIES, years=fx.YEARS)
    renewed = clustering.mean_places(points.filter(F.col("ciudad").isin(*MAIN_CITIES)))
    return zone_centroids(up.replace_by(current, renewed))


def keyed_upsert(spark, sf):
    listings = quality.keep_last(fx.listings(spark, sf), "id_propiedad",
                                 ["sold_date", "precio_cierre"])
    columns = ["id_propiedad", "ciudad", "tipo_transaccion", "precio_publicacion", "status",
               "segmento", "date_of_listing"]
    # The table so far holds the listings up to 1999, the new load those from 1999 on.
    target = listings.filter("date_of_listing < timestamp_ntz'2000-01-01'").select(*columns)
    incoming = (listings.filter("date_of_listing >= timestamp_ntz'1999-01-01'").select(*columns)
                .withColumns({"precio_publicacion": F.col("precio_publicacion") * 0.9,
                              "segmento": F.lit("nuevo"),
                              "status": F.when(F.col("status") != "Otra", F.col("status"))}))
    return up.merge(target, incoming)


# --- market -----------------------------------------------------------------

def price_records(spark, sf):
    return _records(spark, sf)


def zone_price_summary(spark, sf):
    return rounded(market.zone_price_summary(_records(spark, sf), fx.centroids(spark, sf)), 6,
                   "precio_promedio", "precio_m2_promedio")


def facet_summary(spark, sf):
    chosen = market.facet_filter(_records(spark, sf), {
        "transaccion": "Venta", "tipo": "todos", "anio": 1999, "ciudad": None})
    return rounded(market.price_summary(chosen, ["tipo"]), 6,
                   "precio_promedio", "precio_m2_promedio")


def facet_values(spark, sf):
    return market.facet_values(map_rows(_analytics(spark, sf), ordered=False), [
        "tipo_propiedad", "tipo_transaccion", "anio_venta", "ciudad"], ["anio_venta"])


def map_extent(spark, sf):
    return rounded(market.extent(map_rows(_analytics(spark, sf), ordered=False)), 6,
                   "lat_centro", "lng_centro")


def minmax_weight(spark, sf):
    return rounded(market.price_weight(_records(spark, sf), "precio"), 9, "peso").select(
        "lat", "lng", "precio", "peso")


def activity_grid(spark, sf):
    return market.activity_grid(_records(spark, sf), 0.25)


def zone_hull(spark, sf):
    listings = fx.listings(spark, sf).select("ciudad", "latitude", "longitude")
    placed = zones.assign_nearest(listings, fx.centroids(spark, sf))
    return hull.group_hulls(placed.filter(F.col("cluster_zona").isNotNull()),
                            ["ciudad", "cluster_zona"], "longitude", "latitude")


# --- roads ------------------------------------------------------------------

def road_rule_match(spark, sf):
    return roads.classify(fx.segments(spark, sf), ROADS).select(
        "segment_id", "regla", "categoria", "label", "color", "weight", "nombre_via",
        joined_names(F.col("nombres")).alias("nombres"))


def road_all_matches(spark, sf):
    matches = roads.match_rules(roads.with_names(fx.segments(spark, sf)), ROADS)
    centre = geo.line_centroid(F.col("geom"))
    return matches.select("segment_id", "regla", F.round(centre["lng"], 6).alias("lng"),
                          F.round(centre["lat"], 6).alias("lat"))


def road_rule_hits(spark, sf):
    categories = (*ROADS, RoadCategory("ninguna", "Ninguna", "#000000", 1, (RoadRule("no such way"),)))
    matches = roads.match_rules(roads.with_names(fx.segments(spark, sf)), categories)
    return roads.rule_hits(matches, categories)


def road_summary(spark, sf):
    return roads.road_summary(roads.classify(fx.segments(spark, sf), ROADS))


def segment_bounds(spark, sf):
    return roads.with_bounds(fx.segments(spark, sf)).drop("geom", "name")


def segment_name_count(spark, sf):
    return roads.count_of_name(roads.with_names(fx.segments(spark, sf)), "Blue Ring")


# --- price models -----------------------------------------------------------

URBAN_LIMIT = 60.0


def _sold(spark, sf):
    timed = features.with_market_time(_typed(fx.listings(spark, sf)), fx.AS_OF)
    zoned = zones.assign_nearest(timed, fx.centroids(spark, sf))
    priced = features.with_price_per_m2(zoned, fx.DEPARTMENT_SUBTYPES)
    # The zone features of the fixture: activity by lines, difference by price.
    return features.training_rows(priced).withColumns({
        "ratio_activas_vendidas_zona": F.col("estacionamientos") * 2.0,
        "diferencia_vs_promedio_zona": F.col("precio_m2") / 1000 - 2})


def _training(spark, sf):
    return model.training_frame(_sold(spark, sf), limit=URBAN_LIMIT)


def impute_clamp(spark, sf):
    return model.impute_and_clamp(staged(_training(spark, sf), "training")).select(
        "id_propiedad", "tipo_modelo", *model.ALL_FEATURES)


def regression_metrics(spark, sf):
    listings = _typed(fx.listings(spark, sf)).filter(F.col("precio_cierre").isNotNull())
    return rounded(model.regression_metrics(listings, ["tipo_propiedad"], "precio_cierre",
                                            "precio_publicacion"), 6, "mae", "rmse", "mape")


def model_type_counts(spark, sf):
    return reports.group_counts(_training(spark, sf), ["tipo_modelo"])


def _scored(spark, sf):
    """Every request scored by models at the settings of the job."""
    sold = staged(_sold(spark, sf), "sold")
    trained = train_models(sold, fx.AS_OF, URBAN_LIMIT)
    requests = _typed(fx.listings(spark, sf)).withColumn(
        "mes_publicacion", F.month("date_of_listing"))
    return score_requests(requests, trained.models, fx.centroids(spark, sf), sold,
                          urban_limit=URBAN_LIMIT)


def price_model_prices(spark, sf):
    return _scored(spark, sf)


def prediction_log(spark, sf):
    """The log of all requests; its id is random and left out."""
    sold = staged(_sold(spark, sf), "sold")
    trained = train_models(sold, fx.AS_OF, URBAN_LIMIT)
    requests = _typed(fx.listings(spark, sf)).withColumn("mes_publicacion", F.month("date_of_listing"))
    done = score_and_log(requests, trained.models, fx.centroids(spark, sf), sold, fx.AS_OF, urban_limit=URBAN_LIMIT)
    return schemas.stored(done.log, schemas.PREDICTION_LOG).drop("id_prediccion")


def price_model_score(spark, sf):
    scored = _scored(spark, sf)
    # Of the prices SQL can tell how they hang together, not what they are; a cent is lost to rounding.
    total = F.col("precio_total")
    band = ((F.abs(F.col("rango_min") - total * 0.88) <= 0.02) & (F.abs(F.col("rango_max") - total * 1.12) <= 0.02))
    land = F.abs(total - F.col("precio_m2") * F.col("m2")) <= 0.01 + 0.01 * F.col("m2")
    return scored.select("id_propiedad", "tipo_modelo", "cluster_zona", "m2", "moneda", "error",
                         total.isNotNull().alias("con_precio"), band.alias("banda_del_12"),
                         land.alias("total_por_m2"))


def _fresh_folder(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


LOAD_SUBTYPES = {"SUB_AFRICA": "Casa", "SUB_AMERICA": "Departamento", "SUB_ASIA": "Terreno"}
LOAD_OPTIONS = {"years": fx.YEARS, "department_subtypes": ["SUB_AMERICA"],
                "rules": CleaningRules(subtype_to_type=LOAD_SUBTYPES, sigmas=1.6, floors=fx.FLOORS)}


def etl_update(spark, sf):
    """The load into a stored table that holds a third of the properties with older values, and one that does not arrive."""
    tables, cents = fx.crm(spark, sf), fx.centroids(spark, sf)
    first = prepare(tables, cents, fx.AS_OF, fx.CITIES, **LOAD_OPTIONS).rows
    known = first.filter(F.col("id_propiedad").cast("long") % 3 == 0)
    own = {"id_propiedad": "-1", "mlsid": "V", "tipo_propiedad": "Casa", "tipo_transaccion": "Venta", "ciudad": "otra"}
    stays = spark.range(1).select(*[F.lit(own.get(c)).cast(t).alias(c) for c, t in known.dtypes])
    older = known.withColumns({"precio_publicacion": F.col("precio_publicacion") / 2, "status": F.lit("Activa"),
                               "cluster_zona": F.lit(None).cast("int"), "segmento": F.lit("antes"),
                               "mlsid": F.concat(F.lit("V"), "mlsid")}).unionByName(stays)
    stamps = {c: F.lit("2001-01-01").cast("timestamp_ntz") for c in ("fecha_carga", "fecha_actualizacion")}
    path = _fresh_folder(spark, "analytics")
    versions.write_buckets(older.withColumns(stamps), path, config.ANALYTICS_KEY, 16)
    load_into(tables, cents, path, fx.AS_OF, fx.CITIES, **LOAD_OPTIONS)
    return versions.read(spark, path).select(
        "id_propiedad", "mlsid", "ciudad", "tipo_transaccion", "cluster_zona", "segmento", "precio_publicacion",
        "precio_venta", "precio_alquiler_mes", "precio_m2", "tiempo_en_mercado", "numero_reducciones", "status",
        F.round("ratio_activas_vendidas_zona", 6).alias("ratio_activas_vendidas_zona"),
        F.round("diferencia_vs_promedio_zona", 6).alias("diferencia_vs_promedio_zona"),
        (F.col("fecha_carga") > F.lit("2001-06-01").cast("timestamp_ntz")).alias("es_nueva"),
        (F.col("fecha_actualizacion") > F.lit("2001-06-01").cast("timestamp_ntz")).alias("llegada"))


def zone_cascade(spark, sf):
    """Stored properties after zone 3 of every city is gone and zone 1 of one city has moved."""
    placed = zones.assign_nearest(
        fx.listings(spark, sf).select("id_propiedad", "ciudad", "latitude", "longitude"), fx.centroids(spark, sf))
    path = _fresh_folder(spark, "placed")
    versions.write_buckets(placed, path, "id_propiedad", 16)
    before = fx.centroids(spark, sf)
    moves = (F.col("cluster_id") == 1) & (F.col("ciudad") == "NATION_1")
    after = before.filter("cluster_id <> 3").withColumn(
        "centroide_lat", F.when(moves, F.col("centroide_lat") + 0.5).otherwise(F.col("centroide_lat")))
    cascade(spark, path, up.zone_changes(before, after), "id_propiedad")
    return versions.read(spark, path)


BROKEN_CITY = "NATION_2"


def extract_parts(spark, sf):
    """The extract part by part while one city cannot be read: rows per part, and the error of the parts that failed."""
    read = extract.listing_part(fx.crm(spark, sf), fx.YEARS, fx.CITIES)

    def part(city, deal):
        if city.name == BROKEN_CITY:
            raise OSError("sin conexión")
        return read(city, deal)

    got = extract.extract_parts(spark, part, _fresh_folder(spark, "extract"), fx.CITIES)
    return (got.data.groupBy("ciudad", "tipo_transaccion").agg(F.count("*").alias("filas"))
            .withColumn("error", F.lit(None).cast("string"))
            .unionByName(got.errors.withColumn("filas", F.lit(None).cast("long"))))


def etl_load(spark, sf):
    tables = fx.crm(spark, sf)
    subtypes = {"SUB_AFRICA": "Casa", "SUB_AMERICA": "Departamento", "SUB_ASIA": "Terreno"}
    rules = CleaningRules(subtype_to_type=subtypes, sigmas=1.6, floors=fx.FLOORS)
    empty = _empty_analytics(spark)
    result = load(tables, fx.centroids(spark, sf), empty, fx.AS_OF, fx.CITIES, years=fx.YEARS,
                  rules=rules, department_subtypes=["SUB_AMERICA"])
    return rounded(result.analytics, 6, "ratio_activas_vendidas_zona",
                   "diferencia_vs_promedio_zona").drop("fecha_carga", "fecha_actualizacion").withColumn(
        "fecha_venta", F.col("fecha_venta").cast("string"))


def _empty_analytics(spark):
    types = {**{c: "string" for c in config.ANALYTICS_COLUMNS},
             **{c: "double" for c in ("latitude", "longitude", "m2_construidos", "m2_terreno",
                                      "precio_publicacion", "precio_venta", "precio_alquiler_mes",
                                      "precio_m2", "diferencia_vs_promedio_zona",
                                      "ratio_activas_vendidas_zona")},
             **{c: "int" for c in config.INTEGER_LIMITS}, "fecha_venta": "date"}
    ddl = ", ".join(f"{c} {types[c]}" for c in config.ANALYTICS_COLUMNS)
    return spark.createDataFrame(
        [], f"{ddl}, pais string, fecha_carga timestamp_ntz, fecha_actualizacion timestamp_ntz")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "zone_price_by_city_type": zone_price_by_city_type,
    "dedup_keep_last": dedup_keep_last,
    "missing_to_null": missing_values,
    "type_areas": type_areas,
    "invalid_area_rejects": invalid_area_rejects,
    "required_field_rejects": required_field_rejects,
    "outlier_removal_price": outlier_removal_price,
    "price_floor_rejects": price_floor_rejects,
    "clean_chain": clean_chain,
    "reject_detail": reject_detail,
    "reject_summary": reject_summary,
    "step_counters": step_counters,
    "load_rejects": load_rejects,
    "star_extract": star_extract,
    "extract_counts": extract_counts,
    "market_time": market_time,
    "load_projection": load_projection,
    "training_split": training_split,
    "nearest_centroid": nearest_centroid,
    "nearest_centroid_global": nearest_centroid_global,
    "zone_active_closed_ratio": zone_active_closed_ratio,
    "zone_mean_price_m2": zone_mean_price_m2,
    "zone_feature_enrich": zone_feature_enrich,
    "zone_feature_pooled": zone_feature_pooled,
    "zone_feature_by_city": zone_feature_by_city,
    "zones_k1": zones_k1,
    "zones_lloyd_2iter": zones_lloyd_2iter,
    "zones_kmeans": zones_kmeans,
    "zone_totals": zone_totals,
    "elbow_table": elbow_table,
    "zone_means": zone_means,
    "elbow_facts": elbow_facts,
    "fk_violations": fk_violations,
    "fk_set_null": fk_set_null,
    "replace_city": replace_city,
    "keyed_upsert": keyed_upsert,
    "price_records": price_records,
    "zone_price_summary": zone_price_summary,
    "facet_summary": facet_summary,
    "facet_values": facet_values,
    "map_extent": map_extent,
    "minmax_weight": minmax_weight,
    "activity_grid": activity_grid,
    "zone_hull": zone_hull,
    "road_rule_match": road_rule_match,
    "road_all_matches": road_all_matches,
    "road_summary": road_summary,
    "road_rule_hits": road_rule_hits,
    "segment_bounds": segment_bounds,
    "segment_name_count": segment_name_count,
    "impute_clamp": impute_clamp,
    "regression_metrics": regression_metrics,
    "model_type_counts": model_type_counts,
    "price_model_score": price_model_score,
    "price_model_prices": price_model_prices,
    "prediction_log": prediction_log,
    "etl_load": etl_load,
    "etl_update": etl_update,
    "zone_cascade": zone_cascade,
    "extract_parts": extract_parts,
}
