"""The registered queries as SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from checks import fixtures as fx

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _sql(text: str) -> str:
    return text.format(**{t: t for t in _TABLES})


VIEWS: dict[str, str] = {
    "fx_listings": _sql(fx.LISTINGS),
    "fx_centroids": _sql(fx.CENTROIDS),
    **{f"crm_{name}": _sql(sql) for name, sql in fx.CRM.items()},
}

VIEWS["tipos"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{t}')" for s, t in fx.SUBTYPE_TO_TYPE.items()) + ") v(sub, tipo)"
VIEWS["minimos"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{d}', '{t}', {v}e0)" for d, kinds in fx.FLOORS.items() for t, v in kinds.items()
) + ") v(trans, tipo, minimo)"
VIEWS["ciudades"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{c.name}', {c.tier}, {c.n_clusters}, {c.lat[0]}e0, {c.lat[1]}e0, {c.lng[0]}e0, {c.lng[1]}e0)"
    for c in fx.CITIES) + ") v(ciudad, tier, k, lat0, lat1, lng0, lng1)"

# Type and areas of every listing.
VIEWS["typed"] = """
SELECT l.*, coalesce(tipo, 'Otro') AS tipo_propiedad,
       CASE WHEN tipo IN ('Casa', 'Departamento') THEN construction_area_m
            WHEN tipo = 'Terreno' THEN 0e0 END AS m2_construidos,
       CASE WHEN tipo = 'Casa' THEN land_m2
            WHEN tipo = 'Departamento' AND land_m2 > 0 THEN land_m2
            WHEN tipo = 'Terreno' THEN total_area END AS m2_terreno
FROM fx_listings l LEFT JOIN tipos ON subtipo_original = sub"""

VIEWS["priced"] = """
SELECT *, CASE WHEN coalesce(nullif(precio_cierre, 0), precio_publicacion) > 0
                AND (CASE WHEN subtipo_original = 'MEDIUM' THEN construction_area_m ELSE total_area END) > 0
               THEN coalesce(nullif(precio_cierre, 0), precio_publicacion)
                    / (CASE WHEN subtipo_original = 'MEDIUM' THEN construction_area_m ELSE total_area END)
          END AS precio_m2
FROM typed"""

VIEWS["timed"] = """
SELECT *, cast(greatest(2001 - year_construction, 0) AS int) AS antiguedad,
       greatest(date_sub('day', date_of_listing, coalesce(sold_date, cancellation_date,
                contract_end_date, timestamp '2001-12-01')), 0) AS tiempo_en_mercado,
       cast(month(date_of_listing) AS int) AS mes_publicacion,
       cast(year(date_of_listing) AS int) AS anio_publicacion
FROM priced"""


def _nearest(points: str, alias: str = "cluster_zona", by_city: bool = True,
             key: str = "lat, lng") -> str:
    """Nearest centroid of the distinct places of a view with ciudad, latitude, longitude."""
    same = "p.ciudad = c.ciudad" if by_city else "true"
    return f"""
SELECT ciudad, latitude, longitude, cluster_id AS {alias} FROM (
    SELECT p.ciudad, p.latitude, p.longitude, c.cluster_id,
           row_number() OVER (PARTITION BY p.ciudad, p.latitude, p.longitude ORDER BY
               (p.latitude - centroide_lat) * (p.latitude - centroide_lat)
             + (p.longitude - centroide_lng) * (p.longitude - centroide_lng), c.cluster_id) AS rn
    FROM (SELECT DISTINCT ciudad, latitude, longitude FROM {points}
          WHERE latitude IS NOT NULL AND longitude IS NOT NULL) p
    JOIN fx_centroids c ON {same})
WHERE rn = 1"""


VIEWS["places"] = _nearest("fx_listings")
VIEWS["places_global"] = _nearest("fx_listings", by_city=False)
VIEWS["placed"] = """
SELECT t.*, z.cluster_zona FROM timed t
LEFT JOIN places z ON t.ciudad = z.ciudad AND t.latitude = z.latitude AND t.longitude = z.longitude"""

_PROJECTION = """
SELECT id_propiedad, mlsid, tipo_propiedad, subtipo_original, categoria_propiedad,
       estado_propiedad, segmento, tipo_transaccion, latitude, longitude, cluster_zona, ciudad,
       m2_construidos, m2_terreno,
       CASE WHEN dormitorios BETWEEN {dorm} THEN dormitorios END AS dormitorios,
       banos, estacionamientos, antiguedad, precio_publicacion,
       CASE WHEN tipo_transaccion = 'Venta' THEN precio_cierre END AS precio_venta,
       CASE WHEN tipo_transaccion <> 'Venta' THEN precio_cierre END AS precio_alquiler_mes,
       precio_m2,
       cast(CASE WHEN tiempo_en_mercado BETWEEN {days} THEN tiempo_en_mercado END AS int)
           AS tiempo_en_mercado,
       cast(0 AS int) AS numero_reducciones,
       cast(NULL AS varchar) AS diferencia_vs_promedio_zona,
       cast(NULL AS varchar) AS ratio_activas_vendidas_zona,
       mes_publicacion, anio_publicacion, cast(sold_date AS date) AS fecha_venta,
       status, transaction_type
FROM placed"""
VIEWS["analytics"] = _PROJECTION.format(dorm="0 AND 50", days="0 AND 2147483647")

VIEWS["records"] = """
SELECT latitude AS lat, longitude AS lng, coalesce(mlsid, 'N/A') AS mlsid,
       coalesce(nullif(precio_venta, 0), nullif(precio_alquiler_mes, 0)) AS precio,
       coalesce(precio_m2, 0e0) AS precio_m2, tipo_propiedad AS tipo,
       tipo_transaccion AS transaccion, ciudad, coalesce(cluster_zona, -1) AS cluster,
       cast(coalesce(year(fecha_venta), 0) AS int) AS anio,
       coalesce(m2_construidos, 0e0) AS m2_construidos, coalesce(m2_terreno, 0e0) AS m2_terreno,
       coalesce(dormitorios, 0) AS dormitorios, coalesce(banos, 0) AS banos
FROM analytics
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND coalesce(nullif(precio_venta, 0), nullif(precio_alquiler_mes, 0)) IS NOT NULL"""

# --- the cleaning chain, one view per step -----------------------------------

_ORDER = """sold_date DESC NULLS LAST, precio_cierre DESC NULLS LAST, mlsid DESC NULLS LAST,
    ciudad DESC, pais DESC, tipo_transaccion DESC, transaction_type DESC, subtipo_original DESC,
    segmento DESC, categoria_propiedad DESC, estado_propiedad DESC, construction_area_m DESC,
    land_m2 DESC NULLS LAST, total_area DESC, dormitorios DESC, banos DESC, estacionamientos DESC,
    year_construction DESC, precio_publicacion DESC, date_of_listing DESC,
    cancellation_date DESC NULLS LAST, contract_end_date DESC NULLS LAST, status DESC,
    latitude DESC NULLS LAST, longitude DESC NULLS LAST"""
_FIELDS = """
    CASE WHEN tipo_propiedad IN ('Casa', 'Departamento') AND coalesce(construction_area_m, 0) = 0
         THEN 'm2_construidos nulo o 0' END,
    CASE WHEN tipo_propiedad = 'Casa' AND coalesce(land_m2, 0) = 0 THEN 'm2_terreno nulo o 0' END,
    CASE WHEN tipo_propiedad IN ('Casa', 'Departamento') AND coalesce(dormitorios, 0) = 0
         THEN 'dormitorios nulo o 0' END,
    CASE WHEN tipo_propiedad IN ('Casa', 'Departamento') AND coalesce(banos, 0) = 0
         THEN 'baños nulo o 0' END,
    CASE WHEN tipo_propiedad = 'Terreno' AND coalesce(total_area, 0) = 0 THEN 'm2_total nulo o 0' END"""


def _cleaning(p: str, typed: str, order: str) -> dict[str, str]:
    """The cleaning steps over a typed view; the names of the views begin with ``p``."""

    def spread(value: str, step: str, flag: str) -> str:
        return f"""
SELECT tipo_propiedad, tipo_transaccion, count({value}) AS n, avg({value}) AS m,
       stddev_samp({value}) AS s
FROM {step} WHERE {flag} = 'conservado' GROUP BY 1, 2"""

    def outliers(value: str, step: str, before: str, stats: str, name: str, flag: str) -> str:
        return f"""
SELECT a.*, CASE WHEN {before} = 'conservado' AND b.n >= 4 AND b.s > 0
                  AND ({value} < b.m - 1.6e0 * b.s OR {value} > b.m + 1.6e0 * b.s)
                 THEN '{name}' ELSE {before} END AS {flag}
FROM {step} a LEFT JOIN {stats} b
  ON a.tipo_propiedad = b.tipo_propiedad AND a.tipo_transaccion = b.tipo_transaccion"""

    return {
        f"{p}ranked": f"""
SELECT *, row_number() OVER (PARTITION BY id_propiedad ORDER BY {order}) AS rn FROM {typed}""",
        f"{p}step1": f"""
SELECT *, [x FOR x IN [{_FIELDS}] IF x IS NOT NULL] AS campos FROM {p}ranked""",
        f"{p}step2": f"""
SELECT *, CASE WHEN rn > 1 THEN 'duplicado'
               WHEN latitude IS NULL OR longitude IS NULL THEN 'sin_coordenadas'
               WHEN (tipo_propiedad IN ('Casa', 'Departamento') AND m2_construidos <= 0)
                 OR (tipo_propiedad = 'Terreno' AND m2_terreno <= 0) THEN 'm2_invalido'
               WHEN len(campos) > 0 THEN 'campos_requeridos' ELSE 'conservado' END AS p2
FROM {p}step1""",
        f"{p}price_spread": spread("precio_cierre", f"{p}step2", "p2"),
        f"{p}step3": outliers("precio_cierre", f"{p}step2", "p2", f"{p}price_spread",
                              "atipico_precio", "p3"),
        f"{p}area_spread": spread("m2_construidos", f"{p}step3", "p3"),
        f"{p}step4": outliers("m2_construidos", f"{p}step3", "p3", f"{p}area_spread",
                              "atipico_m2", "p4"),
        f"{p}step5": f"""
SELECT a.*, CASE WHEN p4 = 'conservado' AND precio_publicacion < minimo THEN 'precio_minimo'
                 ELSE p4 END AS paso
FROM {p}step4 a LEFT JOIN minimos b ON tipo_transaccion = trans AND tipo_propiedad = b.tipo""",
        f"{p}cleaned": f"""
SELECT *, CASE paso WHEN 'duplicado' THEN ['duplicado']
                    WHEN 'm2_invalido' THEN ['m2_construidos <= 0 o nulo']
                    WHEN 'campos_requeridos' THEN campos
                    WHEN 'atipico_precio' THEN ['outlier precio_cierre']
                    WHEN 'atipico_m2' THEN ['outlier m2_construidos']
                    WHEN 'precio_minimo' THEN [CASE WHEN tipo_transaccion = 'Venta'
                        THEN 'precio menor mínimo venta' ELSE 'precio menor mínimo alquiler' END]
                    ELSE [] END AS motivos
FROM {p}step5""",
    }


VIEWS.update(_cleaning("", "typed", _ORDER))
VIEWS["rejected"] = "SELECT * EXCLUDE (motivos), unnest(motivos) AS motivo FROM cleaned"

# --- the listings database ----------------------------------------------------

VIEWS["cajas"] = """
SELECT ciudad, min(centroide_lat) - 0.2e0 AS lat0, max(centroide_lat) + 0.2e0 AS lat1,
       min(centroide_lng) - 0.2e0 AS lng0, max(centroide_lng) + 0.2e0 AS lng1
FROM fx_centroids GROUP BY 1"""
VIEWS["estado"] = """
SELECT ci.name AS ciudad, CASE WHEN l.transaction_type_id = 1 THEN 'Venta' ELSE 'Alquiler' END
           AS tipo_transaccion, loc.latitude, loc.longitude, sl.name AS status
FROM crm_listings l
JOIN crm_listing_transaction_types ltt ON l.transaction_type_id = ltt.id
JOIN crm_status_listings sl ON l.status_listing_id = sl.id
JOIN crm_locations loc ON loc.listing_id = l.id
JOIN crm_cities ci ON loc.city_id = ci.id
JOIN cajas b ON ci.name = b.ciudad
WHERE (ltt.id = 1 AND sl.name IN ('Activa', 'Venta Aceptada/Vendida')
    OR ltt.id = 2 AND sl.name IN ('Activa', 'Alquilado'))
  AND loc.latitude BETWEEN lat0 AND lat1 AND loc.longitude BETWEEN lng0 AND lng1"""
VIEWS["estado_zonas"] = _nearest("estado")
VIEWS["ratios"] = """
SELECT ciudad, tipo_transaccion, cluster_zona,
       count(*) FILTER (status = 'Activa') AS activas,
       count(*) FILTER (status <> 'Activa') AS cerradas,
       count(*) FILTER (status = 'Activa') * 1e0
           / greatest(count(*) FILTER (status <> 'Activa'), 1) AS ratio_activas_vendidas_zona
FROM estado JOIN estado_zonas USING (ciudad, latitude, longitude) GROUP BY 1, 2, 3"""
_PRICES = """
SELECT ci.name AS ciudad, d.tipo_transaccion, loc.latitude, loc.longitude,
       d.price / li.construction_area_m AS precio_m2
FROM (SELECT l.id, 'Venta' AS tipo_transaccion, lp.amount AS price
      FROM crm_listings l JOIN crm_listing_prices lp ON lp.listing_id = l.id
      JOIN crm_transactions t ON t.listing_id = l.id AND t.transaction_type_id = 1
           AND t.transaction_status_id IN (2, 5)
      WHERE l.transaction_type_id = 1 AND t.sold_date >= timestamp '{since}' AND lp.amount > 0
      UNION ALL
      SELECT l.id, 'Alquiler', t.current_listing_price
      FROM crm_listings l
      JOIN crm_transactions t ON t.listing_id = l.id AND t.transaction_type_id = 2
           AND t.transaction_status_id IN (2, 5)
      WHERE l.transaction_type_id = 2 AND l.status_listing_id = 7
        AND t.sold_date >= timestamp '{since}' AND t.current_listing_price > 0) d
JOIN crm_listings_information li ON li.listing_id = d.id
JOIN crm_locations loc ON loc.listing_id = d.id
JOIN crm_cities ci ON loc.city_id = ci.id
JOIN cajas b ON ci.name = b.ciudad
WHERE li.construction_area_m > 0
  AND loc.latitude BETWEEN lat0 AND lat1 AND loc.longitude BETWEEN lng0 AND lng1"""
for _p, _since in (("", "1999-12-01"), ("e_", "2001-06-01")):
    VIEWS[f"{_p}precios"] = _PRICES.format(since=_since)
    VIEWS[f"{_p}precios_zonas"] = _nearest(f"{_p}precios")
    VIEWS[f"{_p}promedios"] = f"""
SELECT ciudad, tipo_transaccion, cluster_zona, avg(precio_m2) AS promedio_m2_zona
FROM {_p}precios JOIN {_p}precios_zonas USING (ciudad, latitude, longitude) GROUP BY 1, 2, 3"""
VIEWS["enriched"] = """
SELECT p.*, coalesce(r.ratio_activas_vendidas_zona, 0e0) AS ratio_activas_vendidas_zona,
       CASE WHEN m.promedio_m2_zona > 0
            THEN (p.precio_m2 - m.promedio_m2_zona) / m.promedio_m2_zona ELSE 0e0 END
           AS diferencia_vs_promedio_zona
FROM placed p
LEFT JOIN ratios r ON p.ciudad = r.ciudad AND p.tipo_transaccion = r.tipo_transaccion
                  AND p.cluster_zona = r.cluster_zona
LEFT JOIN promedios m ON p.ciudad = m.ciudad AND p.tipo_transaccion = m.tipo_transaccion
                     AND p.cluster_zona = m.cluster_zona"""

VIEWS["extracto"] = """
SELECT cast(l.id AS varchar) AS id_propiedad, l.MLSID AS mlsid, l.date_of_listing,
       l.cancellation_date, l.contract_end_date, a.name AS segmento, ltt.name AS transaction_type,
       sl.name AS status, sp.name AS subtipo_original,
       pc.name_properties_categories AS categoria_propiedad,
       stp.name_state_properties AS estado_propiedad, ci.name AS ciudad,
       li.construction_area_m, li.total_area, li.land_m2, li.number_bedrooms AS dormitorios,
       li.number_bathrooms AS banos, li.parking_slots AS estacionamientos, li.year_construction,
       lp.amount AS precio_publicacion, loc.latitude, loc.longitude, t.sold_date,
       t.current_listing_price AS precio_cierre,
       CASE WHEN ltt.id = 1 THEN 'Venta' ELSE 'Alquiler' END AS tipo_transaccion
FROM crm_listings l
LEFT JOIN crm_listing_transaction_types ltt ON l.transaction_type_id = ltt.id
LEFT JOIN crm_status_listings sl ON l.status_listing_id = sl.id
LEFT JOIN crm_listings_information li ON li.listing_id = l.id
LEFT JOIN crm_subtype_properties sp ON li.subtype_property_id = sp.id
LEFT JOIN crm_state_properties stp ON li.state_property_id = stp.id
LEFT JOIN crm_properties_category pc ON li.property_category_id = pc.id
LEFT JOIN crm_listing_prices lp ON lp.listing_id = l.id
LEFT JOIN crm_locations loc ON loc.listing_id = l.id
LEFT JOIN crm_cities ci ON loc.city_id = ci.id
LEFT JOIN crm_areas a ON a.id = l.area_id
LEFT JOIN crm_transactions t ON t.listing_id = l.id
      AND t.transaction_type_id = l.transaction_type_id AND t.transaction_status_id IN (2, 5)
JOIN ciudades b ON ci.name = b.ciudad
WHERE (ltt.id = 1 AND l.status_listing_id = 8 OR ltt.id = 2 AND l.status_listing_id = 7)
  AND loc.latitude BETWEEN lat0 AND lat1 AND loc.longitude BETWEEN lng0 AND lng1
  AND year(t.sold_date) IN (1998, 1999, 2001)"""
VIEWS["puntos"] = """
SELECT DISTINCT l.id, ci.name AS ciudad, loc.latitude, loc.longitude, l.transaction_type_id
FROM crm_listings l
JOIN crm_locations loc ON loc.listing_id = l.id
JOIN crm_cities ci ON loc.city_id = ci.id
JOIN crm_transactions t ON t.listing_id = l.id AND t.transaction_status_id IN (2, 5)
JOIN ciudades b ON ci.name = b.ciudad
WHERE l.transaction_type_id IN (1, 2) AND l.status_listing_id IN (7, 8)
  AND loc.latitude BETWEEN lat0 AND lat1 AND loc.longitude BETWEEN lng0 AND lng1
  AND year(t.sold_date) IN (1998, 1999, 2001)"""
VIEWS["medias"] = """
SELECT ciudad, round(avg(latitude), 7) AS centroide_lat, round(avg(longitude), 7) AS centroide_lng,
       count(*) AS total_propiedades, cast(0 AS int) AS cluster_id
FROM puntos GROUP BY 1"""

# --- the whole load -------------------------------------------------------------

VIEWS["e_typed"] = """
SELECT *, CASE WHEN tipo_propiedad IN ('Casa', 'Departamento') THEN construction_area_m
               WHEN tipo_propiedad = 'Terreno' THEN 0e0 END AS m2_construidos,
       CASE WHEN tipo_propiedad = 'Casa' THEN land_m2
            WHEN tipo_propiedad = 'Departamento' AND land_m2 > 0 THEN land_m2
            WHEN tipo_propiedad = 'Terreno' THEN total_area END AS m2_terreno
FROM (SELECT *, CASE subtipo_original WHEN 'SUB_AFRICA' THEN 'Casa'
                     WHEN 'SUB_AMERICA' THEN 'Departamento' WHEN 'SUB_ASIA' THEN 'Terreno'
                     ELSE 'Otro' END AS tipo_propiedad FROM extracto)"""
VIEWS.update(_cleaning("e_", "e_typed", ", ".join(f"{c} DESC NULLS LAST" for c in (
    "sold_date precio_cierre mlsid date_of_listing cancellation_date contract_end_date segmento "
    "transaction_type status subtipo_original categoria_propiedad estado_propiedad ciudad "
    "construction_area_m total_area land_m2 dormitorios banos estacionamientos year_construction "
    "precio_publicacion latitude longitude tipo_transaccion").split())))
VIEWS["e_places"] = _nearest("extracto")
VIEWS["e_loaded"] = """
SELECT k.*, z.cluster_zona,
       coalesce(nullif(precio_cierre, 0), precio_publicacion)
         / nullif(CASE WHEN subtipo_original = 'SUB_AMERICA' THEN construction_area_m
                       ELSE total_area END, 0) AS precio_m2
FROM e_cleaned k LEFT JOIN e_places z
  ON k.ciudad = z.ciudad AND k.latitude = z.latitude AND k.longitude = z.longitude
WHERE paso = 'conservado'"""

# --- zone iterations -----------------------------------------------------------

VIEWS["sitios"] = """
SELECT ciudad, latitude AS lat, longitude AS lng, count(*) AS peso FROM fx_listings
WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3"""
VIEWS["c0"] = "SELECT ciudad, cluster_id, centroide_lat AS clat, centroide_lng AS clng FROM fx_centroids"
for _i in (0, 1, 2):
    VIEWS[f"a{_i}"] = f"""
SELECT ciudad, lat, lng, peso, cluster_id FROM (
    SELECT s.*, cluster_id, row_number() OVER (PARTITION BY s.ciudad, lat, lng ORDER BY
        (lat - clat) * (lat - clat) + (lng - clng) * (lng - clng), cluster_id) AS rn
    FROM sitios s JOIN c{_i} c ON s.ciudad = c.ciudad) WHERE rn = 1"""
    VIEWS[f"c{_i + 1}"] = f"""
SELECT c.ciudad, c.cluster_id, coalesce(m.clat, c.clat) AS clat, coalesce(m.clng, c.clng) AS clng
FROM c{_i} c LEFT JOIN (
    SELECT ciudad, cluster_id, round(sum(peso * lat) / sum(peso), 7) AS clat,
           round(sum(peso * lng) / sum(peso), 7) AS clng FROM a{_i} GROUP BY 1, 2) m
  ON c.ciudad = m.ciudad AND c.cluster_id = m.cluster_id"""

# --- roads ---------------------------------------------------------------------

VIEWS["pts"] = _sql(fx.SEGMENT_POINTS)
VIEWS["segs"] = """
SELECT segment_id,
       concat(max(p_name) FILTER (pos = 1),
              coalesce(CASE WHEN segment_id % 2 = 0 THEN ' ; ' ELSE ', ' END
                       || upper(max(p_name) FILTER (pos = 2)), '')) AS name,
       list([lng, lat] ORDER BY pos) AS geom
FROM pts GROUP BY segment_id"""
VIEWS["named"] = """
SELECT *, [lower(trim(x)) FOR x IN regexp_split_to_array(name, '[,;]')] AS nombres
FROM segs"""
VIEWS["pieces"] = """
SELECT segment_id, lng, lat, lead(lng) OVER w AS lng2, lead(lat) OVER w AS lat2
FROM pts WINDOW w AS (PARTITION BY segment_id ORDER BY pos)"""
VIEWS["lengths"] = """
SELECT segment_id, (lng + lng2) / 2 AS x, (lat + lat2) / 2 AS y,
       sqrt((lng - lng2) * (lng - lng2) + (lat - lat2) * (lat - lat2)) AS w
FROM pieces WHERE lng2 IS NOT NULL"""
VIEWS["centres"] = """
SELECT p.segment_id,
       CASE WHEN l.total > 0 THEN l.x ELSE p.lng END AS x,
       CASE WHEN l.total > 0 THEN l.y ELSE p.lat END AS y
FROM (SELECT * FROM pts WHERE pos = 1) p
LEFT JOIN (SELECT segment_id, sum(w) AS total, sum(w * x) / nullif(sum(w), 0) AS x,
                  sum(w * y) / nullif(sum(w), 0) AS y FROM lengths GROUP BY 1) l USING (segment_id)"""
VIEWS["reglas"] = """
SELECT * FROM (VALUES
  (0, 'principal', 'Vías principales', '#DC2626', 5, 'Red Widget', true, NULL, NULL, NULL, NULL),
  (1, 'principal', 'Vías principales', '#DC2626', 5, 'old gear', true, NULL, NULL, NULL, NULL),
  (2, 'principal', 'Vías principales', '#DC2626', 5, 'Hot Plate', true, -18.2e0, -17.0e0, -65.5e0, -64.0e0),
  (3, 'anillo', 'Anillos', '#F59E0B', 3, 'Ring', false, NULL, NULL, NULL, NULL),
  (4, 'anillo', 'Anillos', '#F59E0B', 3, 'gizmo', false, -18.5e0, -17.5e0, -66.0e0, -64.5e0),
  (5, 'resto', 'Otras vías', '#2563EB', 2, 'small', false, NULL, NULL, NULL, NULL),
  (6, 'resto', 'Otras vías', '#2563EB', 2, 'Red Widget', true, NULL, NULL, NULL, NULL),
  (7, 'resto', 'Otras vías', '#2563EB', 2, 'new bolt', true, NULL, NULL, NULL, NULL)
) v(regla, categoria, label, color, weight, nombre_via, exacta, lat0, lat1, lng0, lng1)"""
VIEWS["cruces"] = """
SELECT s.segment_id, s.geom, s.nombres, r.*, c.x, c.y
FROM named s JOIN centres c USING (segment_id)
JOIN reglas r ON (CASE WHEN exacta THEN list_contains(nombres, lower(nombre_via))
                       ELSE len([n FOR n IN nombres IF contains(n, lower(nombre_via))]) > 0 END)
             AND (lat0 IS NULL OR (c.y BETWEEN lat0 AND lat1 AND c.x BETWEEN lng0 AND lng1))"""
VIEWS["clasificadas"] = """
SELECT * FROM cruces
QUALIFY row_number() OVER (PARTITION BY geom ORDER BY regla, segment_id) = 1"""

# --- price models ----------------------------------------------------------------

VIEWS["train"] = """
SELECT *, CASE WHEN tipo_propiedad <> 'Terreno' THEN tipo_propiedad
               WHEN coalesce(m2_terreno, 0) <= 60 THEN 'Terreno_urbano'
               ELSE 'Terreno_rural' END AS tipo_modelo,
       estacionamientos * 2e0 AS ratio0, precio_m2 / 1000 - 2 AS dif0
FROM placed
WHERE tipo_transaccion = 'Venta' AND precio_cierre IS NOT NULL AND tiempo_en_mercado IS NOT NULL
  AND tipo_propiedad IN ('Casa', 'Departamento', 'Terreno')"""
VIEWS["asked"] = """
SELECT *, tipo_propiedad = 'Terreno' AS land,
       CASE WHEN tipo_propiedad <> 'Terreno' THEN tipo_propiedad
            WHEN coalesce(m2_terreno, 0) <= 60 THEN 'Terreno_urbano'
            ELSE 'Terreno_rural' END AS tipo
FROM placed"""
_NUMBERS = {"cluster_zona": "cluster_zona", "m2_construidos": "m2_construidos",
            "dormitorios": "dormitorios", "banos": "banos", "antiguedad": "antiguedad",
            "tiempo_en_mercado": "tiempo_en_mercado", "mes_publicacion": "mes_publicacion",
            "ratio_activas_vendidas_zona": "ratio0", "diferencia_vs_promedio_zona": "dif0",
            "estacionamientos": "estacionamientos", "m2_terreno": "m2_terreno"}
VIEWS["medianas"] = "SELECT tipo_modelo, " + ", ".join(
    f"median(cast({c} AS double)) AS md_{f}" for f, c in _NUMBERS.items()) + " FROM train GROUP BY 1"


def _imputed(feature: str, column: str) -> str:
    value = f"coalesce(cast(t.{column} AS double), m.md_{feature}, 0e0)"
    limits = {"ratio_activas_vendidas_zona": (0, 10), "diferencia_vs_promedio_zona": (-2, 2)}
    if feature in limits:
        low, high = limits[feature]
        value = f"least(greatest({value}, {low}e0), {high}e0)"
    return f"{value} AS {feature}"


def _with(select: str) -> str:
    """A statement with the views it needs, in order of definition."""
    import re

    wanted: set[str] = set()

    def need(sql: str) -> None:
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", sql):
                wanted.add(name)
                need(VIEWS[name])

    need(select)
    if not wanted:
        return select
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted)
    # A statement that begins with a comma brings views of its own.
    return f"WITH {views}{select}" if select.lstrip().startswith(",") else f"WITH {views}\n{select}"


_SUMMARY = """count(*) AS operaciones,
       round(avg(precio) FILTER (precio > 0), 6) AS precio_promedio,
       min(precio) FILTER (precio > 0) AS precio_min, max(precio) FILTER (precio > 0) AS precio_max,
       round(coalesce(avg(precio_m2) FILTER (precio_m2 > 0), 0), 6) AS precio_m2_promedio"""

_QUERIES: dict[str, str] = {
    "zone_price_by_city_type": f"""
SELECT ciudad, tipo_propiedad, {_SUMMARY}
FROM (SELECT *, coalesce(precio_cierre, precio_publicacion) AS precio FROM priced)
GROUP BY 1, 2""",
    "dedup_keep_last": f"""
SELECT id_propiedad, sold_date, precio_cierre, precio_publicacion, segmento,
       row_number() OVER (PARTITION BY id_propiedad ORDER BY {_ORDER}) = 1 AS es_ultimo
FROM fx_listings""",
    "missing_to_null": """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_discount <> 0 AND l_tax <> 0 AND l_quantity NOT IN (1, 50)
            THEN l_extendedprice END AS valor,
       CASE WHEN l_linenumber = 5 THEN 'NAN' WHEN l_linenumber > 4 THEN l_returnflag END AS texto
FROM lineitem""",
    "type_areas": """
SELECT id_propiedad, subtipo_original, tipo_propiedad, m2_construidos, m2_terreno FROM typed""",
    "invalid_area_rejects": """
SELECT id_propiedad, mlsid, subtipo_original, tipo_propiedad, tipo_transaccion,
       'm2_construidos <= 0 o nulo' AS motivo
FROM typed
WHERE tipo_propiedad IN ('Casa', 'Departamento') AND construction_area_m - 3 <= 0
   OR tipo_propiedad = 'Terreno' AND total_area - 10 <= 0""",
    "required_field_rejects": f"""
SELECT id_propiedad, mlsid, subtipo_original, tipo_propiedad, tipo_transaccion, motivo
FROM (SELECT *, unnest([{_FIELDS}]) AS motivo FROM typed) WHERE motivo IS NOT NULL""",
    "outlier_removal_price": """
SELECT id_propiedad, tipo_propiedad, tipo_transaccion, precio_cierre,
       coalesce(precio_cierre NOT BETWEEN m - 1.6e0 * s AND m + 1.6e0 * s, false) AS es_atipico
FROM typed JOIN (
    SELECT tipo_propiedad, tipo_transaccion, avg(precio_cierre) AS m, stddev_samp(precio_cierre) AS s
    FROM typed GROUP BY 1, 2) USING (tipo_propiedad, tipo_transaccion)""",
    "price_floor_rejects": """
SELECT id_propiedad, tipo_propiedad, tipo_transaccion, precio_publicacion,
       CASE tipo_transaccion WHEN 'Venta' THEN 'precio menor mínimo venta'
            ELSE 'precio menor mínimo alquiler' END AS motivo
FROM typed JOIN minimos ON tipo_transaccion = trans AND tipo_propiedad = tipo
WHERE precio_publicacion < minimo""",
    "clean_chain": """
SELECT id_propiedad, tipo_propiedad, tipo_transaccion, m2_construidos, m2_terreno,
       precio_publicacion, precio_cierre, paso,
       coalesce(array_to_string(list_sort(motivos), ', '), '') AS motivos
FROM cleaned""",
    "reject_detail": """
SELECT id_propiedad, mlsid, subtipo_original, tipo_propiedad, tipo_transaccion,
       string_agg(DISTINCT motivo, ', ' ORDER BY motivo) AS motivos
FROM rejected WHERE mlsid IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "reject_summary": """
SELECT motivo, count(DISTINCT id_propiedad) AS total FROM rejected GROUP BY 1 ORDER BY 2 DESC, 1""",
    "step_counters": "SELECT paso, count(*) AS filas FROM cleaned GROUP BY 1",
    "load_rejects": """
SELECT concat_ws(', ', CASE WHEN mlsid IS NULL THEN 'mlsid nulo' END,
                 CASE WHEN mlsid IS NOT NULL AND rn > 1 THEN 'id_propiedad repetido' END) AS violaciones,
       count(*) AS filas
FROM (SELECT mlsid, row_number() OVER (PARTITION BY id_propiedad, mlsid IS NULL) AS rn FROM typed)
GROUP BY 1""",
    "star_extract": "SELECT * FROM extracto",
    "extract_counts": """
SELECT tipo_transaccion, count(*) AS filas, count(DISTINCT ciudad) AS ciudades
FROM extracto GROUP BY 1""",
    "market_time": """
SELECT id_propiedad, cast(year_construction AS int) AS year_construction, antiguedad,
       tiempo_en_mercado, mes_publicacion, anio_publicacion, date_of_listing, sold_date FROM timed""",
    "load_projection": _PROJECTION.format(dorm="1 AND 8", days="0 AND 1500").replace(
        "cast(sold_date AS date) AS", "cast(cast(sold_date AS date) AS varchar) AS"),
    "training_split": """
SELECT tipo_transaccion, count(*) AS filas,
       count(*) FILTER (tipo_transaccion = 'Venta') AS ventas,
       count(*) FILTER (tipo_transaccion = 'Alquiler') AS alquileres,
       max(sold_date) AS ultima_venta
FROM typed WHERE precio_cierre IS NOT NULL GROUP BY 1""",
    "nearest_centroid": """
SELECT id_propiedad, l.ciudad, l.latitude, l.longitude, cluster_zona
FROM fx_listings l LEFT JOIN places z
  ON l.ciudad = z.ciudad AND l.latitude = z.latitude AND l.longitude = z.longitude""",
    "nearest_centroid_global": """
SELECT id_propiedad, l.ciudad, l.latitude, l.longitude, cluster_zona
FROM fx_listings l LEFT JOIN places_global z
  ON l.ciudad = z.ciudad AND l.latitude = z.latitude AND l.longitude = z.longitude""",
    "zone_active_closed_ratio": "SELECT * FROM ratios",
    "zone_mean_price_m2": """
SELECT ciudad, tipo_transaccion, cluster_zona, round(promedio_m2_zona, 6) AS promedio_m2_zona
FROM promedios""",
    "zone_feature_enrich": """
SELECT id_propiedad, ciudad, tipo_transaccion, cluster_zona, precio_m2,
       round(ratio_activas_vendidas_zona, 6) AS ratio_activas_vendidas_zona,
       round(diferencia_vs_promedio_zona, 6) AS diferencia_vs_promedio_zona
FROM enriched""",
    "zone_feature_pooled": """
SELECT cluster_zona, round(avg(ratio_activas_vendidas_zona), 6) AS ratio_activas_vendidas_zona,
       round(avg(diferencia_vs_promedio_zona), 6) AS diferencia_vs_promedio_zona
FROM enriched WHERE cluster_zona IS NOT NULL GROUP BY 1""",
    "zone_feature_by_city": """
SELECT ciudad, cluster_zona, round(avg(ratio_activas_vendidas_zona), 6) AS ratio_activas_vendidas_zona,
       round(avg(diferencia_vs_promedio_zona), 6) AS diferencia_vs_promedio_zona
FROM enriched WHERE cluster_zona IS NOT NULL GROUP BY 1, 2""",
    "zones_k1": """
SELECT ciudad, centroide_lat, centroide_lng, total_propiedades, cluster_id, cast(tier AS int) AS tier,
       cast(total_propiedades AS bigint) AS propiedades, cast(1 AS bigint) AS clusters,
       cast(least(k + 5, total_propiedades // 5) AS bigint) AS k_maximo
FROM medias JOIN ciudades USING (ciudad)""",
    "zone_totals": """
SELECT ciudad, cast(k AS bigint) AS zonas, cast(total_propiedades AS bigint) AS propiedades,
       cast(k AS int) AS n_clusters_ciudad, round(cast(centroide_lat AS double), 3) AS centroide_lat,
       round(cast(centroide_lng AS double), 3) AS centroide_lng
FROM medias JOIN ciudades USING (ciudad)""",
    "zone_means": """
SELECT ciudad, cast(unnest(range(0, k)) AS int) AS cluster_id, true AS es_media, true AS cuenta_todas
FROM medias JOIN ciudades USING (ciudad) WHERE total_propiedades >= 5""",
    "elbow_facts": """
SELECT ciudad, cast(unnest(range(2, least(20, total_propiedades // 10) + 1, 2)) AS int) AS k,
       true AS suma_coincide, true AS menor_que_una_zona
FROM medias JOIN ciudades USING (ciudad) WHERE tier = 1 AND total_propiedades >= 20""",
    "zone_cascade": """
SELECT id_propiedad, l.ciudad, l.latitude, l.longitude,
       CASE WHEN cluster_zona <> 3 AND NOT (cluster_zona = 1 AND l.ciudad = 'NATION_1') THEN cluster_zona END
         AS cluster_zona
FROM fx_listings l LEFT JOIN places z
  ON l.ciudad = z.ciudad AND l.latitude = z.latitude AND l.longitude = z.longitude""",
    "extract_parts": """
SELECT ciudad, tipo_transaccion, count(*) AS filas, cast(NULL AS varchar) AS error
FROM extracto WHERE ciudad <> 'NATION_2' GROUP BY 1, 2
UNION ALL SELECT 'NATION_2', tipo, NULL, 'sin conexión' FROM (VALUES ('Venta'), ('Alquiler')) v(tipo)""",
    "zones_lloyd_2iter": """
SELECT c.ciudad, c.cluster_id, c.clat AS centroide_lat, c.clng AS centroide_lng,
       cast(coalesce(n, 0) AS bigint) AS total_propiedades
FROM c2 c LEFT JOIN (SELECT ciudad, cluster_id, sum(peso) AS n FROM a2 GROUP BY 1, 2) m
  ON c.ciudad = m.ciudad AND c.cluster_id = m.cluster_id""",
    "fk_violations": """
SELECT id_propiedad, l.ciudad, cluster_zona
FROM fx_listings l JOIN places z
  ON l.ciudad = z.ciudad AND l.latitude = z.latitude AND l.longitude = z.longitude
WHERE NOT EXISTS (SELECT 1 FROM fx_centroids c WHERE c.ciudad = z.ciudad
                  AND c.cluster_id = z.cluster_zona AND c.cluster_id <> 3)""",
    "fk_set_null": """
SELECT l.ciudad, CASE WHEN cluster_zona <> 3 THEN cluster_zona END AS cluster_zona, count(*) AS filas
FROM fx_listings l LEFT JOIN places z
  ON l.ciudad = z.ciudad AND l.latitude = z.latitude AND l.longitude = z.longitude
GROUP BY 1, 2""",
    "replace_city": """
SELECT cluster_id, ciudad, centroide_lat, centroide_lng, total_propiedades FROM fx_centroids
WHERE ciudad NOT IN ('NATION_1', 'NATION_2')
UNION ALL
SELECT cluster_id, ciudad, centroide_lat, centroide_lng, total_propiedades FROM medias
WHERE ciudad IN ('NATION_1', 'NATION_2')""",
    "keyed_upsert": """
SELECT id_propiedad, ciudad, tipo_transaccion,
       CASE WHEN date_of_listing >= timestamp '1999-01-01' THEN precio_publicacion * 0.9e0
            ELSE precio_publicacion END AS precio_publicacion,
       CASE WHEN date_of_listing < timestamp '1999-01-01' OR status <> 'Otra' THEN status END AS status,
       CASE WHEN date_of_listing >= timestamp '2000-01-01' THEN 'nuevo' ELSE segmento END AS segmento,
       date_of_listing,
       CASE WHEN date_of_listing >= timestamp '2000-01-01' THEN 'insertado'
            WHEN date_of_listing >= timestamp '1999-01-01' THEN 'actualizado'
            ELSE 'sin_cambio' END AS accion
FROM ranked WHERE rn = 1""",
    "etl_load": """
SELECT id_propiedad, mlsid, tipo_propiedad, subtipo_original, categoria_propiedad, estado_propiedad,
       segmento, l.tipo_transaccion, latitude, longitude, l.cluster_zona, l.ciudad,
       m2_construidos, m2_terreno, dormitorios, banos, estacionamientos,
       cast(greatest(2001 - year_construction, 0) AS int) AS antiguedad, precio_publicacion,
       CASE WHEN l.tipo_transaccion = 'Venta' THEN precio_cierre END AS precio_venta,
       CASE WHEN l.tipo_transaccion = 'Alquiler' THEN precio_cierre END AS precio_alquiler_mes,
       precio_m2,
       cast(greatest(date_sub('day', date_of_listing, sold_date), 0) AS int) AS tiempo_en_mercado,
       cast(0 AS int) AS numero_reducciones,
       round(CASE WHEN promedio_m2_zona > 0 THEN (precio_m2 - promedio_m2_zona) / promedio_m2_zona
                  ELSE 0e0 END, 6) AS diferencia_vs_promedio_zona,
       round(coalesce(r.ratio_activas_vendidas_zona, 0e0), 6) AS ratio_activas_vendidas_zona,
       cast(month(date_of_listing) AS int) AS mes_publicacion,
       cast(year(date_of_listing) AS int) AS anio_publicacion,
       cast(cast(sold_date AS date) AS varchar) AS fecha_venta, status, transaction_type,
       'Bolivia' AS pais
FROM e_loaded l
LEFT JOIN ratios r ON l.ciudad = r.ciudad AND l.tipo_transaccion = r.tipo_transaccion
                  AND l.cluster_zona = r.cluster_zona
LEFT JOIN e_promedios m ON l.ciudad = m.ciudad AND l.tipo_transaccion = m.tipo_transaccion
                       AND l.cluster_zona = m.cluster_zona""",
    "price_records": "SELECT * FROM records",
    "zone_price_summary": """
SELECT r.ciudad, r.cluster, operaciones, precio_promedio, precio_m2_promedio,
       centroide_lat, centroide_lng
FROM (SELECT ciudad, cluster, count(*) FILTER (precio > 0) AS operaciones,
             round(avg(precio) FILTER (precio > 0), 6) AS precio_promedio,
             round(coalesce(avg(precio_m2) FILTER (precio_m2 > 0), 0), 6) AS precio_m2_promedio
      FROM records GROUP BY 1, 2) r
JOIN fx_centroids c ON r.ciudad = c.ciudad AND r.cluster = c.cluster_id
WHERE operaciones > 0""",
    "facet_summary": f"""
SELECT tipo, {_SUMMARY} FROM records WHERE transaccion = 'Venta' AND anio = 1999 GROUP BY 1""",
    "facet_values": """
SELECT DISTINCT faceta, valor FROM (
    SELECT unnest(['tipo_propiedad', 'tipo_transaccion', 'anio_venta', 'ciudad']) AS faceta,
           unnest([tipo_propiedad, tipo_transaccion, cast(year(fecha_venta) AS varchar), ciudad]) AS valor
    FROM analytics WHERE latitude IS NOT NULL AND longitude IS NOT NULL
      AND (precio_venta IS NOT NULL OR precio_alquiler_mes IS NOT NULL))
WHERE valor IS NOT NULL""",
    "map_extent": """
SELECT min(latitude) AS lat_min, max(latitude) AS lat_max, round(avg(latitude), 6) AS lat_centro,
       min(longitude) AS lng_min, max(longitude) AS lng_max, round(avg(longitude), 6) AS lng_centro
FROM analytics WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND (precio_venta IS NOT NULL OR precio_alquiler_mes IS NOT NULL)""",
    "minmax_weight": """
SELECT lat, lng, precio, round((precio - min(precio) OVER ())
       / coalesce(nullif(max(precio) OVER () - min(precio) OVER (), 0), 1), 9) AS peso
FROM records WHERE precio > 0""",
    "activity_grid": """
SELECT cast(floor(lat / 0.25e0) AS bigint) AS celda_lat, cast(floor(lng / 0.25e0) AS bigint) AS celda_lng,
       count(*) AS operaciones
FROM records GROUP BY 1, 2""",
    "zone_hull": """
, columnas AS (
    SELECT ciudad, cluster_zona, cast(round(longitude * 10000000) AS hugeint) AS x,
           min(cast(round(latitude * 10000000) AS hugeint)) AS y0,
           max(cast(round(latitude * 10000000) AS hugeint)) AS y1
    FROM places GROUP BY 1, 2, 3),
cadenas AS (
    SELECT ciudad, cluster_zona, x, y0 AS y, 1 AS lado FROM columnas
    UNION ALL SELECT ciudad, cluster_zona, x, -y1, -1 FROM columnas),
vertices AS (
    SELECT DISTINCT ciudad, cluster_zona, x, y * lado AS y FROM cadenas p
    WHERE NOT EXISTS (
        SELECT 1 FROM cadenas a JOIN cadenas b
          ON a.ciudad = b.ciudad AND a.cluster_zona = b.cluster_zona AND a.lado = b.lado
        WHERE a.ciudad = p.ciudad AND a.cluster_zona = p.cluster_zona AND a.lado = p.lado
          AND a.x < p.x AND b.x > p.x
          AND (p.x - a.x) * (b.y - a.y) - (p.y - a.y) * (b.x - a.x) <= 0)),
extremos AS (
    SELECT ciudad, cluster_zona, min(struct_pack(x := x, y := y)) AS a, max(struct_pack(x := x, y := y)) AS b
    FROM vertices GROUP BY 1, 2 HAVING count(*) > 2),
lados AS (
    SELECT v.*, CASE WHEN (b.x - a.x) * (y - a.y) - (b.y - a.y) * (x - a.x) > 0 THEN -1 ELSE 1 END AS lado
    FROM vertices v JOIN extremos e ON v.ciudad = e.ciudad AND v.cluster_zona = e.cluster_zona)
SELECT ciudad, cluster_zona, x / 10000000 AS longitude, y / 10000000 AS latitude,
       cast(row_number() OVER (PARTITION BY ciudad, cluster_zona
                               ORDER BY lado DESC, x * lado, y * lado) - 1 AS int) AS orden
FROM lados""",
    "road_rule_match": """
SELECT segment_id, regla, categoria, label, color, weight, nombre_via,
       array_to_string(nombres, ', ') AS nombres FROM clasificadas""",
    "road_all_matches": """
SELECT segment_id, regla, round(x, 6) AS lng, round(y, 6) AS lat FROM cruces""",
    "road_summary": "SELECT label, count(*) AS segmentos FROM clasificadas GROUP BY 1",
    "road_rule_hits": """
SELECT r.*, count(c.regla) AS segmentos FROM (VALUES
  (0, 'principal', 'Vías principales', 'Red Widget'), (1, 'principal', 'Vías principales', 'old gear'),
  (2, 'principal', 'Vías principales', 'Hot Plate'), (3, 'anillo', 'Anillos', 'Ring'), (4, 'anillo', 'Anillos', 'gizmo'),
  (5, 'resto', 'Otras vías', 'small'), (6, 'resto', 'Otras vías', 'Red Widget'), (7, 'resto', 'Otras vías', 'new bolt'),
  (8, 'ninguna', 'Ninguna', 'no such way')) r(regla, categoria, label, nombre_via)
LEFT JOIN cruces c ON c.regla = r.regla GROUP BY ALL""",
    "segment_bounds": """
SELECT segment_id, min(lng) AS lng_min, max(lng) AS lng_max, min(lat) AS lat_min, max(lat) AS lat_max
FROM pts GROUP BY 1""",
    "segment_name_count": """
SELECT count(*) AS segmentos FROM named WHERE list_contains(nombres, 'blue ring')""",
    "impute_clamp": "SELECT id_propiedad, t.tipo_modelo, " + ", ".join(
        _imputed(f, c) for f, c in _NUMBERS.items()) + """
FROM train t JOIN medianas m ON t.tipo_modelo = m.tipo_modelo""",
    "regression_metrics": """
SELECT tipo_propiedad, count(*) AS registros,
       round(avg(abs(precio_cierre - precio_publicacion)), 6) AS mae,
       round(sqrt(avg((precio_cierre - precio_publicacion) * (precio_cierre - precio_publicacion))), 6) AS rmse,
       round(avg(abs((precio_cierre - precio_publicacion) / precio_cierre)) * 100, 6) AS mape,
       avg(abs((precio_cierre - precio_publicacion) / precio_cierre)) * 100 <= 12 AS meta_cumplida
FROM typed WHERE precio_cierre IS NOT NULL GROUP BY 1""",
    "price_model_score": """
SELECT id_propiedad, tipo AS tipo_modelo, cluster_zona, CASE WHEN land AND known THEN m2 END AS m2, 'BOB' AS moneda,
       CASE WHEN NOT known THEN 'sin modelo para tipo: ' || coalesce(tipo, '?') END AS error, known AS con_precio,
       CASE WHEN known THEN true END AS banda_del_12, CASE WHEN known AND land THEN true END AS total_por_m2
FROM (SELECT r.*, m.tipo_modelo IS NOT NULL AS known,
             coalesce(nullif(m2_terreno, 0), m2_construidos, 0e0) AS m2
      FROM asked r LEFT JOIN (SELECT tipo_modelo FROM train GROUP BY 1 HAVING count(
                     CASE WHEN tipo_propiedad = 'Terreno' THEN precio_m2 ELSE precio_cierre END) >= 50) m
        ON r.tipo = m.tipo_modelo)""",
    "model_type_counts": "SELECT tipo_modelo, count(*) AS filas FROM train GROUP BY 1",
}

_QUERIES["etl_update"] = f"""
SELECT id_propiedad, CASE WHEN conocida THEN 'V' || mlsid ELSE mlsid END AS mlsid, ciudad, tipo_transaccion,
       cluster_zona, CASE WHEN conocida THEN 'antes' ELSE segmento END AS segmento, precio_publicacion, precio_venta,
       precio_alquiler_mes, precio_m2, tiempo_en_mercado, numero_reducciones, status, ratio_activas_vendidas_zona,
       diferencia_vs_promedio_zona, NOT conocida AS es_nueva, true AS llegada
FROM (SELECT *, cast(id_propiedad AS bigint) % 3 = 0 AS conocida FROM ({_QUERIES["etl_load"]}))
UNION ALL
SELECT '-1', 'V', 'otra', 'Venta', {", ".join(["NULL"] * 11)}, false, false"""

ORACLES: dict[str, str] = {
    name: _with(sql) for name, sql in _QUERIES.items()}
