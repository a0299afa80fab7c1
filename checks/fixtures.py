"""Views in the shape of the market data, derived from the generated tables.

The SQL below runs unchanged in Spark and in DuckDB; ``{name}`` stands for a
table. The operators under test are not part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonalis.config import City
from zonalis.sources.session import small_checkpoint

AS_OF = "2001-12-01"

# The tables here know other subtypes, cities and price levels than the real market.
SUBTYPE_TO_TYPE = {
    "STANDARD": "Casa", "MEDIUM": "Departamento", "ECONOMY": "Terreno",
    "LARGE": "Local Comercial", "PROMO": "Oficina",
}
FLOORS = {
    "Venta": {"Casa": 9000, "Departamento": 6000, "Terreno": 3000, "Local Comercial": 4000,
              "Oficina": 4000, "Otro": 3000},
    "Alquiler": {"Casa": 2000, "Departamento": 2500, "Local Comercial": 2000, "Oficina": 2000,
                 "Otro": 2000},
}
DEPARTMENT_SUBTYPES = ("MEDIUM",)
CITIES = tuple(
    City(f"NATION_{i}", 1 if i % 5 == 0 else 2, 4 if i % 5 == 0 else 1,
         (-19.5, -16.5), (-66.8, -63.2)) for i in range(25))
YEARS = (1998, 1999, 2001)
NO_ZONES = ("NATION_0", "NATION_8", "NATION_16", "NATION_24")

LISTINGS = """
SELECT cast(l_orderkey * 10 + l_linenumber AS string) AS id_propiedad,
       CASE WHEN l_partkey % 7 = 0 THEN NULL
            ELSE concat('M', cast(l_partkey AS string)) END AS mlsid,
       n_name AS ciudad,
       r_name AS pais,
       CASE WHEN l_returnflag = 'R' THEN 'Alquiler' ELSE 'Venta' END AS tipo_transaccion,
       CASE WHEN l_returnflag = 'R' THEN 'En Alquiler' ELSE 'En Venta' END AS transaction_type,
       p_type AS subtipo_original,
       p_brand AS segmento,
       o_orderpriority AS categoria_propiedad,
       l_linestatus AS estado_propiedad,
       l_quantity AS construction_area_m,
       cast(nullif(p_size % 10, 0) AS double) AS land_m2,
       l_quantity + p_size AS total_area,
       cast(round(l_discount * 100) AS int) AS dormitorios,
       l_linenumber AS banos,
       cast(round(l_tax * 100) AS int) AS estacionamientos,
       1950 + p_size AS year_construction,
       l_extendedprice AS precio_publicacion,
       CASE WHEN l_partkey % 11 = 0 THEN NULL
            ELSE l_extendedprice * (1 - l_discount) END AS precio_cierre,
       o_orderdate AS date_of_listing,
       CASE WHEN o_orderstatus <> 'P' THEN l_shipdate END AS sold_date,
       CASE WHEN l_suppkey % 3 = 0 THEN l_shipdate END AS cancellation_date,
       CASE WHEN l_suppkey % 2 = 0 THEN o_orderdate + interval '90' day END AS contract_end_date,
       CASE WHEN o_orderstatus = 'O' THEN 'Activa'
            WHEN o_orderstatus = 'P' THEN 'Otra'
            WHEN l_returnflag = 'R' THEN 'Alquilado'
            ELSE 'Venta Aceptada/Vendida' END AS status,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL
            ELSE -(16 + (l_partkey % 1000) / 250e0) END AS latitude,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL
            ELSE -(63 + (l_suppkey % 100) / 25e0) END AS longitude
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# Zones: four bands of latitude per city; some cities have none.
CENTROIDS = """
SELECT cast((l_partkey % 1000 - l_partkey % 250) / 250 AS int) AS cluster_id,
       n_name AS ciudad,
       round(avg(-(16 + (l_partkey % 1000) / 250e0)), 7) AS centroide_lat,
       round(avg(-(63 + (l_suppkey % 100) / 25e0)), 7) AS centroide_lng,
       cast(count(*) AS int) AS total_propiedades
FROM {lineitem}
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
WHERE n_name NOT IN ('NATION_0', 'NATION_8', 'NATION_16', 'NATION_24')
GROUP BY 1, 2
"""

# The twelve tables of a listings database: an order is a listing, its lines are transactions.
CRM = {
    "listings": """
        SELECT o_orderkey AS id, concat('M', cast(o_orderkey AS string)) AS MLSID,
               o_orderdate AS date_of_listing,
               CASE WHEN o_custkey % 3 = 0 THEN o_orderdate + interval '30' day END AS cancellation_date,
               CASE WHEN o_custkey % 2 = 0 THEN o_orderdate + interval '90' day END AS contract_end_date,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2 ELSE 1 END AS transaction_type_id,
               CASE WHEN o_orderstatus = 'O' THEN 1
                    WHEN o_orderstatus = 'P' THEN 3
                    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 7 ELSE 8 END AS status_listing_id,
               cast(o_custkey % 5 AS int) AS area_id
        FROM {orders}""",
    "listings_information": """
        SELECT o_orderkey AS listing_id,
               cast(o_custkey % 180 AS double) AS construction_area_m,
               cast(o_custkey % 180 + 40 AS double) AS total_area,
               cast(nullif(o_orderkey % 13, 0) AS double) AS land_m2,
               cast(o_custkey % 6 AS int) AS number_bedrooms,
               cast(o_custkey % 4 AS int) AS number_bathrooms,
               cast(o_orderkey % 3 AS int) AS parking_slots,
               cast(1950 + o_custkey % 60 AS int) AS year_construction,
               cast(o_custkey % 6 AS int) AS subtype_property_id,
               cast(o_orderkey % 3 AS int) AS state_property_id,
               cast(o_custkey % 2 AS int) AS property_category_id
        FROM {orders}""",
    "listing_prices": "SELECT o_orderkey AS listing_id, o_totalprice AS amount FROM {orders}",
    "locations": """
        SELECT o_orderkey AS listing_id,
               -(16 + (o_custkey % 1000) / 250e0) AS latitude,
               -(63 + (o_orderkey % 100) / 25e0) AS longitude,
               c_nationkey AS city_id
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "transactions": """
        SELECT l_orderkey AS listing_id,
               CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS transaction_type_id,
               l_linenumber AS transaction_status_id,
               l_shipdate AS sold_date,
               l_extendedprice AS current_listing_price
        FROM {lineitem}""",
    "cities": "SELECT n_nationkey AS id, n_name AS name FROM {nation}",
    "areas": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    "listing_transaction_types": """
        SELECT r_regionkey AS id,
               CASE WHEN r_regionkey = 1 THEN 'Venta' WHEN r_regionkey = 2 THEN 'Alquiler'
                    ELSE r_name END AS name
        FROM {region}""",
    "status_listings": """
        SELECT n_nationkey AS id,
               CASE WHEN n_nationkey = 1 THEN 'Activa' WHEN n_nationkey = 7 THEN 'Alquilado'
                    WHEN n_nationkey = 8 THEN 'Venta Aceptada/Vendida' ELSE n_name END AS name
        FROM {nation}""",
    "subtype_properties": "SELECT r_regionkey AS id, concat('SUB_', r_name) AS name FROM {region}",
    "state_properties": "SELECT r_regionkey AS id, concat('ST_', r_name) AS name_state_properties FROM {region}",
    "properties_category": "SELECT r_regionkey AS id, concat('CAT_', r_name) AS name_properties_categories FROM {region}",
}

# Rows with every kind of "missing": NaN, infinities and texts.
DIRTY = """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_discount = 0 THEN cast('NaN' AS double)
            WHEN l_tax = 0 THEN cast('Infinity' AS double)
            WHEN l_quantity = 50 THEN cast('-Infinity' AS double)
            WHEN l_quantity = 1 THEN NULL
            ELSE l_extendedprice END AS valor,
       CASE WHEN l_linenumber = 1 THEN 'nan' WHEN l_linenumber = 2 THEN 'NaT'
            WHEN l_linenumber = 3 THEN 'None' WHEN l_linenumber = 4 THEN '-inf'
            WHEN l_linenumber = 5 THEN 'NAN' ELSE l_returnflag END AS texto
FROM {lineitem}
"""

# Line geometry: the lines of an order are the points of one road segment.
SEGMENT_POINTS = """
SELECT l_orderkey AS segment_id,
       row_number() OVER (PARTITION BY l_orderkey
                          ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey,
                                   l_extendedprice, l_quantity, l_discount, l_tax) AS pos,
       -(63 + (l_suppkey % 100) / 25e0) AS lng,
       -(16 + (l_partkey % 1000) / 250e0) AS lat,
       p_name
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""


def tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    read = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    if "lineitem" in read:
        read["lineitem"] = spread(read["lineitem"], "l_orderkey")
    return read


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table that comes in one file with one row group.

    Such a file is one task. A table in at least as many files as cores is left
    as it is: reading it needs no shuffle. Rows are dealt to the shuffle tasks
    of the session, not to the cores, so that a task's share stays small.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(key) if len(df.inputFiles()) < cores else df


_LISTING_TABLES = ("lineitem", "orders", "part", "supplier", "nation", "region")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(LISTINGS, **tables(spark, folder, *_LISTING_TABLES))


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The zone table. It is a stored table to the operators, so it is computed once."""
    return small_checkpoint(
        spark.sql(CENTROIDS, **tables(spark, folder, "lineitem", "supplier", "nation")))


def crm(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    base = tables(spark, folder, "lineitem", "orders", "customer", "nation", "region")
    return {name: spark.sql(sql, **{t: df for t, df in base.items() if "{" + t + "}" in sql})
            for name, sql in CRM.items()}


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with the names of their first two points as one text, and their geometry."""
    points = spark.sql(SEGMENT_POINTS, **tables(spark, folder, "lineitem", "part"))
    return spark.sql("""
        SELECT segment_id,
               concat(max(CASE WHEN pos = 1 THEN p_name END),
                      coalesce(concat(CASE WHEN segment_id % 2 = 0 THEN ' ; ' ELSE ', ' END,
                                      max(CASE WHEN pos = 2 THEN upper(p_name) END)), '')) AS name,
               transform(array_sort(collect_list(struct(pos, lng, lat))),
                         p -> struct(p.lng AS lng, p.lat AS lat)) AS geom
        FROM {points} GROUP BY segment_id""", points=points)
