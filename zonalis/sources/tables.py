"""Reads of the tables this library writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.functions.values import has_any


def read_centroids(spark: SparkSession, path: str, city: str | None = None) -> DataFrame:
    """Zone centroids in order; one city reads only its own partition."""
    return zone_centroids(spark.read.parquet(path), city)


def zone_centroids(table: DataFrame, city: str | None = None) -> DataFrame:
    rows = table if city is None else table.filter(F.col("ciudad") == city)
    return rows.orderBy("ciudad", "cluster_id")


def map_rows(analytics: DataFrame, city: str | None = None, ordered: bool = True) -> DataFrame:
    """Located and priced properties with year and month of sale, newest first."""
    rows = analytics if city is None else analytics.filter(F.col("ciudad") == city)
    rows = (rows.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                        & has_any("precio_venta", "precio_alquiler_mes"))
            .select("id_propiedad", "mlsid", "tipo_propiedad", "tipo_transaccion",
                    "cluster_zona", "ciudad", "latitude", "longitude",
                    "precio_venta", "precio_alquiler_mes", "precio_m2",
                    "m2_construidos", "m2_terreno", "dormitorios", "banos", "fecha_venta",
                    F.year("fecha_venta").alias("anio_venta"),
                    F.month("fecha_venta").alias("mes_venta")))
    return rows.orderBy(F.desc_nulls_first("fecha_venta")) if ordered else rows


def read_training_set(spark: SparkSession, path: str, deal: str | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if deal is None else rows.filter(F.col("tipo_transaccion") == deal)
