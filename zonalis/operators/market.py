"""Market aggregates behind a price map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.prices import effective_price
from zonalis.functions.values import null_if_zero
from zonalis.sources.session import staged

ALL = "todos"
YEAR = "anio"


def price_records(rows: DataFrame) -> DataFrame:
    """One record per priced property, with defaults in place of nulls."""

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    def whole(c: str, default: int = 0) -> Column:
        return F.coalesce(F.col(c).cast("int"), F.lit(default))

    def text(c: str, default: str = "") -> Column:
        return F.coalesce(F.col(c), F.lit(default))

    price = effective_price(F.col("precio_venta"), F.col("precio_alquiler_mes")).cast("double")
    return rows.filter(price.isNotNull()).select(
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lng"),
        text("mlsid", "N/A").alias("mlsid"), price.alias("precio"),
        number("precio_m2").alias("precio_m2"), text("tipo_propiedad").alias("tipo"),
        text("tipo_transaccion").alias("transaccion"), text("ciudad").alias("ciudad"),
        whole("cluster_zona", -1).alias("cluster"), whole("anio_venta").alias("anio"),
        number("m2_construidos").alias("m2_construidos"), number("m2_terreno").alias("m2_terreno"),
        whole("dormitorios").alias("dormitorios"), whole("banos").alias("banos"))


def as_json(records: DataFrame, out: str = "registro") -> DataFrame:
    return records.select(F.to_json(F.struct("*")).alias(out))


def facet_filter(records: DataFrame, facets: Mapping[str, object]) -> DataFrame:
    """Rows matching every facet; None or "todos" leaves a facet open, as does 0 for the year."""
    for column, value in facets.items():
        if value is not None and value != ALL and (column, value) != (YEAR, 0):
            records = records.filter(F.col(column) == value)
    return records


def _positive(column: str) -> Column:
    return F.when(F.col(column) > 0, F.col(column))


def price_summary(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Operations, mean, lowest and highest positive price, mean positive price per m²."""
    return records.groupBy(*by).agg(
        F.count("*").alias("operaciones"),
        F.avg(_positive("precio")).alias("precio_promedio"),
        F.min(_positive("precio")).alias("precio_min"),
        F.max(_positive("precio")).alias("precio_max"),
        F.coalesce(F.avg(_positive("precio_m2")), F.lit(0.0)).alias("precio_m2_promedio"))


def zone_price_summary(records: DataFrame, centroids: DataFrame | None = None) -> DataFrame:
    """Operations and mean prices per zone; zones without a price are left out.

    With ``centroids``, only zones that have one, and with its place.
    """
    zones = records.groupBy("ciudad", "cluster").agg(
        F.count(_positive("precio")).alias("operaciones"),
        F.avg(_positive("precio")).alias("precio_promedio"),
        F.coalesce(F.avg(_positive("precio_m2")), F.lit(0.0)).alias("precio_m2_promedio"),
    ).filter(F.col("operaciones") > 0)
    if centroids is None:
        return zones
    places = centroids.select("ciudad", F.col("cluster_id").cast("int").alias("cluster"),
                              F.col("centroide_lat").cast("double").alias("centroide_lat"),
                              F.col("centroide_lng").cast("double").alias("centroide_lng"))
    return zones.join(places, ["ciudad", "cluster"])


def min_max_weight(df: DataFrame, column: str, out: str = "peso") -> DataFrame:
    """Position of a value between the lowest and the highest of the frame, 0 to 1.

    The two ends are one scalar subquery; rows that are null get null.
    """
    ends = df.select(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    span = F.coalesce(null_if_zero(ends["hi"] - ends["lo"]), F.lit(1.0))
    return df.withColumn(out, (F.col(column) - ends["lo"]) / span)


def price_weight(df: DataFrame, price: str, out: str = "peso") -> DataFrame:
    """The rows with a positive price, weighted by it. They are written once; the two ends read one column of them."""
    return min_max_weight(staged(df.filter(F.col(price) > 0), "priced"), price, out)


def activity_grid(records: DataFrame, step: float, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Operations per grid cell; a cell is named by the numbers of its row and column."""
    return (records.groupBy(F.floor(F.col(lat) / step).alias("celda_lat"),
                            F.floor(F.col(lng) / step).alias("celda_lng"))
            .agg(F.count("*").alias("operaciones")))


def facet_values(rows: DataFrame, columns: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """The distinct values of several columns as sorted rows (faceta, valor).

    One pass: each row is unfolded and made distinct within its task before the
    shuffle, and the sort is over the distinct values only. Falling facets are
    sorted as numbers where they are numbers.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("faceta"), F.col(c).cast("string").alias("valor"))
        for c in columns]))
    values = (rows.select(pairs.alias("p")).select("p.faceta", "p.valor")
              .filter(F.col("valor").isNotNull()).distinct())
    falls = F.col("faceta").isin(list(descending))
    return values.orderBy("faceta", F.when(falls, F.col("valor").try_cast("double")).desc_nulls_last(),
                          F.when(falls, F.col("valor")).desc_nulls_last(), "valor")


def extent(rows: DataFrame, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """Bounding box and mean place of all rows."""
    return rows.agg(*[agg(c).alias(f"{name}_{end}") for name, c in (("lat", lat), ("lng", lng))
                      for end, agg in (("min", F.min), ("max", F.max), ("centro", F.avg))])
