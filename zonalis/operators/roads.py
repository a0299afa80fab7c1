"""Road segments: names, classification by rules, bounds, counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis import config
from zonalis.config import RoadCategory
from zonalis.functions.geo import in_bbox, line_bounds, line_centroid
from zonalis.functions.names import names_from_list, names_from_text
from zonalis.sources.session import constant_frame

_SEPARATOR = "\n"


def rule_frame(spark: SparkSession, categories: Iterable[RoadCategory]) -> DataFrame:
    rows = []
    for c in categories:
        for r in c.rules:
            name = r.name.strip().lower()
            lat, lng = r.lat or (None, None), r.lng or (None, None)
            rows.append((len(rows), ("=" if r.exact else "~") + name, c.key, c.label, c.color,
                         c.weight, r.name, *lat, *lng))
    return constant_frame(spark, rows, """regla int, _match string, categoria string,
        label string, color string, weight int, nombre_via string,
        _lat_min double, _lat_max double, _lng_min double, _lng_max double""")


def with_names(segments: DataFrame, name: str = "name", out: str = "nombres") -> DataFrame:
    is_list = isinstance(segments.schema[name].dataType, T.ArrayType)
    names = names_from_list if is_list else names_from_text
    return segments.withColumn(out, names(F.col(name)))


def _match_keys(names: Column, categories: Iterable[RoadCategory]) -> Column:
    """Keys of all rules a list of names may match: whole names, and parts that occur."""
    parts = sorted({r.name.strip().lower() for c in categories for r in c.rules if not r.exact})
    joined = F.array_join(names, _SEPARATOR)
    found = [F.when(joined.contains(p), F.array(F.lit("~" + p)))
             .otherwise(F.array().cast("array<string>")) for p in parts]
    whole = F.transform(F.array_distinct(names), lambda n: F.concat(F.lit("="), n))
    return F.concat(whole, *found)


def match_rules(segments: DataFrame, categories: Iterable[RoadCategory] = config.ROAD_CATEGORIES,
                geom: str = "geom", names: str = "nombres") -> DataFrame:
    """All (segment, rule) matches: by whole name or part of a name, and by place.

    The rules are a fixed table, joined by hash on the keys of a segment: the
    segments are read once and not shuffled.
    """
    categories = tuple(categories)
    rules = F.broadcast(rule_frame(segments.sparkSession, categories))
    matches = (segments.withColumn("_match", F.explode(_match_keys(F.col(names), categories)))
               .join(rules, "_match"))
    centre = line_centroid(F.col(geom))
    placed = F.when(F.col("_lat_min").isNull(), F.lit(True)).otherwise(in_bbox(
        centre["lat"], centre["lng"], F.col("_lat_min"), F.col("_lat_max"),
        F.col("_lng_min"), F.col("_lng_max")))
    return matches.filter(placed).select(
        *segments.columns, "regla", "categoria", "label", "color", "weight", "nombre_via")


def first_rule_per_geometry(matches: DataFrame, geom: str = "geom",
                            segment: str = "segment_id") -> DataFrame:
    """One row per geometry: the match of the first rule, then of the lowest segment id.

    An aggregation, not a window: copies of a geometry are reduced before the shuffle.
    """
    rest = [c for c in matches.columns if c not in (geom, "regla", segment)]
    best = F.min(F.struct("regla", segment, *rest)).alias("_m")
    return matches.groupBy(geom).agg(best).select(
        *[F.col(geom) if c == geom else F.col(f"_m.{c}") for c in matches.columns])


def classify(segments: DataFrame, categories: Iterable[RoadCategory] = config.ROAD_CATEGORIES,
             name: str = "name", geom: str = "geom", segment: str = "segment_id") -> DataFrame:
    matches = match_rules(with_names(segments, name), categories, geom)
    return first_rule_per_geometry(matches, geom, segment)


def rule_hits(matches: DataFrame, categories: Iterable[RoadCategory] = config.ROAD_CATEGORIES) -> DataFrame:
    """Segments that each rule matched, whatever class they end in; rules without a segment have 0."""
    hits = matches.groupBy("regla").agg(F.count("*").alias("segmentos"))
    rules = rule_frame(matches.sparkSession, categories).select("regla", "categoria", "label", "nombre_via")
    return rules.join(F.broadcast(hits), "regla", "left").withColumn(  # at most one row a rule
        "segmentos", F.coalesce("segmentos", F.lit(0)).cast("long"))


def road_summary(classified: DataFrame) -> DataFrame:
    return classified.groupBy("label").agg(F.count("*").alias("segmentos"))


def with_bounds(segments: DataFrame, geom: str = "geom") -> DataFrame:
    return segments.withColumns(line_bounds(F.col(geom)))


def count_of_name(segments: DataFrame, wanted: str, names: str = "nombres") -> DataFrame:
    """Number of segments that carry a name."""
    return segments.filter(F.array_contains(names, wanted.strip().lower())).agg(
        F.count("*").alias("segmentos"))
