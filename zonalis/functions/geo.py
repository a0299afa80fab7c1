"""Expressions on coordinates and on line geometry (``array<struct<lng,lat>>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Squared distance in degrees: the same order as the Euclidean distance, without the root."""
    dlat, dlng = lat1 - lat2, lng1 - lng2
    return dlat * dlat + dlng * dlng


def distance(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    return F.sqrt(squared_distance(lat1, lng1, lat2, lng2))


def in_bbox(lat: Column, lng: Column, lat_min: Column, lat_max: Column,
            lng_min: Column, lng_max: Column) -> Column:
    return lat.between(lat_min, lat_max) & lng.between(lng_min, lng_max)


def line_bounds(geom: Column) -> dict[str, Column]:
    lngs, lats = geom.getField("lng"), geom.getField("lat")
    return {
        "lng_min": F.array_min(lngs), "lng_max": F.array_max(lngs),
        "lat_min": F.array_min(lats), "lat_max": F.array_max(lats),
    }


def multi_line_points(multi: Column) -> Column:
    """All points of a line made of several parts."""
    return F.flatten(multi)


def line_centroid(geom: Column) -> Column:
    """Length-weighted centroid of a line; a line without length has its first point."""
    n = F.size(geom)
    steps = F.when(n > 1, F.zip_with(
        F.slice(geom, 1, n - 1), F.slice(geom, 2, n - 1),
        lambda a, b: F.struct(
            distance(a["lat"], a["lng"], b["lat"], b["lng"]).alias("w"),
            ((a["lng"] + b["lng"]) / 2).alias("lng"),
            ((a["lat"] + b["lat"]) / 2).alias("lat"),
        )))
    total = F.aggregate(
        steps,
        F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("lng"), F.lit(0.0).alias("lat")),
        lambda acc, s: F.struct(
            (acc["w"] + s["w"]).alias("w"),
            (acc["lng"] + s["w"] * s["lng"]).alias("lng"),
            (acc["lat"] + s["w"] * s["lat"]).alias("lat"),
        ),
        lambda acc: F.when(acc["w"] > 0, F.struct(
            (acc["lng"] / acc["w"]).alias("lng"), (acc["lat"] / acc["w"]).alias("lat"))),
    )
    first = F.get(geom, F.lit(0))
    return F.coalesce(total, F.when(first.isNotNull(), F.struct(
        first["lng"].alias("lng"), first["lat"].alias("lat"))))
