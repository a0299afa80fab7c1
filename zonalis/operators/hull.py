"""Convex hull per group of points.

The hull of a union is the hull of the hulls, so the points of a group are never
in one task: points well inside are dropped first, every partition reduces what
is left, then parts of a group, then the group. Coordinates are whole numbers of
the last stored decimal, so the turns are exact and the result does not depend
on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.operators.lookups import lookup_join
from zonalis.sources.session import shuffle_parts

# Coordinates are stored with seven decimals.
UNITS_PER_DEGREE = 10_000_000
# Points a task holds before it reduces them to their hulls.
BUFFERED_POINTS = 200_000
# Corners of a group in eight directions, counter-clockwise from the lowest x.
DIRECTIONS = ((-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1))
# Above the rounding of products of coordinate differences of up to 360 degrees.
SURELY_INSIDE = 10_000.0

Point = tuple[int, int]


def _chain(points: Sequence[Point]) -> list[Point]:
    """Lower chain of points sorted by (x, y)."""
    kept: list[Point] = []
    for p in points:
        while len(kept) > 1:
            (ax, ay), (bx, by) = kept[-2:]
            if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                break
            kept.pop()
        kept.append(p)
    return kept


def hull_vertices(points: Sequence[Point]) -> list[Point]:
    """Vertices counter-clockwise from the lowest (x, y); ends only for points on a line."""
    points = sorted(set(points))
    if len(points) < 3:
        return points
    return _chain(points)[:-1] + _chain(points[::-1])[:-1]


def _inside(corners: Sequence[Column], x: Column, y: Column) -> Column:
    """Whether a point lies inside the polygon of the corners, beyond doubt; equal corners make no side."""
    sides = []
    for a, b in zip(corners, [*corners[1:], corners[0]]):
        turn = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        sides.append((turn > SURELY_INSIDE) | (a == b))
    proper = corners[0] != corners[4]
    return proper & reduce(lambda p, q: p & q, sides)


def _outer_points(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The points that may be vertices: those outside the octagon of their group's extremes."""
    x, y = F.col("_x").cast("double"), F.col("_y").cast("double")
    place = F.struct(x.alias("x"), y.alias("y"))
    names = [f"_corner{i}" for i in range(len(DIRECTIONS))]
    # Ties go to one of the places, by their order.
    corners = units.groupBy(*keys).agg(*[
        F.max(F.struct((x * dx + y * dy).alias("d"), place.alias("p")))["p"].alias(n)
        for n, (dx, dy) in zip(names, DIRECTIONS)])
    return (lookup_join(units, corners, keys)
            .filter(~F.coalesce(_inside([F.col(n) for n in names], x, y), F.lit(False)))
            .select(*keys, "_x", "_y"))


def group_hulls(points: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Hull vertices per group in order: keys, ``orden``, x, y, with seven decimals.

    Points with a null are left out, as are groups with fewer than three places
    or all on one line.
    """
    keys = list(keys)
    needed = points.select(*keys, x, y).dropna()
    units = needed.select(*keys, *[
        F.round(F.col(c).cast("double") * UNITS_PER_DEGREE).cast("bigint").alias(n)
        for c, n in ((x, "_x"), (y, "_y"))])
    outer = _outer_points(units, keys)
    columns = [*keys, "_x", "_y"]

    def places(frame: pd.DataFrame) -> list[Point]:
        return list(zip(frame["_x"].tolist(), frame["_y"].tolist()))

    def reduced(frame: pd.DataFrame) -> pd.DataFrame:
        found = [(*(key if isinstance(key, tuple) else (key,)), *v)
                 for key, group in frame.groupby(keys, sort=False) for v in hull_vertices(places(group))]
        return pd.DataFrame({c: pd.Series([f[i] for f in found], dtype=object) for i, c in enumerate(columns)})

    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += len(batch)
            if waiting > BUFFERED_POINTS:
                held, waiting = [reduced(pd.concat(held, ignore_index=True))], 0
        if held:
            yield reduced(pd.concat(held, ignore_index=True))

    def per_group(group: pd.DataFrame) -> pd.DataFrame:
        v = hull_vertices(places(group))
        found = v if len(v) > 2 else []
        return pd.DataFrame({**{k: pd.Series([group[k].iloc[0]] * len(found), dtype=object) for k in keys},
                             "orden": pd.Series(range(len(found)), dtype="int32"),
                             x: [px / UNITS_PER_DEGREE for px, _ in found],
                             y: [py / UNITS_PER_DEGREE for _, py in found]})

    schema = outer.schema
    parts = shuffle_parts(points.sparkSession)
    local = outer.mapInPandas(per_partition, schema)
    spread = local.repartition(parts, F.pmod(F.xxhash64("_x", "_y"), F.lit(parts)))
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema.fields[:-2]]
                    + ["orden int", f"{x} double", f"{y} double"])
    return spread.mapInPandas(per_partition, schema).groupBy(*keys).applyInPandas(per_group, ddl)
