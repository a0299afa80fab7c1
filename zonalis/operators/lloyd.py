"""Lloyd's iteration for many K-means runs over the places of many cities.

Places lie in cells of near neighbours with exact sums of weight and coordinates. A cell whose whole rectangle lies on one
centroid's side of the lines halfway to all others belongs to it as a whole; only the places of other cells are measured. Coordinates are summed as whole numbers of the seventh decimal, so centroids do not depend on how places are spread.

A run leaves when its centroids stay. All runs of a city whose places fit one task are iterated there to their end;
the places of larger cities lie in several tasks, and one job an iteration adds up the sums of all runs that still move.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators.lookups import broadcast_if_small
from zonalis.sources.session import constant_frame, shuffle_parts, staged

PLACES_PER_TASK = 200_000
CELL = 32
DECIMALS = 7
UNIT = 10 ** DECIMALS
SAFE_WEIGHT = 4_000_000_000  # up to this weight, sums of coordinates fit 64 bits
SLACK = 1e-9


def mean_of(total: int, weight: int) -> float:
    """The mean of coordinates in units of the seventh decimal, to seven decimals, halves away from zero."""
    value = total / UNIT / weight
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-DECIMALS), ROUND_HALF_UP))


class Places:
    """Places of one task in cells along a curve through nearby places."""

    def __init__(self, lat: np.ndarray, lng: np.ndarray, lat_units: np.ndarray, lng_units: np.ndarray,
                 weight: np.ndarray):
        order = _curve(lat, lng)
        self.lat, self.lng = lat[order], lng[order]
        kind = np.int64 if int(weight.sum(dtype=object) if len(weight) else 0) <= SAFE_WEIGHT else object
        weight = weight[order].astype(kind)
        self.sums = np.stack([weight, weight * lat_units[order].astype(kind), weight * lng_units[order].astype(kind)], axis=1)
        self.first = np.arange(0, len(lat), CELL)
        self.size = np.diff(np.append(self.first, len(lat)))
        if len(lat):
            self.cells = np.add.reduceat(self.sums, self.first, axis=0)
            low, high = ([f.reduceat(x, self.first) for x in (self.lat, self.lng)] for f in (np.minimum, np.maximum))
            self.centre = [(a + b) / 2 for a, b in zip(low, high, strict=True)]
            self.half = [(b - a) / 2 for a, b in zip(low, high, strict=True)]

    def members(self, lat: np.ndarray, lng: np.ndarray) -> tuple[np.ndarray, int]:
        """Weight and sums of coordinates of the places next to each centroid, ties to the first; and places measured."""
        out = np.zeros((len(lat), 3), self.sums.dtype)
        if not len(self.lat):
            return out, 0
        far = _squares(*self.centre, lat, lng)
        owner = far.argmin(axis=1)
        # How much nearer than the owner another centroid can be in a corner of the cell.
        best = far[np.arange(len(owner)), owner]
        reach = sum(np.abs(c - c[owner][:, None]) * h[:, None] for c, h in zip((lat, lng), self.half, strict=True))
        whole = far - best[:, None] > 2 * reach * (1 + SLACK) + SLACK
        whole[np.arange(len(owner)), owner] = True
        whole = whole.all(axis=1)
        open_ = np.flatnonzero(~whole)
        np.add.at(out, owner[whole], self.cells[whole])
        size = self.size[open_]
        at = np.arange(size.sum()) + np.repeat(self.first[open_] - (np.cumsum(size) - size), size)
        np.add.at(out, _squares(self.lat[at], self.lng[at], lat, lng).argmin(axis=1), self.sums[at])
        return out, len(at)


def _squares(lat: np.ndarray, lng: np.ndarray, to_lat: np.ndarray, to_lng: np.ndarray) -> np.ndarray:
    dlat, dlng = lat[:, None] - to_lat, lng[:, None] - to_lng
    return dlat * dlat + dlng * dlng


def _curve(lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    """An order in which near places follow each other: 16 bits of each coordinate, interleaved."""
    key = np.zeros(len(lat), np.uint64)
    for shift, x in enumerate((lat, lng)):
        low, high = (x.min(), x.max()) if len(x) else (0.0, 0.0)
        at = ((x - low) / ((high - low) or 1.0) * 65535).astype(np.uint64)
        for bit in range(16):
            key |= ((at >> np.uint64(bit)) & np.uint64(1)) << np.uint64(2 * bit + shift)
    return np.lexsort((lng, lat, key))


def moved(sums: np.ndarray, lat: np.ndarray, lng: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The next centroids and how far (squared) one of them moved at most; a centroid without places stays."""
    new = [(mean_of(int(s[1]), int(s[0])), mean_of(int(s[2]), int(s[0]))) if s[0] else (float(a), float(b))
           for s, a, b in zip(sums, lat, lng, strict=True)]
    to_lat, to_lng = np.array([p[0] for p in new]), np.array([p[1] for p in new])
    dlat, dlng = to_lat - lat, to_lng - lng
    return to_lat, to_lng, float((dlat * dlat + dlng * dlng).max(initial=0.0))


@dataclass
class Run:
    """One K-means run: its centroids in the order of their ids, and how it went."""

    number: int
    ids: list[int]
    lat: np.ndarray
    lng: np.ndarray
    iterations: int = 0
    shift: float = float("inf")

    def step(self, sums: np.ndarray) -> None:
        self.lat, self.lng, self.shift = moved(sums, self.lat, self.lng)
        self.iterations += 1

    def rows(self) -> list[tuple]:
        return [(self.number, c, float(a), float(b), self.iterations, self.shift)
                for c, a, b in zip(self.ids, self.lat, self.lng, strict=True)]


FOUND = "_run long, cluster_id int, centroide_lat double, centroide_lng double, iteraciones int, _shift double"
PACKED = "ciudad string, _part int, _lat binary, _lng binary, _lat_units binary, _lng_units binary, _peso binary"


def packed(spots: DataFrame, sizes: DataFrame) -> DataFrame:
    """Places as bytes, one row per city and part; ``sizes`` (ciudad, _parts) has the cities of all runs."""
    def units(c: str):
        return (F.col(c).cast(f"decimal(10,{DECIMALS})") * UNIT).cast("long")

    part = F.pmod(F.xxhash64("lat", "lng"), F.col("_parts")).cast("int")
    rows = spots.join(broadcast_if_small(sizes), "ciudad").select(
        "ciudad", part.alias("_part"), F.col("lat").cast("double"), F.col("lng").cast("double"), units("lat").alias("_a"),
        units("lng").alias("_b"), F.col("peso").cast("long"))

    def pack(table: pa.Table) -> pa.Table:
        raw = [pa.array([np.ascontiguousarray(c.to_numpy()).tobytes()], pa.binary()) for c in table.columns[2:]]
        return pa.Table.from_arrays([pa.array([table["ciudad"][0].as_py()], pa.string()),
                                     pa.array([table["_part"][0].as_py()], pa.int32()), *raw],
                                    names=["ciudad", "_part", "_lat", "_lng", "_lat_units", "_lng_units", "_peso"])

    return rows.groupBy("ciudad", "_part").applyInArrow(pack, PACKED)


def _places(raw: Sequence[bytes]) -> Places:
    return Places(*[np.frombuffer(b, t) for b, t in zip(raw, ("<f8", "<f8", "<i8", "<i8", "<i8"), strict=True)])


def _run(number: int, cents: Sequence[dict]) -> Run:
    return Run(number, [c["id"] for c in cents], np.array([c["lat"] for c in cents]), np.array([c["lng"] for c in cents]))


def _in_tasks(blocks: DataFrame, starts: DataFrame, iterations: int, tolerance: float) -> DataFrame:
    """Runs of cities of one part each, several runs of a city to a task."""
    spread = shuffle_parts(blocks.sparkSession)
    groups = (starts.groupBy("ciudad", F.pmod(F.xxhash64("_run"), F.lit(spread)).alias("_g"))
              .agg(F.collect_list(F.struct("_run", "_cents")).alias("_runs")))
    # One row per city and group of runs; a city's places are at most PLACES_PER_TASK.
    pairs = groups.join(blocks, "ciudad").select("_lat", "_lng", "_lat_units", "_lng_units", "_peso", "_runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places = _places([batch.column(c)[i].as_py() for c in range(5)])
                for one in batch.column(5)[i].as_py():
                    state = _run(one["_run"], one["_cents"])
                    while state.iterations < iterations and state.shift > tolerance ** 2:
                        state.step(places.members(state.lat, state.lng)[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*state.rows(), strict=True), TYPES, strict=True)],
                        names=[f.split()[0] for f in FOUND.split(", ")])

    return pairs.repartition(spread).mapInArrow(run, FOUND)


TYPES = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64())


def _together(blocks: DataFrame, starts: DataFrame, iterations: int, tolerance: float) -> list[tuple]:
    """Runs of cities of several parts: one job an iteration; the centroids of these runs are on the driver."""
    runs = {r["_run"]: (r["ciudad"], _run(r["_run"], [c.asDict() for c in r["_cents"]])) for r in starts.collect()}
    for _ in range(iterations):
        moving = {n: (city, r.lat, r.lng) for n, (city, r) in runs.items() if r.shift > tolerance ** 2}
        if not moving:
            break

        def add(batches: Iterator[pa.RecordBatch], moving=moving) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    city = batch.column(0)[i].as_py()
                    places = _places([batch.column(c)[i].as_py() for c in range(2, 7)])
                    for n, (of, lat, lng) in moving.items():
                        if of == city:
                            sums = places.members(lat, lng)[0]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([n] * len(lat), pa.int64()), pa.array(range(len(lat)), pa.int32()),
                                 *[pa.array([str(v) for v in sums[:, c]], pa.string()) for c in range(3)]],
                                names=["_run", "_at", "_w", "_a", "_b"])

        sums = (blocks.mapInArrow(add, "_run long, _at int, _w string, _a string, _b string").groupBy("_run", "_at")
                .agg(*[F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("_w", "_a", "_b")]).collect())
        by_run: dict[int, np.ndarray] = {n: np.zeros((len(v[1]), 3), object) for n, v in moving.items()}
        for r in sums:
            by_run[r["_run"]][r["_at"]] = [int(r["_w"]), int(r["_a"]), int(r["_b"])]
        for n, total in by_run.items():
            runs[n][1].step(total)
    return [row for _, r in runs.values() for row in r.rows()]


def iterate(spots: DataFrame, start: DataFrame, keys: Sequence[str], iterations: int, tolerance: float,
            places_per_task: int | None = None) -> DataFrame:
    """Centroids of all runs (``keys``, which hold ``ciudad``) after their last iteration, with ``iteraciones`` and ``converge``.

    ``start`` has ``cluster_id``, ``centroide_lat``, ``centroide_lng``. A run ends when none of its centroids moves
    further than ``tolerance`` degrees, or after ``iterations``. A city without places keeps its centroids.
    """
    spark, keys = spots.sparkSession, list(keys)
    member = F.struct(F.col("cluster_id").cast("int").alias("id"), F.col("centroide_lat").cast("double").alias("lat"),
                      F.col("centroide_lng").cast("double").alias("lng"))
    starts = staged(start.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias("_cents"))
                    .withColumn("_run", F.monotonically_increasing_id()), "runs")
    per_task = places_per_task or PLACES_PER_TASK
    sizes = staged(spots.groupBy("ciudad").agg(F.ceil(F.count("*") / per_task).cast("int").alias("_parts"))
                   .join(starts.select("ciudad").distinct(), "ciudad", "left_semi"), "sizes")
    blocks = staged(packed(spots, sizes), "blocks")
    large = sizes.filter("_parts > 1").select("ciudad")
    found = staged(_in_tasks(blocks.join(large, "ciudad", "left_anti"),
                             starts.join(large, "ciudad", "left_anti"), iterations, tolerance), "iterated")
    if large.limit(1).count():
        ended = _together(blocks.join(large, "ciudad", "left_semi"), starts.join(large, "ciudad", "left_semi"),
                          iterations, tolerance)
        found = found.unionByName(constant_frame(spark, ended, FOUND))
    still = starts.join(sizes.select("ciudad"), "ciudad", "left_anti").select("_run", F.explode("_cents").alias("c")).select(
        "_run", F.col("c.id").alias("cluster_id"), F.col("c.lat").alias("centroide_lat"),
        F.col("c.lng").alias("centroide_lng"), F.lit(0).alias("iteraciones"), F.lit(0.0).alias("_shift"))
    return (found.unionByName(still).join(starts.select("_run", *keys), "_run")
            .select(*keys, "cluster_id", "centroide_lat", "centroide_lng", "iteraciones",
                    F.sqrt("_shift").alias("movimiento"), (F.col("_shift") <= tolerance ** 2).alias("converge")))
