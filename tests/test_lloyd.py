"""Lloyd's iteration: cells against the plain iteration, one task against many, runs that leave."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.operators import clustering, lloyd

KEYS = ("ciudad", "k")


def plain(points, start, iterations, tolerance):
    """Every place against every centroid in every round: (centroids, rounds)."""
    cents = [list(c) for c in start]
    for n in range(1, iterations + 1):
        sums = [[0, 0, 0] for _ in cents]
        for lat, lng, w in points:
            d = [(lat - a) * (lat - a) + (lng - b) * (lng - b) for a, b in cents]
            s = sums[d.index(min(d))]
            s[0] += w
            s[1] += w * round(lat * 10 ** 7)
            s[2] += w * round(lng * 10 ** 7)
        new = [[lloyd.mean_of(s[1], s[0]), lloyd.mean_of(s[2], s[0])] if s[0] else c for s, c in zip(sums, cents)]
        shift = max((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(new, cents))
        cents = new
        if shift <= tolerance ** 2:
            break
    return cents, n


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    points = {"A": [], "B": []}
    for city, n in (("A", 900), ("B", 250)):
        seen = set()
        for _ in range(n):
            lat, lng = np.round(rng.normal(rng.integers(0, 4), 0.4), 3), np.round(rng.normal(rng.integers(0, 3), 0.4), 3)
            if (lat, lng) not in seen:
                seen.add((lat, lng))
                points[city].append((float(lat), float(lng), int(rng.integers(1, 9))))
    points["A"] += [(50.0, 50.0, 1), (-0.0005, 70.0, 3)]
    starts = {(c, k): [points[c][i][:2] for i in range(0, 7 * k, 7)] for c in "AB" for k in (1, 2, 5, 9)}
    starts["A", 9][4] = starts["A", 9][3]  # equal centroids: the first takes all
    return points, starts


@pytest.mark.parametrize("per_task,cell", [(None, 32), (200, 4)])
def test_same_centroids_as_the_plain_iteration(spark, data, monkeypatch, per_task, cell):
    monkeypatch.setattr(lloyd, "CELL", cell)
    points, starts = data
    spots = spark.createDataFrame([(c, *p) for c, ps in points.items() for p in ps],
                                  "ciudad string, lat double, lng double, peso long").repartition(5)
    start = spark.createDataFrame([(c, k, i, *map(float, p)) for (c, k), ps in starts.items() for i, p in enumerate(ps)]
                                  + [("C", 1, 0, 3.0, 4.0)],
                                  "ciudad string, k int, cluster_id int, centroide_lat double, centroide_lng double")
    got = lloyd.iterate(spots, start, KEYS, 60, 1e-6, per_task).collect()
    for (city, k), ps in starts.items():
        cents, rounds = plain(points[city], ps, 60, 1e-6)
        mine = sorted((r for r in got if (r["ciudad"], r["k"]) == (city, k)), key=lambda r: r["cluster_id"])
        assert [[r["centroide_lat"], r["centroide_lng"]] for r in mine] == cents
        assert {r["iteraciones"] for r in mine} == {rounds}
    assert [(r["centroide_lat"], r["iteraciones"], r["converge"]) for r in got if r["ciudad"] == "C"] == [(3.0, 0, True)]
    # Runs leave at different rounds.
    assert len({r["iteraciones"] for r in got}) > 2


def test_most_places_are_not_measured():
    rng = np.random.default_rng(2)
    lat, lng = rng.uniform(0, 1, 20_000).round(7), rng.uniform(0, 1, 20_000).round(7)
    units = [np.round(x * lloyd.UNIT).astype(np.int64) for x in (lat, lng)]
    places = lloyd.Places(lat, lng, *units, np.ones(20_000, np.int64))
    sums, measured = places.members(lat[:10], lng[:10])
    assert sums[:, 0].sum() == 20_000 and measured < 10_000
    nearest = ((lat[:, None] - lat[:10]) ** 2 + (lng[:, None] - lng[:10]) ** 2).argmin(axis=1)
    assert np.array_equal(sums[:, 0], np.bincount(nearest, minlength=10))
    heavy = lloyd.Places(lat[:50], lng[:50], units[0][:50], units[1][:50], np.full(50, 10 ** 12))
    assert heavy.members(lat[:2], lng[:2])[0][:, 1].sum() == 10 ** 12 * int(units[0][:50].sum())


def test_runs_tell_whether_they_ended(spark, data):
    points, starts = data
    spots = spark.createDataFrame([("A", *p) for p in points["A"]], "ciudad string, lat double, lng double, peso long")
    start = spark.createDataFrame([("A", i, *map(float, p)) for i, p in enumerate(starts["A", 5])],
                                  "ciudad string, cluster_id int, centroide_lat double, centroide_lng double")
    with pytest.warns(UserWarning, match="1 runs still moved"):
        cut = clustering.lloyd_runs(spots, start, iterations=2)
    assert cut.select("iteraciones", "converge").distinct().collect() == [(2, False)]
    whole = clustering.lloyd_runs(spots, start).select("converge", F.col("iteraciones") > 2).distinct().collect()
    assert whole == [(True, True)]
