import math

import numpy as np
import pytest

from zonalis.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, n long, x string, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, components=W.COMPONENTS):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = [[math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in good]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    c = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)[:components]
    return [i for i, _ in good], deviation, c @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("block_bytes,width", [(1, 8), (1 << 21, 40)])
def test_against_brute_force(spark, monkeypatch, block_bytes, width):
    monkeypatch.setattr(W, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(W, "BLOCKS_PER_SPLIT", 2)
    rng = np.random.default_rng(width)
    mixed = rng.normal(size=(width, width))
    rows = [(i, (rng.normal(size=width) @ mixed).tolist()) for i in range(500)]
    rows += [(900, None), (901, [None] + [1.0] * (width - 1)), (902, [math.nan] * width), (903, [math.inf] * width),
             (904, [1.0, 2.0]), (None, rows[3][1]), (5, rows[6][1]), (5, rows[6][1])]
    ids, deviation, white, shares = brute(rows)
    got = W.whiten(frame(spark, rows)).collect()
    k = min(width, 32)
    assert len(got) == len(ids) * k
    assert {(r.n, r.identity_error < 1e-9) for r in got} == {(len(ids), True)}
    assert sorted(d for d in deviation for _ in range(k)) == sorted(r.deviation for r in got)
    assert all(r.deviation == int(r.deviation_exact) for r in got)
    for c in range(1, k + 1):
        mine = {}
        for r in got:
            if r.component == c:
                assert r.explained == pytest.approx(shares[c - 1], rel=1e-9)
                mine.setdefault(r.vec_id, []).append(r.whitened)
        want = {}
        for i, w in zip(ids, white[:, c - 1]):
            want.setdefault(i, []).append(w)
        sign = np.sign(mine[0][0] * want[0][0])
        assert mine.keys() == want.keys()
        for i in want:
            assert sorted(mine[i]) == pytest.approx(sorted(sign * w for w in want[i]), abs=1e-7)


def test_empty_flat_and_large(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    got = W.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [
        (c, 2, 0, None, 0.0, 0.0) for c in (1, 1, 2, 2)]
    rank_one = sorted(W.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(10)])).collect())
    assert [r.explained for r in rank_one[:2]] == [pytest.approx(1.0), pytest.approx(0.0, abs=1e-9)]
    assert [r.whitened is None for r in rank_one[:2]] == [False, True]
    # Sums of squares beyond 64 bits keep their digits; entries beyond 64 bits take no part.
    rows = [(1, [2.0 ** 40, 0.0]), (2, [-(2.0 ** 40), 3.0]), (3, [1e300, 1.0]), (4, [5.0, 7.0])]
    got = W.whiten(frame(spark, rows)).filter("component = 1").orderBy("vec_id").collect()
    want = brute([r for r in rows if r[0] != 3])[1]
    assert [(r.vec_id, int(r.deviation_exact), r.deviation) for r in got] == [
        (i, d, d if d < 1 << 63 else None) for i, d in zip((1, 2, 4), want)]
