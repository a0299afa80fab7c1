import hashlib

import numpy as np

from zonalis.llm import suffix_repeats as S
from zonalis.llm.queries import op1_suffix_repeats


def brute(rows):
    data = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, x in data:
        for p in range(len(x) - 49 if d is not None else 0):
            first[x[p:p + 50]] = min(first.get(x[p:p + 50], d), d)
    out = []
    for d, x in data:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 49 if d is not None else 0):
            if first[x[p:p + 50]] < d:
                gone[p:p + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((d, len(x), int(gone.sum()), len(edges) // 2, kept))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept))
                   for r in S.repeated_spans(df).collect()), key=repr)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    text = lambda n, letters="abcdefgh é": "".join(rng.choice(list(letters), n))
    passage, other = text(300), text(90)
    rows = []
    for d in range(40):
        cut = rng.integers(0, 200)
        rows.append((d * 3 % 41, text(60) + passage[cut:cut + rng.integers(20, 300)] + text(30) + other[:rng.integers(90)]))
    rows += [(100, passage), (101, passage), (102, passage + passage), (103, other), (104, None), (105, ""), (106, "x" * 49),
             (107, "x" * 50), (108, "x" * 500), (109, "y" + "x" * 80), (110, "ab" * 300), (111, "ba" * 300), (-5, other),
             (None, passage), (112, text(3, "\0a") + "\0" * 200), (113, "\0" * 90 + passage), (100, passage),
             (114, text(200_000, "xyz") + passage), (115, text(150_000, "xyz"))]
    df = spark.createDataFrame([(*r, "b", 1) for r in rows], "doc_id long, text string, kept string, block int")
    assert found(df.repartition(5)) == brute(rows)


def test_empty_table(spark):
    assert S.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_table_of_short_texts(spark):
    rows = [(1, ""), (2, None), (3, "short"), (4, "short")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_intervals_of_a_small_array():
    assert sorted(S.intervals(np.array([0, 3, 3, 1, 2]))) == [(1, 0, 4, 0), (2, 3, 4, 1), (3, 0, 2, 1)]


def test_long_repeated_letters():
    runs = S.Runs(["a" * 1000, "", "b" * 49, "c" * 50])
    assert len(runs.anchor) == 952 and set(runs.doc.tolist()) == {0, 3}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op1_suffix_repeats(spark, folder).collect()), key=repr)
    assert got == sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows)), key=repr)
