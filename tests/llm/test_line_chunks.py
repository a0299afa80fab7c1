import hashlib
import random
from collections import defaultdict

import pytest

from zonalis.llm import line_chunks as L


def cut(text):
    lines = text.split("\n")
    hs = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % L.MODULUS for x in lines]
    out, start = [], 0
    for i in range(1, len(lines) + 1):
        before = hs[i - 2] if i > 1 else 0
        if i == len(lines) or (before * L.BASE + hs[i - 1]) % L.MODULUS % L.DIVISOR == 0:
            out.append((i - start, "\n".join(lines[start:i])))
            start = i
    return out


def brute(rows):
    places = defaultdict(list)
    for d, t in set(rows):
        for no, (n, c) in enumerate(cut(t) if t is not None else []):
            if n >= L.MIN_LINES:
                places[c].append((d is not None, d or 0, no, t))
    gone = {(p[0], p[1], p[3], p[2]) for ps in places.values() for p in ps if p[:3] != min(ps)[:3]}
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        marked = [(n, c, (d is not None, d or 0, t, no) in gone) for no, (n, c) in enumerate(cut(t))]
        out.append((d, "\n".join(c for _, c, g in marked if not g), sum(g for *_, g in marked),
                    sum(n for n, _, g in marked if g)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    passage = "\n".join(f"shared line {i}" for i in range(12))
    own = lambda k, n: "\n".join(f"own {k} {i}" for i in range(n))
    rows = [(1, f"{own(1, 3)}\n{passage}\n{own(11, 5)}"), (2, f"x\n{passage}"), (3, passage), (4, passage),
            (5, None), (6, ""), (None, f"{passage}\nend"), (7, own(7, 3000) + "\n" + passage), (8, "one line"),
            (9, "one line"), (10, own(2, 4) + "\n" + own(2, 4)), (11, "\n\n\n\n"), (12, "\n\n\n\n"), (3, passage)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, chunk int, gone string")
    got = sorted((tuple(r) for r in L.dedup_line_chunks(df.repartition(5)).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[2] for r in got)
    kept = L.dedup_line_chunks(df, carry=df.columns)
    assert kept.select("carried.*").columns == df.columns
    assert L.dedup_line_chunks(df.limit(0)).count() == 0


def test_chunks_give_the_text_again(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a\nb\n\nc",), ("",), ("\n",), ("x\r\ny",)], "text string")
    joined = F.array_join(F.transform(L.chunked(F.col("text")), lambda c: c["chunk"]), "\n")
    assert df.filter(joined != F.col("text")).count() == 0


def brute_runs(rows):
    """Every line of every two adjacent lines that stand somewhere before, apart from them."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = {}, defaultdict(set)
    for n, (d, t) in enumerate(docs):
        lines = t.split("\n")
        for i, pair in enumerate(zip(lines, lines[1:])):
            m, at = seen.setdefault(pair, (n, i))
            if m < n or i - at >= 2:
                gone[d, t] |= {i, i + 1}
    return sorted(((d, t, 0, 0) if t is None else (
        d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t]),
        sum(i - 1 not in gone[d, t] for i in gone[d, t]), len(gone[d, t])) for d, t in rows), key=repr)


@pytest.mark.parametrize("dedup", [L.dedup_line_runs, L.dedup_line_passages])
def test_every_repeated_run_of_two_lines_goes(spark, dedup):
    own = lambda k, n: "\n".join(f"own {k} {i}" for i in range(n))
    rows = [(None, "x\ny\nz"), (0, None), (1, ""), (2, "one"), (3, "one"), (4, "a\na\na"), (5, "b\nb\nb\nb\nb"),
            (6, "c\nd\nc\nd\nc\nd"), (7, "q\nx\ny\nr"), (7, "q\ny\nx\nr"), (8, own(8, 2000)), (8, own(8, 2000)),
            (9, "\n".join(f"own 8 {i}" for i in range(5, 1900))), (10, "\n\n\n\n")]
    for m in range(2, 20):  # passages of m lines, alone at their places but for foreign lines around them
        passage = "\n".join(f"shared {m} {i}" for i in range(m))
        rows += [(100 + m, f"{own(m, 3)}\n{passage}\n{own(-m, 2)}"), (200 + m, f"head {m}\n{passage}\ntail {m}"),
                 (300 + m, f"{passage}\nhead {m}\nno\n{passage}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in dedup(df.repartition(5)).collect()), key=repr)
    assert got == brute_runs(rows)
    cut = {d: (t, n) for d, t, _, n in got}
    assert all(cut[200 + m] == (f"head {m}\ntail {m}", m) for m in range(2, 20))
    kept = dedup(df, carry=df.columns)
    assert kept.select("carried.*").columns == df.columns
    assert dedup(df.limit(0)).count() == 0


def test_passages_equal_runs_whatever_the_chunks(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), "\n".join(rng.choice("abcdef") * rng.choice([0, 1, 1, 2]) for _ in range(
        rng.choice([1, 2, 3, 10, 40])))) for _ in range(120)]
    block = "\n".join(f"long {i}" for i in range(60))
    rows += [(1000 + i, f"{block}\nend {i}") for i in range(300)] + [(None, None), (7, "")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, no int")
    for divisor in (1, 3, 50):
        got = sorted((tuple(r) for r in L.dedup_line_passages(df.repartition(5), divisor=divisor).collect()), key=repr)
        assert got == brute_runs(rows)


def test_passages_shuffle_digests_not_chunks(spark, monkeypatch):
    """The chunks' texts meet by digest: no column holds them on the way to the joins."""
    seen = []
    monkeypatch.setattr(L, "staged", lambda df, name: seen.append(df) or df)
    rng = random.Random(6)  # one text per id, so that the order of documents is the order of ids
    rows = [(i, "\n".join(rng.choice("abcdef") * rng.choice([0, 1, 1, 2]) for _ in range(rng.choice([1, 2, 3, 10, 40]))))
            for i in range(60)] + [(None, "a\nb\nab\nc"), (99, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in L.dedup_line_passages(df.repartition(5)).collect()), key=repr)
    assert got == brute_runs(rows)
    assert "chunk#" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
