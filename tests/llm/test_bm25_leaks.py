import numpy as np
import pytest

from zonalis.llm import bm25_leaks as L
from zonalis.llm import queries


def items(n=70, seed=2):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{min(int(rng.zipf(1.3)), 4000)}"
    return [(i, " ".join(word() for _ in range(rng.integers(12, 40))) + ". " + " ".join(word() for _ in range(6)) + ".")
            for i in range(n)]


@pytest.mark.parametrize("entries", [L.ENTRIES, 50])
def test_search_finds_all_above_the_threshold(monkeypatch, entries):
    monkeypatch.setattr(L, "ENTRIES", entries)
    given = items()
    freq = {}
    for _, t in given:
        for w in set(L.words_of(t)):
            freq[w] = freq.get(w, 0) + 1
    index = L.Index(given, freq, len(given), np.mean([len(L.words_of(t)) for _, t in given]))
    weights = np.zeros((len(index.terms), len(given)))
    for t, (where, x) in enumerate(zip(index.items, index.weights, strict=True)):
        weights[t, where] = x
    assert np.allclose(weights.sum(axis=0), 1)
    rng = np.random.default_rng(0)
    hits = 0
    for _ in range(300):
        words = L.words_of(given[rng.integers(len(given))][1])
        keep = [w for w in words if rng.random() < 0.7] + [f"w{x}" for x in rng.integers(1, 400, 20)]
        terms = np.unique([index.terms[w] for w in keep if w in index.terms])
        full = weights[terms].sum(axis=0)
        for threshold in (0.3, 0.6):
            want = {i: s for i, s in enumerate(full) if s >= threshold - L.EPSILON}
            got = dict(index.search(terms, threshold))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)
            hits += len(got)
    assert hits > 300


def test_leaks(spark):
    given = items(40)
    filler = " ".join(f"f{i}" for i in range(5000))
    docs = [(1, f"{filler} {given[3][1]} {filler}"), (2, given[5][1].upper().replace(" ", "\n")), (3, filler), (4, None), (5, ""),
            (6, given[7][1].split(". ")[0]), (None, given[9][1]), (1, given[3][1]), (8, given[3][1] + " " + given[4][1])]
    df = spark.createDataFrame([(*d, 0.5, 3) for d in docs], "doc_id long, text string, score double, item_id int")
    bench = spark.createDataFrame([*given, (90, None), (91, ""), (None, "a b"), (92, "...")], "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.item_id) for r in L.leaks(df, bench).collect()))
    assert got == [(0, 9), (1, 3), (1, 3), (2, 5), (8, 3), (8, 4)]
    assert L.leaks(df, bench.limit(0)).count() == 0 and L.leaks(df.limit(0), bench).count() == 0


def test_slices_agree(spark, monkeypatch):
    given = items(60)
    df = spark.createDataFrame([(i, t + " more words") for i, t in given], "doc_id long, text string")
    bench = spark.createDataFrame(given, "item_id long, text string")
    whole = sorted(map(tuple, L.leaks(df, bench).collect()))
    monkeypatch.setattr(L, "INDEX_BYTES", 2000)
    assert sorted(map(tuple, L.leaks(df, bench).collect())) == whole and len(whole) >= 60
    clean = spark.createDataFrame([(None, "w1 w2", 1), (7, None, 2), (7, "", 3), (8, "other words", 4)],
                                  "doc_id long, text string, score int")
    mixed = clean.union(df.withColumn("score", df["doc_id"].cast("int")))
    assert sorted(map(repr, L.without_leaks(mixed, bench).collect())) == sorted(map(repr, clean.collect()))


def test_items_without_an_id_are_found(spark):
    given = items(6)
    bench = spark.createDataFrame([*given[:4], (None, given[4][1]), (None, given[5][1])], "item_id long, text string")
    df = spark.createDataFrame([(1, given[4][1]), (2, given[5][1]), (3, given[0][1])], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in L.leaks(df, bench).collect()))
    assert got == [(1, None), (2, None), (3, 0)]


def plain(docs, given):
    """Every window scored with every item by the plain formula, then verified: (document, item, score)."""
    mean = np.mean([len(L.words_of(t)) for _, t in given])
    holders = {}
    for _, t in given:
        for w in set(L.words_of(t)):
            holders[w] = holders.get(w, 0) + 1
    stride = max(L.STRIDE, max(len(L.words_of(t)) for _, t in given))
    out = []
    for d, text in docs:
        words = L.words_of(text)
        windows = [words[s:s + 2 * stride] for s in range(0, max(1, len(words) - stride), stride)]
        sets = [set(w) for w in windows]
        for i, t in given:
            mine = L.words_of(t)
            norm = L.K1 * (1 - L.B + L.B * len(mine) / mean)
            weight = {w: np.log(1 + (len(given) - holders[w] + 0.5) / (holders[w] + 0.5)) * mine.count(w) * (L.K1 + 1)
                      / (mine.count(w) + norm) for w in set(mine)}
            own = sum(weight.values())
            question, answer = map(L.grams_of, L.question_and_answer(t))
            found = [score for window, there in zip(windows, sets)
                     if (score := sum(weight[w] for w in weight.keys() & there) / own) >= L.THRESHOLD - 1e-9
                     and min(L.share_found(question, window), L.share_found(answer, window)) >= L.OVERLAP]
            if found:
                out.append((d, i, round(max(found), 6)))
    return sorted(out)


def test_query_against_plain_formula(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    given = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = sorted((r.doc_id, r.item_id, round(r.score, 6)) for r in queries.op3_bm25_leaks(spark, folder).collect())
    assert got == plain(docs, [(i, t) for i, t in given if L.words_of(t)]) and got
