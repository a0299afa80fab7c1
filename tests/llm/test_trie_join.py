import re
from collections import defaultdict

import numpy as np
import pytest

from zonalis.llm import trie_join as J
from zonalis.llm.queries import op9_trie_join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(id, set size, component) by comparing every two documents that share a shingle."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, (d, s) in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in where[g]:
                if j > i:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j][1]) - c):
                a, b = sorted((find(d), find(sets[j][0])))
                parent[b] = a
    out = {d: (d, max(len(s) for e, s in sets if e == d), find(d)) for d, _ in sets}
    return sorted(out.values()) + ([(None, None, None)] if any(d is None for d, _ in rows) else [])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def near_copies(rng, n_bases, copies, words):
    rows = []
    for base in range(n_bases):
        text = [f"w{x}" for x in rng.integers(0, 300, words)]
        for _ in range(copies):
            mine = list(text)
            for at in rng.integers(0, words, rng.integers(0, 4)):
                mine[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(mine)))
    return rows


@pytest.mark.parametrize("cell_tokens", [2_000_000, 3000])
def test_against_brute_force(spark, monkeypatch, cell_tokens):
    monkeypatch.setattr(J, "CELL_TOKENS", cell_tokens)
    rng = np.random.default_rng(3)
    rows = near_copies(rng, 12, 12, 120)
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one two"), (504, "ONE\x0btwo"), (505, "one two three"),
             (506, "É a b c d"), (507, "é a b c d"), (508, "x " * 30000), (509, "x x x x x x"), (None, "one two"),
             (510, rows[0][1]), (3, rows[3][1]), (511, "one two"), (512, rows[20][1] + " " + rows[40][1]), (7, "one two")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, block int, component_id string")
    assert rows_of(J.ngram_components(df.repartition(6))) == brute(rows)


def test_empty_table(spark):
    assert J.ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_table_without_a_word(spark):
    rows = [(1, ""), (2, None), (3, " "), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(J.ngram_components(df)) == brute(rows)


def test_trie_finds_every_component():
    rng = np.random.default_rng(9)
    for _ in range(40):
        base = [np.unique(rng.integers(0, 1 << 60, 40, np.int64)).astype(np.uint64) for _ in range(3)]
        sets = [np.unique(np.concatenate((rng.choice(b, rng.integers(25, 41), replace=False),
                                          rng.integers(0, 1 << 60, rng.integers(0, 6), np.int64).astype(np.uint64))))
                for b in base for _ in range(8)]
        links, roots = J.trie_join(sets)
        parent = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if J.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                    low, high = sorted((parent[i], parent[j]))
                    parent = [low if x == high else x for x in parent]
        assert len({*zip(parent, roots.tolist(), strict=True)}) == len(set(parent)) == len(set(roots.tolist()))


def test_a_set_meets_only_sets_with_its_rare_grams(monkeypatch):
    """One gram that all sets share does not make every set walk past every other one."""
    rng = np.random.default_rng(5)
    base = [np.unique(np.append(rng.integers(2, 1 << 60, 30, np.int64), 1)).astype(np.uint64) for _ in range(150)]
    sets = [s for b in base for s in (b, b[:-1])]
    seen = []
    entered = np.count_nonzero
    monkeypatch.setattr(J.np, "count_nonzero", lambda x: seen.append(1) or entered(x))
    links, roots = J.trie_join(sets)
    assert len(links) == 150 and all(roots[2 * i] == roots[2 * i + 1] for i in range(150)) and len(set(roots.tolist())) == 150
    assert len(seen) < 10 * len(sets)


def test_words_do_not_depend_on_batches():
    texts = ["a b c d e f", "", "B c D", None, "a b c d e f"] * 50
    alone = [J.shingle_sets([t])[0].tolist() for t in texts]
    assert [s.tolist() for s in J.shingle_sets(texts)] == alone


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op9_trie_join(spark, folder)) == brute(rows)
