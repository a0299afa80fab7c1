from itertools import combinations

import numpy as np

from zonalis.llm import license_scan as S


def test_longest_increasing():
    rng = np.random.default_rng(2)
    for n in range(9):
        for _ in range(20):
            pairs = list(enumerate(rng.permutation(n).tolist()))
            got = S.longest_increasing(pairs)
            assert all(a[1] < b[1] for a, b in zip(got, got[1:]))
            best = max((len(c) for k in range(n + 1) for c in combinations(pairs, k)
                        if all(a[1] < b[1] for a, b in zip(c, c[1:]))), default=0)
            assert len(got) == best


def test_alignment_ascends_and_agrees():
    rng = np.random.default_rng(4)
    for _ in range(50):
        text = [f"w{x}" for x in rng.integers(0, 30, 60)]
        template = [w for w in text[10:40] if rng.random() < 0.8]
        pairs = S.align(text, template)
        assert all(template[a] == text[b] for a, b in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    assert S.align(["a", "b", "c"], ["a", "x", "c"]) == [(0, 0), (2, 2)]


def test_scan(spark):
    filler = "the work of the version in a license of the year " * 30
    mit = S.TEMPLATES["MIT"]
    rows = [(1, f"{filler}\nReleased under the MIT License.\n{filler}"), (2, "Released under the MIT license!"),
            (3, f"{filler} {mit.upper()} {filler}"), (4, filler), (5, None), (6, ""), (None, "Licensed under CC BY-NC 4.0."),
            (7, "Released x y z under a b c d e f g h i j the k l m n o p MIT q r s t u v License"),
            (8, mit.replace("merge, ", "").replace("persons", "people")), (9, f"{filler * 40} Licensed under CC BY-NC 4.0."),
            (2, "Released under the MIT License. Licensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame([(*r, "l", 1) for r in rows], "doc_id long, text string, license string, coverage int")
    got = sorted((r.doc_id or 0, r.license) for r in S.scan_licenses(df).collect())
    assert got == [(0, "CC-BY-NC-4.0-notice"), (1, "MIT-notice"), (2, "Apache-2.0-notice"), (2, "MIT-notice"),
                   (2, "MIT-notice"), (3, "MIT"), (8, "MIT"), (9, "CC-BY-NC-4.0-notice")]
    place = [r for r in S.scan_licenses(df).collect() if r.doc_id == 1][0]
    assert S.words_of(rows[0][1])[place.first_word:place.end_word] == S.words_of("released under the mit license")
    assert S.scan_licenses(df.limit(0)).count() == 0
