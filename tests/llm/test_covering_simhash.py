import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from zonalis.llm import covering_simhash as S
from zonalis.llm import queries


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=S.RADIUS):
    fps = [brute_fingerprint(t) for _, t in rows]
    unique = sorted(set(fps))
    parent = {f: f for f in unique}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    as_array = np.array(unique, np.uint64)
    for i, f in enumerate(unique):
        for j in np.flatnonzero(np.bitwise_count(as_array[i + 1:] ^ as_array[i]) <= radius):
            a, b = find(f), find(unique[i + 1 + int(j)])
            parent[max(a, b)] = min(a, b)
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[find(f)] = min(i, low.get(find(f), i))
    return sorted(((i, f"{f:016x}", low.get(find(f))) for (i, _), f in zip(rows, fps)), key=repr)


def test_masks_cover_every_difference():
    masks = S.covering_masks()
    assert len(masks) == 31 and all(32 <= m.bit_count() <= 36 for m in masks)
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 4):
        for _ in range(3000):
            gone = sum(1 << int(b) for b in rng.choice(64, size, replace=False))
            assert any(gone & m == 0 for m in masks)
    small = S.covering_masks(2, 9)
    assert all(any((1 << a | 1 << b) & m == 0 for m in small) for a in range(9) for b in range(9))


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 7)
    for text in (None, "", " \t\n", "Ein", "a B  c", "a b c d", "Ä Ö ß É x \x1cy z", "one Two " * 500, "x" * 10_000):
        assert S.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)


@pytest.mark.parametrize("bucket", [2, 4096])
def test_links_of_dense_fingerprints(spark, bucket):
    """Chains, balls and far pairs in one table's bucket, with and without the way by shared points."""
    rng = np.random.default_rng(11)
    centres = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        x = int(c)
        for _ in range(60):
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
            x = x if rng.random() < 0.3 else int(c)
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    got = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=bucket).collect()
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
        parent[find(a)] = find(b)
    groups = {}
    for f in signed:
        groups.setdefault(find(f), set()).add(f)
    want = {}
    labels = {f: f for f in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4 and labels[a] != labels[b]:
                    labels[a] = labels[b] = min(labels[a], labels[b])
                    changed = True
    for f, l in labels.items():
        want.setdefault(l, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(12)]
    rows = []
    for i in range(300):
        parts = base[i % 12].split()
        for _ in range(int(rng.integers(0, 3))):
            parts[int(rng.integers(0, 300))] = "new"
        rows.append((i, " ".join(parts)))
    rows += [(1000, None), (1001, ""), (999, " "), (None, "alone"), (None, base[0]), (1002, "ONE two"), (1003, "one  Two"),
             (7, rows[7][1]), (7, rows[8][1]), (1004, "long " * 30_000)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, fp int, key string")
    got = sorted(map(tuple, S.near_duplicates(df.repartition(5)).collect()), key=repr)
    assert got == brute(rows)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_covering_simhash(spark, folder)
    assert got.filter(F.length("fingerprint") != 16).count() == 0
    assert sorted(map(tuple, got.collect()), key=repr) == brute([tuple(r) for r in docs])
