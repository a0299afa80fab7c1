import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from zonalis.llm import norm_buckets as B
from zonalis.llm import queries


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=10):
    counts = [Counter(words(t)) for _, t in docs]
    n_docs, total = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for (doc, _), c in zip(docs, counts):
            m = 10 + 90 * sum(c.values()) * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(words(text)) if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, length int"),
            spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int"))


@pytest.mark.parametrize("bucket,slice_bytes", [(4, 3000), (2048, 1 << 24)])
def test_against_brute_force(spark, monkeypatch, bucket, slice_bytes):
    monkeypatch.setattr(B, "BUCKET", bucket)
    monkeypatch.setattr(B, "SEED_BUCKET", 2)
    monkeypatch.setattr(B, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(B, "FEW", 3)
    rng = np.random.default_rng(bucket)
    vocabulary = [f"wört{i}" if i % 3 else f"Word{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    share /= share.sum()
    docs = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 200)), p=share))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "!?"), (None, docs[5][1]), (403, docs[5][1]), (404, docs[5][1]), (7, docs[7][1]),
             (405, "rare " * 5000 + "wört1"), (406, "x_y-z Ärger\x00nul 1a2")]
    items = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 40)), p=share))) for i in range(40)]
    items += [(50, None), (51, ""), (52, docs[5][1]), (52, docs[5][1]), (52, "rare wört1"), (None, "word3 unknown"),
              (53, "never seen"), (54, "Z ÄRGER ärger Ärger X Y NUL 1A2")]
    d, i = frames(spark, docs, items)
    got = sorted(map(tuple, B.ranked_search(d.repartition(3), i).collect()), key=repr)
    assert got == brute(docs, items)
    assert B.ranked_search(d.limit(0), i).count() == 0
    assert B.ranked_search(d, i.limit(0)).count() == 0


def test_buckets_and_documents_are_left(spark):
    """Short vectors are never opened for an item whose worst kept score is beyond them."""
    w = np.array([1000, 900, 800, 10, 10], np.int64)
    item = B.Item.of(0, 1, [0, 1, 2, 3, 4], w)
    item.focus = 2

    def bucket(rows):
        terms = [np.array(sorted(r), "<i4") for r in rows]
        impacts = [np.array([r[t] for t in sorted(r)], "<i4") for r in rows]
        lengths = [math.sqrt(sum(v * v * w[t] for t, v in r.items())) for r in rows]
        return B.Bucket(np.arange(len(rows), dtype="<i8").tobytes(), np.ones(len(rows), bool).tobytes(),
                        np.array(lengths, "<f8").tobytes(), np.array([len(t) for t in terms], "<i4").tobytes(),
                        b"".join(t.tobytes() for t in terms), b"".join(v.tobytes() for v in impacts))

    top = B.Best(1, 0)
    assert B.search_bucket(bucket([{0: 100, 1: 100, 2: 100}, {3: 5}]), [item], [top]) == 1
    assert top.worst == 270_000 and top.ids.tolist() == [0]
    assert B.search_bucket(bucket([{0: 90, 3: 1}, {4: 100}]), [item], [top]) == 0
    assert B.search_bucket(bucket([{0: 100, 1: 100, 2: 101}]), [item], [top]) == 1 and top.worst == 270_800


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLES['op11_norm_buckets']})").fetchall()
    got = [tuple(r) for r in queries.op11_norm_buckets(spark, folder).collect()]
    assert sorted(got) == sorted(want) and len(got) > 0
