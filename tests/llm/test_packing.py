import numpy as np
import public_tokenizers as P
import tiktoken

from zonalis.llm import packing as K
from zonalis.llm.byte_bpe import load_ranks
from zonalis.llm.queries import RANKS


def plain_best_fit(sizes, capacity):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b in bins if b[0] >= sizes[i]]
        if fits:
            least = min(b[0] for b in fits)
            best = [b for b in fits if b[0] == least][0]
        else:
            bins.append(best := [capacity, []])
        best[0] -= sizes[i]
        best[1].append(i)
    return sorted(capacity - b[0] for b in bins)


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(6)
    for capacity in (1, 7, 64, 100, 2048):
        for n in (0, 1, 50, 600):
            sizes = np.minimum(rng.geometric(2 / capacity if capacity > 2 else 0.9, n), capacity).tolist()
            bins = K.best_fit_decreasing(sizes, capacity)
            assert sorted(i for b in bins for i in b) == list(range(n))
            assert sorted(sum(sizes[i] for i in b) for b in bins) == plain_best_fit(sizes, capacity)


def test_round_trip(spark):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})
    rows = [(i, f"text number {i} " * (i % 23)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "long words " * 4000), (None, "no id"), (5, "again"), (202, "x")]
    df = spark.createDataFrame([(*r, 1, "i") for r in rows], "doc_id long, text string, shard int, ids string")
    packed = K.pack_sequences(df.repartition(3), RANKS, P.PATTERN, capacity=256)
    found = {}
    for r in packed.collect():
        ids, places = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(places) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= 256
        assert (ids[r.cu_seqlens[-1]:] == K.PAD).all() and (places[r.cu_seqlens[-1]:] == 0).all()
        for d, start, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            found.setdefault(d, []).append((start, ids[a:b].tolist()))
    for d in {d for d, _ in rows}:
        want = [t for e, text in rows if e == d for t in lib.encode_ordinary(text or "") + [K.END]]
        got = [t for start, ids in found[d] for t in ids]
        assert sorted(got) == sorted(want)
        if sum(e == d for e, _ in rows) == 1:
            assert [t for _, ids in sorted(found[d]) for t in ids] == want
    assert K.pack_sequences(df.limit(0), RANKS, P.PATTERN).count() == 0
    whole = K.id_matrices(packed).collect()
    assert sum(m.rows for m in whole) == packed.count()
    assert all(len(m.ids) == len(m.positions) == 4 * m.rows * m.columns for m in whole)
