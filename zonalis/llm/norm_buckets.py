"""Ranked lexical search over buckets of impact vectors, ordered by length.

A document is a vector of impacts over the terms of the items, an item the vector of its terms' weights w; the score is their
inner product. With impacts scaled by sqrt(w) and weights by 1 / sqrt(w) it stays the same, and no document scores more
than the product of the two lengths. Documents are cut into buckets by falling length. A bucket is left for an item if its
longest vector cannot reach the item's worst kept score. Within a bucket the item's heaviest coordinates are added up first;
a document leaves if even a remainder in the item's own direction could not lift it to that score. The rest are scored in whole
numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.llm.common import lean
from zonalis.sources.session import staged

K = 10
SLICE_BYTES = 16 << 20  # of different terms of the items that are searched for at a time
BUCKET = 2048  # documents of a bucket
BUCKET_ENTRIES = 1 << 19
SEED_BUCKET = 256  # the first bucket of a task, searched before the others for a first bound
FOCUS = 8
FEW = 64  # documents left that are scored one by one
SLACK = 1 - 1e-9

# Every byte that belongs to no term is a blank; only A-Z change case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.translate(_TABLE).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, terms): the different terms of each different item that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(x.as_py()))) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["id", "terms"])

    asked = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return (asked.filter("text IS NOT NULL").distinct().mapInArrow(run, "id long, terms array<binary>")
            .filter(F.size("terms") > 0))


def counted_terms(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """(id, n, terms, tfs): all terms of a document counted, and how often those of ``vocabulary`` occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py() or b"")
                found = Counter(map(known.get, words))
                found.pop(None, None)
                n.append(len(words))
                terms.append(sorted(found))
                tfs.append([found[t] for t in terms[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary")).mapInArrow(
        lean(run), "id long, n long, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vectors(counted: DataFrame, n_docs: int, n_terms: int, weights) -> DataFrame:
    """(id, length, terms, impacts) of the documents that hold a term of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            m = np.array([10 + 90 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            sizes = batch.column(2).value_lengths().to_numpy()
            terms = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy().astype(np.int64)
            impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
            ends = np.cumsum(sizes)
            square = np.add.reduceat(impacts.astype(np.float64) ** 2 * w[terms], ends - sizes)
            terms, impacts = terms.astype("<i4"), impacts.astype("<i4")
            cut = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.sqrt(square)), pa.array([terms[s:e].tobytes() for s, e in cut], pa.binary()),
                 pa.array([impacts[s:e].tobytes() for s, e in cut], pa.binary())], names=["id", "length", "terms", "impacts"])

    return counted.filter(F.size("terms") > 0).select("id", "n", "terms", "tfs").mapInArrow(
        run, "id long, length double, terms binary, impacts binary")


BUCKETS = "first boolean, ids binary, named binary, lengths binary, sizes binary, terms binary, impacts binary"


def buckets(rows: DataFrame) -> DataFrame:
    """Vectors by falling length in buckets, one per row. Equal lengths spread over tasks."""
    ordered = (rows.repartitionByRange(F.desc("length"), F.xxhash64("id", "terms"))
               .sortWithinPartitions(F.desc("length")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, entries, first = [], 0, True

        def bucket() -> pa.RecordBatch:
            ids, lengths, terms, impacts = zip(*kept, strict=True)
            values = [np.array([i or 0 for i in ids], "<i8"), np.array([i is not None for i in ids]),
                      np.array(lengths, "<f8"), np.array([len(t) // 4 for t in terms], "<i4")]
            return pa.RecordBatch.from_arrays(
                [pa.array([first]), *[pa.array([v.tobytes()]) for v in values], pa.array([b"".join(terms)], pa.binary()),
                 pa.array([b"".join(impacts)], pa.binary())],
                names=["first", "ids", "named", "lengths", "sizes", "terms", "impacts"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kept.append(row)
                entries += len(row[2]) // 4
                if len(kept) >= (SEED_BUCKET if first else BUCKET) or entries >= BUCKET_ENTRIES:
                    yield bucket()
                    kept, entries, first = [], 0, False
        if kept:
            yield bucket()

    return ordered.select("id", "length", "terms", "impacts").mapInArrow(lean(run), BUCKETS)


class Bucket:
    """The vectors of a bucket by document and by term."""

    def __init__(self, ids: bytes, named: bytes, lengths: bytes, sizes: bytes, terms: bytes, impacts: bytes):
        self.ids, self.named = np.frombuffer(ids, "<i8"), np.frombuffer(named, bool)
        self.lengths, sizes = np.frombuffer(lengths, "<f8"), np.frombuffer(sizes, "<i4")
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = self.ends - sizes
        self.terms, self.impacts = np.frombuffer(terms, "<i4"), np.frombuffer(impacts, "<i4").astype(np.int64)
        order = np.argsort(self.terms, kind="stable")
        self.by_term = self.terms[order]
        self.docs, self.by_impact = np.repeat(np.arange(len(sizes)), sizes)[order], self.impacts[order]


@dataclass
class Item:
    """An item's terms by falling weight. ``rest``: the lengths of what follows each of them, itself included."""

    key: int
    id: int | None
    terms: np.ndarray
    weights: np.ndarray
    rest: np.ndarray
    focus: int

    @classmethod
    def of(cls, key: int, item_id: int | None, terms: Sequence[int], w: np.ndarray) -> Item:
        terms = np.array(terms, np.int64)
        terms = terms[np.lexsort((terms, -w[terms]))]
        mine = w[terms]
        rest = np.sqrt(np.append(np.cumsum(mine[::-1].astype(np.float64))[::-1], 0.0))
        return cls(key, item_id, terms, mine, rest, max(FOCUS, int((2 * mine >= mine[0]).sum())))


class Best:
    """The k best documents of an item so far; ``worst`` is the score that another one has to reach."""

    def __init__(self, k: int, worst: int):
        self.k, self.worst = k, max(worst, 1)
        self.scores, self.ids, self.named = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        good = scores >= self.worst
        if not good.any():
            return
        scores, ids, named = (np.concatenate((old, new[good])) for old, new in
                              ((self.scores, scores), (self.ids, ids), (self.named, named)))
        order = np.lexsort((ids, ~named, -scores))[:self.k]
        self.scores, self.ids, self.named = scores[order], ids[order], named[order]
        if len(order) == self.k:
            self.worst = max(self.worst, int(self.scores[-1]))


def search_bucket(bucket: Bucket, items: Sequence[Item], best: Sequence[Best]) -> int:
    """Add a bucket's documents to the best of every item; returns how many items looked into the bucket."""
    longest, opened = float(bucket.lengths.max()), 0
    square = bucket.lengths ** 2
    for item, top in zip(items, best, strict=True):
        if item.rest[0] * longest < top.worst * SLACK:
            continue
        opened += 1
        low, high = (np.searchsorted(bucket.by_term, item.terms, side) for side in ("left", "right"))
        score, seen = np.zeros(len(square), np.int64), np.zeros(len(square))

        def add(j: int) -> None:
            docs, impacts = bucket.docs[low[j]:high[j]], bucket.by_impact[low[j]:high[j]]  # noqa: B023
            part = impacts * item.weights[j]  # noqa: B023
            score[docs] += part  # noqa: B023
            seen[docs] += part.astype(np.float64) * impacts  # noqa: B023

        for j in range(min(item.focus, len(item.terms))):
            add(j)
        if item.focus >= len(item.terms):
            left = np.flatnonzero(score >= top.worst)
            top.add(score[left], bucket.ids[left], bucket.named[left])
            continue
        remainder = np.sqrt(np.maximum(square * (1 + 1e-9) - seen, 0))
        left = np.flatnonzero(score + item.rest[item.focus] * remainder >= top.worst * SLACK)
        if not len(left):
            continue
        if len(left) <= FEW:
            score = np.array([_score(bucket, item, d) for d in left.tolist()], np.int64)
        else:
            for j in range(item.focus, len(item.terms)):
                add(j)
            score = score[left]
        top.add(score, bucket.ids[left], bucket.named[left])
    return opened


def _score(bucket: Bucket, item: Item, doc: int) -> int:
    mine = slice(bucket.starts[doc], bucket.ends[doc])
    terms = bucket.terms[mine]
    at = np.minimum(np.searchsorted(terms, item.terms), len(terms) - 1)
    return int((np.where(terms[at] == item.terms, bucket.impacts[mine][at], 0) * item.weights).sum())


def _searching(items, worst, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = items.value
        best = [Best(k, worst.get(i.key, 1)) for i in asked]
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                search_bucket(Bucket(*row), asked, best)
        for item, top in zip(asked, best, strict=True):
            if len(top.scores):
                n = len(top.scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.key] * n, pa.int64()), pa.array([item.id] * n, pa.int64()),
                     pa.array(top.ids, mask=~top.named), pa.array(top.scores)], names=["item", "item_id", "doc_id", "score"])

    return lean(run)


FOUND = "item long, item_id long, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _search_slice(docs: DataFrame, rows: list, id_col: str, text_col: str, k: int) -> DataFrame:
    spark, name = docs.sparkSession, "lexical"
    share = spark.sparkContext.broadcast
    words = sorted({t for r in rows for t in r["terms"]})
    known = {t: i for i, t in enumerate(words)}
    vocabulary = share(known)
    counted = staged(counted_terms(docs, id_col, text_col, vocabulary), f"{name}-terms")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the slice's items.
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()
    w = np.array([weight(n_docs, 0)] * len(words), np.int64)
    for r in df:
        w[r["t"]] = weight(n_docs, r["df"])
    weights = share(w)
    cut = staged(buckets(vectors(counted, n_docs, n_terms, weights)), f"{name}-buckets")
    items = share([Item.of(i, r["id"], [known[t] for t in r["terms"]], w) for i, r in enumerate(rows)])
    data = cut.select("ids", "named", "lengths", "sizes", "terms", "impacts")
    # One number per item of the slice.
    seeds = _ranked(cut.filter("first").select(*data.columns).mapInArrow(_searching(items, {}, k), FOUND), k)
    worst = {r["item"]: r["score"] for r in seeds.filter(F.col("rank") == k).select("item", "score").collect()}
    found = staged(data.mapInArrow(_searching(items, worst, k), FOUND), f"{name}-found")
    for shared in (vocabulary, weights, items):
        shared.destroy()
    return _ranked(found, k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = K) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: each item's k best documents with a score above 0.

    Terms are runs of letters and digits, every character beyond ASCII included; only A-Z change case. Equal scores go by
    ascending document id, those without an id last. Documents without a term, null and empty ones included, count for
    nothing. Repeated documents are ranked each. Items of equal id and text count once; different texts under one id are
    ranked apart, also under a null id. Items without a term find nothing. Other columns are not read; empty tables
    give no rows.

    The items are searched in slices of at most ``SLICE_BYTES`` of different terms (one item's terms stay together); a
    slice's terms and items are what the driver holds and sends out. Documents are read once a slice, then
    only their written vectors.
    """
    asked = staged(item_terms(items, item_col, item_text_col), "lexical-items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 64)
    slices = -(-(asked.agg(F.sum(size)).first()[0] or 0) // SLICE_BYTES)
    part = F.pmod(F.xxhash64("id", "terms"), F.lit(max(slices, 1)))
    found = None
    for s in range(slices):
        rows = asked.filter(part == s).collect()
        rows.sort(key=lambda r: (r["id"] is None, r["id"] or 0, r["terms"]))
        if rows:
            one = _search_slice(docs, rows, id_col, text_col, k)
            found = one if found is None else found.union(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
