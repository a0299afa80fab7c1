"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position carries a non-zero vector of radius + 1 bits. Each non-zero vector v of that length gives a mask: the
positions whose vectors have an odd inner product with v. Any ``RADIUS`` positions span less than the whole space, so some v is
orthogonal to all of them, and its mask leaves them out: two fingerprints that differ in no more positions agree under
that mask and meet in its table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import connected_components, lean
from zonalis.sources.session import staged

BITS = 64
WORDS = 4
SEED = 42
RADIUS = 4
BUCKET = 4096  # different fingerprints of a table's bucket that one task compares
CHUNK = 1 << 16  # shingles hashed at a time


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The masks of all tables; each keeps about half of the positions."""
    vectors = range(1, 1 << (radius + 1))
    at = [vectors[i % len(vectors)] for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(at) if (m & v).bit_count() % 2) for v in vectors]


def ball(radius: int, bits: int = BITS) -> np.ndarray:
    """Differences of at most ``radius`` positions."""
    return np.array([sum(1 << i for i in some) for n in range(radius + 1) for some in combinations(range(bits), n)],
                    np.uint64)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Bits set in more than half of the hashes of the word shingles, repeats included; 0 without a word."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    starts, ends = starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(starts), CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in
                           zip(starts[low:low + CHUNK], ends[low:low + CHUNK], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every document; the 64 bits are a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(lean(run), "id long, fp long")


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of a bucket as all their pairs within ``radius`` do, one less than the joined."""
    rest, links = fps.view(np.uint64), []
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = np.bitwise_count(rest ^ one) <= radius
            found = rest[near]
            links += [(one, x) for x in found]
            reached += list(found)
            rest = rest[~near]
    return [tuple(np.array(x, np.uint64).view(np.int64).tolist()) for x in links]


def links(fps: DataFrame, radius: int = RADIUS, bucket: int | None = None) -> DataFrame:
    """(a, b): links between different fingerprints (``fp``, each once) with the components of all pairs within ``radius``.

    Buckets are counted before they are gathered. Those of two give their pair, those of up to ``bucket`` are compared in one
    task. Fingerprints in a larger one are sent to all points within half the radius: two of them within the radius
    share such a point, and all that share one are within the radius. That is a fixed number of rows per fingerprint, and
    no more than that number meet at a point.
    """
    bucket = bucket or BUCKET
    signed = np.array(covering_masks(radius), np.uint64).view(np.int64).tolist()
    entries = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(signed)])).alias("e")).select("e.t", "e.key", "fp")
    full = staged(entries.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                  .filter("n > 1"), "simhash-buckets")
    pairs = full.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    members = staged(entries.join(full.filter("n > 2").select("t", "key", "n"), ["t", "key"]), "simhash-members")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                found = forest(np.array(row.values.to_numpy()), radius)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)],
                                                 names=["a", "b"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = ball(radius // 2)
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for some in np.array_split(fp, -(-len(fp) // 256)):
                points = (some.view(np.uint64)[:, None] ^ around).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(some, len(around)))],
                                                 names=["point", "fp"])

    compared = (members.filter(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
                .select("fps").mapInArrow(joined, "a long, b long"))
    dense = members.filter(F.col("n") > bucket).select("fp").distinct()
    stars = (dense.mapInArrow(spread, "point long, fp long").groupBy("point").agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
             .filter("a <> b"))
    return pairs.union(compared).union(stars).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``fingerprint`` (16 hexadecimal digits), ``component_id``: the smallest id that can be reached by links.

    Words are split at ASCII white space, A-Z in lower case. Documents with fewer than four words have their whole
    sequence as one shingle; null, empty and blank texts have fingerprint zero and are linked with each other like any
    other equal fingerprints. Repeated rows stay rows; rows without an id link others but are nobody's smallest, so their
    own ``component_id`` is null if no id can be reached. Other columns are not read. An empty table gives no rows.

    Equal fingerprints are one class before any table is built, however many documents share them.
    """
    docs = staged(fingerprints(df, id_col, text_col), "simhash-docs")
    classes = staged(docs.groupBy("fp").agg(F.min("id").alias("smallest")), "simhash-classes")
    parts = staged(connected_components(links(classes.select("fp")), "simhash"), "simhash-parts")
    named = parts.select(F.col("node").alias("fp"), "root").join(classes, "fp")
    roots = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    found = classes.join(named.join(roots, "root").select("fp", "component_id"), "fp", "left").select(
        "fp", F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("smallest")).alias("component_id"))
    return docs.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
