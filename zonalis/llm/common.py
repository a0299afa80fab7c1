"""What several text operators share: blocks of documents, counting of hashes, connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.sources.session import staged

BLOCKS_PER_PARTITION = 8
PACKED = "bucket int, block int, hashes binary, counts binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, and Arrow and the C library keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
         forget: Callable[[], object] | None = None):
    """A function for ``mapInArrow`` that frees its tables (``forget``) and gives memory back when the task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            give_back()

    return whole


def lean_group(run: Callable[[pa.Table], pa.Table], forget: Callable[[], object] | None = None):
    """The same for ``applyInArrow`` on groups, after every group."""

    def whole(table: pa.Table) -> pa.Table:
        return _finished(run(table), forget)

    return whole


def lean_pair(run: Callable[[tuple, pa.Table, pa.Table], pa.Table], forget: Callable[[], object] | None = None):
    """The same for ``applyInArrow`` on pairs of groups and their key."""

    def whole(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _finished(run(key, left, right), forget)

    return whole


def _finished(out: pa.Table, forget: Callable[[], object] | None) -> pa.Table:
    if forget:
        forget()
    give_back()
    return out


def in_blocks(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(block, packed): the documents by block, compressed for the shuffle; and the number of blocks.

    A block is what one task holds at a time; their number grows with the input's partitions. Copies of a text under
    different ids spread over all blocks. ``documents_of`` unpacks the rows of a block.
    """
    n = BLOCKS_PER_PARTITION * max(1, df.rdd.getNumPartitions())
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(n)).cast("int")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            order = np.argsort(blocks, kind="stable")
            batch, blocks = batch.take(pa.array(order)), blocks[order]
            starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))[:len(blocks)])
            rows = []
            for start, end in zip(starts, np.append(starts[1:], len(blocks)), strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, PACKED_DOCS) as out:
                    out.write_table(pa.table(batch.slice(start, end - start).columns[1:], PACKED_DOCS))
                rows.append(squeeze(sink.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks[starts], pa.int32()), pa.array(rows, pa.binary())],
                                             names=["block", "packed"])

    return df.select(block, F.col(id_col).cast("long"), text_col).mapInArrow(
        lean(packed), "block int, packed binary"), n


PACKED_DOCS = pa.schema([("id", pa.int64()), ("text", pa.string())])


def documents_of(table: pa.Table) -> tuple[list[int | None], list[str | None]]:
    """Ids and texts of a block."""
    tables = [pa.ipc.open_stream(expand(x.as_py())).read_all() for x in table["packed"]]
    whole = pa.concat_tables([PACKED_DOCS.empty_table(), *tables])
    return whole["id"].to_pylist(), whole["text"].to_pylist()


def pack(block: int, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of one block for ``count_hashes``: distinct hashes by bucket, 32 bits each beside those of the bucket."""
    bucket = bucket_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, low, counts = bucket[order], (hashes[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), counts[order]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))[:len(bucket)])
    ends = np.append(starts[1:], len(bucket))[:len(starts)]
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[starts].astype(np.int32)), pa.array(np.full(len(starts), block, np.int32)),
        pa.array([low[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
        pa.array([counts[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())],
        names=["bucket", "block", "hashes", "counts"])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def count_hashes(packed: DataFrame) -> DataFrame:
    """Totals over all blocks of the hashes that ``pack`` wrote, back to every block that has them.

    Rows of the same form; only hashes with a total of two or more return. A hash is sent once per block however often
    it occurs there, so the share of a frequent one is bounded by the number of blocks. Hashes are compared by bucket and
    32 bits: a collision makes a total too large, never too small.
    """

    def total(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h.as_py(), "<u4") for h in table["hashes"]]
        counts = [np.frombuffer(c.as_py(), "<u4") for c in table["counts"]]
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        sums = np.minimum(sums, 0xFFFFFFFF).astype("<u4")
        out_hashes, out_counts, start = [], [], 0
        for h in hashes:
            mine = sums[at[start:start + len(h)]]
            start += len(h)
            out_hashes.append(h[mine > 1].tobytes())
            out_counts.append(mine[mine > 1].tobytes())
        return pa.table({"bucket": table["bucket"], "block": table["block"],
                         "hashes": pa.array(out_hashes, pa.binary()), "counts": pa.array(out_counts, pa.binary())})

    return packed.groupBy("bucket").applyInArrow(lean_group(total), PACKED)


class Totals:
    """Look-up of the totals that ``count_hashes`` returned to one block; 1 for all other hashes."""

    def __init__(self, table: pa.Table, buckets: int):
        self.buckets = buckets
        keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for b, h, c in zip(table["bucket"], table["hashes"], table["counts"], strict=True):
            low = np.frombuffer(h.as_py(), "<u4").astype(np.uint64)
            keys.append((np.uint64(b.as_py()) << np.uint64(32)) | low)
            counts.append(np.frombuffer(c.as_py(), "<u4").astype(np.int64))
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys) or not len(hashes):
            return np.ones(len(hashes), np.int64)
        wanted = ((bucket_of(hashes, self.buckets).astype(np.uint64) << np.uint64(32))
                  | (hashes & np.uint64(0xFFFFFFFF)))
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.counts[at], 1)


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the smallest node that can be reached.

    Tasks first shrink their edges to forests, then stars are grown around the smallest neighbours until nothing
    changes: every edge to larger neighbours moves to the smallest one, then every edge to smaller ones. Joins with a
    hub are split by adaptive execution. Each round is written to the shared folder.
    """
    now = staged(edges.select("a", "b").mapInPandas(_forest, "a long, b long").distinct(), f"{name}-forest")
    mark = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = (large.join(small, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(small.select(F.col("u"), F.col("m"))).distinct())
        now = staged(moved.filter("a <> b"), f"{name}-round")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if got == mark:
            break
        mark = got
    return (now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
            .union(now.select(F.col("b"), F.col("b")).distinct()))


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each batch's edges as edges to the smallest node of its part."""
    for frame in frames:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:  # noqa: B023
                parent[x] = x = parent[up] if up in parent else up  # noqa: B023
            return x

        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        yield pd.DataFrame([(x, r) for x in list(parent) if (r := find(x)) != x], columns=["a", "b"]).astype("int64")
