"""Packing of tokenised texts into sequences of one length by best fit decreasing.

Texts longer than a sequence are split without loss. The pieces of a shard go, longest first, into the open sequence
that they fill best; a segment tree over free capacities finds it in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.byte_bpe import encode_texts, load_ranks
from zonalis.llm.common import BLOCKS_PER_PARTITION, lean_group

CAPACITY = 2048
END = 50256
PAD = 50256
SEQUENCES_AT_ONCE = 1024


class Capacities:
    """Open bins by free capacity: a segment tree that tells where bins are."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, bin_no: int) -> None:
        self.bins[free].append(bin_no)
        at = free + self.leaves
        while at and not self.filled[at]:
            self.filled[at] = 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(free, bin) of the bin with the least free capacity of at least ``size``; of equals the latest."""
        at = size + self.leaves
        if not self.filled[at]:
            while at > 1 and (at & 1 or not self.filled[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.filled[2 * at] else 2 * at + 1
        free = at - self.leaves
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.filled[at] = 0
            at >>= 1
            while at and not (self.filled[2 * at] or self.filled[2 * at + 1]):
                self.filled[at] = 0
                at >>= 1
        return free, found


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of the pieces in each bin; sizes are from 1 to ``capacity``."""
    open_bins, out = Capacities(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        free, bin_no = open_bins.take(sizes[i]) or (capacity, len(out))
        if bin_no == len(out):
            out.append([])
        out[bin_no].append(i)
        if free > sizes[i]:
            open_bins.put(free - sizes[i], bin_no)
    return out


PACKED_ROWS = ("shard int, sequence int, doc_ids array<long>, offsets array<long>, cu_seqlens array<int>, ids binary, "
               "positions binary")


def pack_sequences(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end: int = END, pad: int = PAD) -> DataFrame:
    """One row per packed sequence: its segments' ``doc_ids`` and token ``offsets`` in them, ``cu_seqlens``, and rows of
    the id and position matrices as little-endian 32-bit integers (``ids``, ``positions``).

    Every text ends with the token ``end``, so a null or empty text is one token. Positions start anew with each segment.
    Padding fills a sequence up to ``capacity`` behind the last of ``cu_seqlens``, with position 0. Rows are separate
    texts even if ids repeat; null ids are carried through. Other columns are not read.

    Texts are tokenised where they are read and shuffled once, as tokens, by shard. A shard holds what one task can pack;
    their number grows with the input's partitions. Copies under different ids spread over all shards.
    """
    shards = BLOCKS_PER_PARTITION * max(1, df.rdd.getNumPartitions())
    # Ids of a vocabulary of up to 65,536 tokens are shuffled in two bytes each.
    width = 2 if max(load_ranks(ranks_path).values(), default=0) < 1 << 16 else 4
    tokens = encode_texts(df, ranks_path, pattern, id_col, text_col, decode=False, width=width)
    tokens = tokens.select(F.pmod(F.xxhash64(id_col, "ids"), F.lit(shards)).cast("int").alias("shard"),
                           F.col(id_col).cast("long").alias("doc"), "ids")

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["doc"].to_pylist(), table["ids"].to_pylist(), strict=True),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        docs = [d for d, _ in rows]
        ids = [np.append(np.frombuffer(x, f"<u{width}").astype("<u4"), np.uint32(end)) for _, x in rows]
        pieces = [(i, start, min(capacity, len(x) - start)) for i, x in enumerate(ids)
                  for start in range(0, len(x), capacity)]
        out: dict[str, list] = {c: [] for c in ("doc_ids", "offsets", "cu_seqlens", "ids", "positions")}
        for members in best_fit_decreasing([size for *_, size in pieces], capacity):
            row, place = np.full(capacity, pad, "<u4"), np.zeros(capacity, "<u4")
            ends = [0]
            for i, start, size in (pieces[m] for m in members):
                row[ends[-1]:ends[-1] + size] = ids[i][start:start + size]
                place[ends[-1]:ends[-1] + size] = np.arange(size)
                ends.append(ends[-1] + size)
            out["doc_ids"].append([docs[pieces[m][0]] for m in members])
            out["offsets"].append([pieces[m][1] for m in members])
            out["cu_seqlens"].append(ends)
            out["ids"].append(row.tobytes())
            out["positions"].append(place.tobytes())
        n = len(out["ids"])
        return pa.table({
            "shard": pa.array([table["shard"][0].as_py()] * n, pa.int32()), "sequence": pa.array(range(n), pa.int32()),
            "doc_ids": pa.array(out["doc_ids"], pa.list_(pa.int64())),
            "offsets": pa.array(out["offsets"], pa.list_(pa.int64())),
            "cu_seqlens": pa.array(out["cu_seqlens"], pa.list_(pa.int32())),
            "ids": pa.array(out["ids"], pa.binary()), "positions": pa.array(out["positions"], pa.binary())})

    return tokens.groupBy("shard").applyInArrow(lean_group(run), PACKED_ROWS)


def id_matrices(packed: DataFrame) -> DataFrame:
    """The rows of each shard as matrices: ``rows``, ``columns``, ``ids`` and ``positions``, in pieces of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))[:len(shard)]).tolist()
            for low, high in zip(starts, [*starts[1:], len(shard)], strict=True):
                for s in range(low, high, SEQUENCES_AT_ONCE):
                    part = batch.slice(s, min(SEQUENCES_AT_ONCE, high - s)).to_pydict()
                    yield pa.RecordBatch.from_pylist([{
                        "shard": int(shard[s]), "first": part["sequence"][0], "rows": len(part["ids"]),
                        "columns": len(part["ids"][0]) // 4, "ids": b"".join(part["ids"]),
                        "positions": b"".join(part["positions"])}], MATRICES)

    return packed.select("shard", "sequence", "ids", "positions").mapInArrow(
        run, "shard int, first int, rows int, columns int, ids binary, positions binary")


MATRICES = pa.schema([("shard", pa.int32()), ("first", pa.int32()), ("rows", pa.int32()), ("columns", pa.int32()),
                      ("ids", pa.binary()), ("positions", pa.binary())])
