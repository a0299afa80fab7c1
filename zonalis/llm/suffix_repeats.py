"""Exact removal of repeated byte strings with sparse enhanced suffix arrays.

Every window of ``LENGTH`` bytes has an anchor: the place in it whose ``GRAM``-byte hash is smallest, the leftmost of
equals. Equal windows have their anchor at the same offset, so it is enough to compare windows with an equal anchor gram.
Grams that only one document has end there. The others travel with the bytes of their windows to the bucket of the gram.
A bucket sorts the suffixes that start at anchors, takes the common prefixes of neighbours, and scans them with a stack:
every interval of the common-prefix tree is a set of suffixes that agree to a depth. Where the bytes before the anchors
differ, the interval falls apart into groups that agree to the left as well. Such a group is a maximal repeat with all
its occurrences, and its smallest document is the one that keeps the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import PACKED, Totals, bucket_of, count_hashes, documents_of, expand, in_blocks, mix, pack, squeeze

LENGTH = 50
GRAM = 32
REACH = LENGTH - GRAM  # an anchor lies at most so many bytes behind the start of its window
SPAN = REACH + LENGTH  # bytes around an anchor that its windows can touch
ROW = 72  # those bytes, the first and last offset, padding
SEGMENT = 1 << 17
PLACE = np.uint64((1 << 18) - 1)
NONE = np.iinfo(np.int64).max

_RANDOM = np.random.Generator(np.random.PCG64(11))
_GRAM_FACTORS = _RANDOM.integers(0, 1 << 63, GRAM // 8, np.uint64) | np.uint64(1)
_ROW_FACTORS = _RANDOM.integers(0, 1 << 63, ROW // 8, np.uint64) | np.uint64(1)


class Runs:
    """Anchors of a block's texts, each with the run of windows it belongs to (all as places in ``data``)."""

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(parts) + bytes(SPAN), np.uint8)
        total = len(self.data) - SPAN
        valid = np.ones(total, bool)
        for start, size in zip(self.starts.tolist(), self.sizes.tolist(), strict=True):
            valid[max(start, start + size - LENGTH + 1):start + size] = False
        found = [_anchors(self.data, valid, s, min(s + SEGMENT, total)) for s in range(0, total, SEGMENT)]
        self.anchor, self.first, self.last, self.gram = (
            np.concatenate([f[k] for f in found] or [np.empty(0, t)])
            for k, t in enumerate((np.int64, np.int64, np.int64, np.uint64)))
        self.doc = np.searchsorted(self.starts + self.sizes, self.first, "right")

    def keep(self, mask: np.ndarray) -> None:
        for name in ("anchor", "first", "last", "gram", "doc"):
            setattr(self, name, getattr(self, name)[mask])

    def rows(self) -> np.ndarray:
        """The bytes of each anchor's windows, aligned at the anchor, zero elsewhere; then the range of offsets."""
        out = np.zeros((len(self.anchor), ROW), np.uint8)
        for s in range(0, len(out), 8192):
            at, first, last = self.anchor[s:s + 8192], self.first[s:s + 8192], self.last[s:s + 8192]
            place = at[:, None] + np.arange(-REACH, LENGTH)
            inside = (place >= first[:, None]) & (place < last[:, None] + LENGTH)
            out[s:s + 8192, :SPAN] = np.where(inside, self.data[np.where(inside, place, 0)], 0)
            out[s:s + 8192, SPAN] = at - last
            out[s:s + 8192, SPAN + 1] = at - first
        return out


def _anchors(data: np.ndarray, valid: np.ndarray, start: int, end: int) -> tuple[np.ndarray, ...]:
    """Anchors of the valid windows that start in [start, end)."""
    piece = data[start:end + LENGTH - 1]
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(piece, 8)).view("<u8").ravel()
    n = len(piece) - GRAM + 1
    grams = _hash_words([words[8 * k:8 * k + n] for k in range(GRAM // 8)], _GRAM_FACTORS)
    low = (grams & ~PLACE) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= REACH + 1:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if rest := REACH + 1 - span:
        low = np.minimum(low[:-rest], low[rest:])
    window = np.flatnonzero(valid[start:end])
    place = (low[window] & PLACE).astype(np.int64)
    if not len(window):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1))))
    ends = np.append(new[1:], len(window)) - 1
    return place[new] + start, window[new] + start, window[ends] + start, grams[place[new]]


def _hash_words(words: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    out = words[0] * factors[0]
    for w, f in zip(words[1:], factors[1:], strict=True):
        out = (out ^ (out >> np.uint64(32))) + w * f
    return mix(out)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view("<u8")
    return _hash_words([words[:, k] for k in range(words.shape[1])], _ROW_FACTORS)


def gram_hashes(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows[:, REACH:REACH + GRAM]).view("<u8")
    return _hash_words([words[:, k] for k in range(words.shape[1])], _GRAM_FACTORS)


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before; 0 for the first."""
    same = rows[1:] == rows[:-1]
    return np.concatenate(([0], np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1)))).astype(np.int64)


def intervals(prefixes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(depth, first, last, depth of the parent) of every interval of the common-prefix tree, children first."""
    stack = [(0, 0)]
    values = prefixes.tolist()
    for i, depth in enumerate([*values[1:], 0], 1):
        left = i - 1
        while stack[-1][0] > depth:
            top, left = stack.pop()
            yield top, left, i - 1, max(depth, stack[-1][0])
        if stack[-1][0] < depth:
            stack.append((depth, left))


def smallest_documents(rows: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """For each row and offset of a window before its anchor: the smallest document with the same window.

    Rows are distinct. Column o stands for the window that starts o bytes before the anchor; where a row has no such
    window it is ``NONE``.
    """
    offsets = np.arange(REACH + 1)
    has = (offsets >= rows[:, SPAN, None]) & (offsets <= rows[:, SPAN + 1, None])
    out = np.where(has, documents[:, None], NONE)
    gram = gram_hashes(rows)
    right = np.ascontiguousarray(rows[:, REACH:SPAN])
    keyed = np.concatenate((gram.astype(">u8").view(np.uint8).reshape(-1, 8), right), axis=1)
    suffixes = np.argsort(keyed.view(f"S{keyed.shape[1]}").ravel(), kind="stable")
    out, rows, gram, right = out[suffixes], rows[suffixes], gram[suffixes], right[suffixes]
    prefixes = np.where(np.concatenate(([False], gram[1:] == gram[:-1])), common_prefixes(right), 0)
    before = np.ascontiguousarray(rows[:, REACH - 1::-1])  # bytes before the anchor, nearest first
    starts = np.flatnonzero(prefixes == 0)
    sizes = np.diff(np.append(starts, len(rows)))

    two = starts[sizes == 2]  # an interval of two suffixes needs no scan
    if len(two):
        same = before[two] == before[two + 1]
        left = np.where(same.all(axis=1), REACH, same.argmin(axis=1))
        shared = ((LENGTH - offsets <= prefixes[two + 1, None]) & (offsets <= left[:, None])
                  & (out[two] < NONE) & (out[two + 1] < NONE))
        low = np.minimum(out[two], out[two + 1])
        out[two] = np.where(shared, low, out[two])
        out[two + 1] = np.where(shared, low, out[two + 1])

    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        inner = prefixes[start:start + size].copy()
        inner[0] = 0
        for depth, i, j, parent in intervals(inner):
            low, high = LENGTH - depth, min(REACH, LENGTH - parent - 1)
            if low > high or low < 0:
                continue
            members = np.arange(start + i, start + j + 1)
            order = np.argsort(np.ascontiguousarray(before[members]).view(f"S{REACH}").ravel(), kind="stable")
            members = members[order]
            left = common_prefixes(before[members])
            left[0] = -1
            for o in range(low, high + 1):
                mine = members
                bounds = np.flatnonzero(left < o)  # the bytes before differ: another group
                best = np.minimum.reduceat(out[mine, o], bounds)
                value = np.repeat(best, np.diff(np.append(bounds, len(mine))))
                out[mine, o] = np.where(out[mine, o] < NONE, value, NONE)
    back = np.empty_like(out)
    back[suffixes] = out
    return back


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``n_bytes``, the removed ``spans`` (start, length in bytes), the ``kept`` bytes.

    A byte is removed if a string of 50 bytes over it also starts in a document with a smaller id. A null text is an
    empty one. Rows that repeat an id do not take from each other. Rows without an id take no part and lose nothing.
    Other columns are not read. Ids are whole numbers.

    The text is shuffled by block once and read three times from there. A gram is sent once per block, and equal window
    bytes are sent once per block with their smallest and largest document, so a frequent passage costs a bucket
    no more than one row for each block and each way it ends.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    docs, n = in_blocks(rows, "id", "text")

    def known(table: pa.Table) -> tuple[np.ndarray, Runs, list[int | None]]:
        ids, texts = documents_of(table)
        runs = Runs(texts)
        missing = np.array([i is None for i in ids], bool)
        if missing.any():
            runs.keep(~missing[runs.doc])
        return np.array([i or 0 for i in ids], np.int64), runs, ids

    def grams(table: pa.Table) -> pa.Table:
        ids, runs, _ = known(table)
        order = np.lexsort((ids[runs.doc], runs.gram))
        gram, doc = runs.gram[order], ids[runs.doc][order]
        new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])))[:len(gram)]
        distinct, counts = np.unique(gram[new], return_counts=True)
        return pa.Table.from_batches([pack(table["block"][0].as_py(), distinct, counts, n)])

    def windows(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"bucket": [], "block": [], "rows": [], "low": [], "high": []}
        if left.num_rows and right.num_rows:
            ids, runs, _ = known(left)
            runs.keep(Totals(right, n).of(runs.gram) > 1)
            around = runs.rows()
            _, first, at = np.unique(row_hashes(around), return_index=True, return_inverse=True)
            low, high = np.full(len(first), NONE), np.full(len(first), -NONE)
            np.minimum.at(low, at, ids[runs.doc])
            np.maximum.at(high, at, ids[runs.doc])
            bucket = bucket_of(runs.gram[first], n)
            for b in np.unique(bucket).tolist():
                mine = bucket == b
                out["bucket"].append(b)
                out["block"].append(key[0].as_py())
                out["rows"].append(squeeze(around[first[mine]].tobytes()))
                out["low"].append(squeeze(low[mine].tobytes()))
                out["high"].append(squeeze((high - low)[mine].tobytes()))
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    def compared(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(expand(r.as_py()), np.uint8).reshape(-1, ROW) for r in table["rows"]]
        low = np.concatenate([np.frombuffer(expand(x.as_py()), np.int64) for x in table["low"]])
        high = low + np.concatenate([np.frombuffer(expand(x.as_py()), np.int64) for x in table["high"]])
        block = np.repeat(table["block"].to_numpy(), [len(s) for s in sent])
        around = np.concatenate(sent)
        hashes = row_hashes(around)
        _, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        document = np.full(len(first), NONE)
        np.minimum.at(document, at, low)
        distinct = around[first]
        gram = gram_hashes(distinct)[at]
        best = smallest_documents(distinct, document)[at]
        best = np.where(best < high[:, None], best, NONE)  # else no document of the block loses the window
        edge = np.concatenate((np.full((len(best), 1), NONE), best, np.full((len(best), 1), NONE)), axis=1)
        row, start = np.nonzero((best < NONE) & (edge[:, :-2] != best))
        _, end = np.nonzero((best < NONE) & (edge[:, 2:] != best))
        out = {"block": [], "found": []}
        found = np.empty(len(row), FOUND)
        found["hash"], found["gram"], found["low"] = hashes[row], gram[row] >> np.uint64(32), best[row, start]
        found["from"], found["to"] = start, end
        for b in np.unique(block[row]).tolist():
            out["block"].append(b)
            out["found"].append(squeeze(found[block[row] == b].tobytes()))
        return pa.table([pa.array(out["block"], pa.int32()), pa.array(out["found"], pa.binary())],
                        names=["block", "found"])

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_bytes", "spans", "kept"]
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), spans_type, pa.binary())], names=names)
        found = np.concatenate([np.empty(0, FOUND), *(np.frombuffer(expand(x.as_py()), FOUND) for x in right["found"])])
        found = found[np.argsort(found["hash"], kind="stable")]
        ids, runs, given = known(left)
        gone = np.zeros(len(runs.data), np.int32)
        if len(found):
            runs.keep(np.isin((runs.gram >> np.uint64(32)).astype("<u4"), found["gram"]))
            hashes = row_hashes(runs.rows())
            start = np.searchsorted(found["hash"], hashes)
            count = np.searchsorted(found["hash"], hashes, "right") - start
            run = np.repeat(np.arange(len(hashes)), count)
            hit = found[np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())]
            lost = hit["low"] < ids[runs.doc[run]]
            run, hit = run[lost], hit[lost]
            np.add.at(gone, runs.anchor[run] - hit["to"], 1)
            np.add.at(gone, runs.anchor[run] - hit["from"] + LENGTH, -1)
        covered = np.cumsum(gone) > 0
        spans, kept = [], []
        for start, size in zip(runs.starts.tolist(), runs.sizes.tolist(), strict=True):
            mine = covered[start:start + size]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mine, [False])).astype(np.int8))).tolist()
            spans.append([{"start": a, "length": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(runs.data[start:start + size][~mine].tobytes() if edges
                        else runs.data[start:start + size].tobytes())
        return pa.table([pa.array(given, pa.int64()), pa.array(runs.sizes), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                        names=names)

    blocks = docs.groupBy("block")
    counted = count_hashes(blocks.applyInArrow(grams, PACKED))
    sent = blocks.cogroup(counted.groupBy("block")).applyInArrow(
        windows, "bucket int, block int, rows binary, low binary, high binary")
    found = sent.groupBy("bucket").applyInArrow(compared, "block int, found binary")
    out = blocks.cogroup(found.groupBy("block")).applyInArrow(
        cut, "id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


FOUND = np.dtype([("hash", "<u8"), ("gram", "<u4"), ("low", "<i8"), ("from", "u1"), ("to", "u1")])
