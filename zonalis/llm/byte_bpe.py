"""Byte-level BPE as a tree reduction.

A piece is cut into halves down to a few bytes, the halves are encoded on their own and neighbours are joined. Joining
re-encodes a window around the seam and lets it grow until the tokens outside cannot change: a token sequence is the
encoding of its bytes exactly if every two neighbouring tokens are the encoding of their own bytes, so it is enough that
the two pairs at the edges of the window are. Decoding concatenates the bytes of the tokens up the same tree.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache
from types import MappingProxyType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from zonalis.llm.common import lean

LEAF_BYTES = 16
SEAM_BYTES = 16
LONG_BYTES = 64
KEPT_PIECES = 150_000
CHARACTERS_AT_ONCE = 1 << 20
PIECES_AT_ONCE = 250_000
NO_RANK = np.int32(0x7FFFFFFF)
KEPT_PAIRS = 100_000
DECODE_LEAF = 4096

# What Unicode calls White_Space, and the letters and numbers up to U+00FF.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN = {r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe"}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file; its size is that of a vocabulary."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBpe:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        classed = _space_classes(pattern)
        self._any = regex.compile(classed)
        self._latin = _latin_pattern(classed)
        self._packed, self._before = _Packed(self), {}
        self._pairs = _Pairs(ranks)
        self._words = [np.uint32(r).astype("<u4").tobytes() for r in range(len(self.tokens))]
        self.stable = lru_cache(KEPT_PAIRS)(self._stable)
        self._short = lru_cache(KEPT_PAIRS)(self._merge)

    def split(self, text: str) -> list[str]:
        """Matches of the pattern; texts within Latin-1 take the standard library's faster engine."""
        return (self._latin if self._latin and _within_latin(text) else self._any).findall(text)

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self._tree(piece)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts; the leaves of all pieces not seen lately are merged together."""
        split, out, start, size = [self.split(t) for t in texts], [], 0, 0
        for end, pieces in enumerate([*split, None]):
            if end > start and (pieces is None or size + len(pieces) > PIECES_AT_ONCE):
                if end == start + 1:
                    out.append(b"".join(self._pack_parts(split[start])))
                else:
                    self._learn(set().union(*split[start:end]))
                    out += [b"".join(map(self._packed.__getitem__, p)) for p in split[start:end]]
                start, size = end, 0
            size += len(pieces or ())
        return out

    def _pack_parts(self, pieces: list[str]) -> Iterator[bytes]:
        for start in range(0, len(pieces), PIECES_AT_ONCE):
            part = pieces[start:start + PIECES_AT_ONCE]
            self._learn(set(part))
            yield b"".join(map(self._packed.__getitem__, part))

    def forget(self) -> None:
        """Free what is kept between texts."""
        self._packed.clear()
        self._before.clear()
        self.stable.cache_clear()
        self._short.cache_clear()

    def _learn(self, pieces: set[str]) -> None:
        """Put the packed ids of pieces that are not kept yet into the table."""
        kept = self._packed
        new = pieces.difference(kept)
        again = new.intersection(self._before)
        kept.update((p, self._before[p]) for p in again)
        new -= again
        if len(kept) + len(new) > KEPT_PIECES:
            # Pieces seen since the last time stay for one more turn.
            self._before = dict(kept)
            kept.clear()
            kept.update((p, self._before[p]) for p in pieces.intersection(self._before))
        rank, words = self.ranks.get, self._words
        short, raw, long = [], [], []
        for p in new:
            b = p.encode("utf-8", "surrogatepass")
            r = rank(b)
            if r is not None:
                kept[p] = words[r]
            elif len(b) <= LEAF_BYTES:
                short.append(p)
                raw.append(b)
            else:
                long.append((p, b))
        leaves = list({leaf for _, b in long for leaf in _leaves(b)})
        merged = self._pairs.merge_all(raw + leaves)
        kept.update(zip(short, merged, strict=False))
        known = {leaf: np.frombuffer(m, "<u4").tolist() for leaf, m in zip(leaves, merged[len(raw):], strict=True)}
        for p, b in long:
            ids = self._tree(b, known)
            if len(ids) <= 64:
                kept[p] = b"".join(map(words.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def pack(self, piece: bytes) -> bytes:
        return b"".join(map(self._words.__getitem__, self.encode_piece(piece)))

    def _tree(self, piece: bytes, known: Mapping[bytes, list[int]] = MappingProxyType({})) -> list[int]:
        """Halves encoded and joined; ``known`` has the ids of some leaves."""
        if len(piece) <= LEAF_BYTES:
            return known[piece] if piece in known else self._merge(piece)
        half = len(piece) // 2
        return self._join(self._tree(piece[:half], known), self._tree(piece[half:], known))

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            seam = self.decode(left[-i:]) + self.decode(right[:j])
            window = self._short(seam) if len(seam) <= SEAM_BYTES else self._merge(seam)
            left_holds = i == len(left) or self.stable(left[-i - 1], window[0])
            right_holds = j == len(right) or self.stable(window[-1], right[j])
            if left_holds and right_holds:
                return left[:-i] + window + right[j:]
            i, j = i * (1 if left_holds else 2), j * (1 if right_holds else 2)

    def _stable(self, first: int, second: int) -> bool:
        return self._merge(self.tokens[first] + self.tokens[second]) == [first, second]

    def _merge(self, piece: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until no pair has a rank."""
        if len(piece) > LONG_BYTES:
            return self._merge_long(piece)
        rank, none = self.ranks.get, len(self.tokens)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            merged = self.tokens[best]
            parts[at:at + 2] = [merged]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(merged + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + merged, none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        n, rank = len(piece), self.ranks.get
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = ends[i]
            if not alive[i] or j >= n or ends[j] != end:
                continue
            ends[i], alive[j] = end, False
            if end < n:
                before[end] = i
                if (r := rank(piece[i:ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (k := before[i]) >= 0 and (r := rank(piece[k:end])) is not None:
                heapq.heappush(heap, (r, k, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:ends[i]]])
            i = ends[i]
        return out


def _within_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _leaves(piece: bytes) -> Iterator[bytes]:
    """The parts that ``ByteBpe._tree`` begins with."""
    if len(piece) <= LEAF_BYTES:
        yield piece
    else:
        half = len(piece) // 2
        yield from _leaves(piece[:half])
        yield from _leaves(piece[half:])


class _Pairs:
    """Ranks of neighbouring tokens as sorted arrays, to merge many short parts at once."""

    def __init__(self, ranks: dict[bytes, int]):
        found = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                       if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([k for k, _ in found], np.int64)
        self.ranks = np.array([r for _, r in found], np.int32)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.first = self._of(self.bytes[first], self.bytes[second]).reshape(256, 256)

    def _of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merge_all(self, parts: list[bytes]) -> list[bytes]:
        """Packed ids of every part: of all pairs that of lowest rank, leftmost first, is merged until none has a rank."""
        out = [b""] * len(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            raw = np.frombuffer(b"".join([parts[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), size)
            ids, rank = self.bytes[raw], np.ascontiguousarray(self.first[raw[:, :-1], raw[:, 1:]])
            while len(rows):
                best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
                lowest = rank[np.arange(len(rows)), best] if rank.shape[1] else np.full(len(rows), NO_RANK)
                done = lowest == NO_RANK
                packed, width = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
                for at, i in enumerate(rows[done].tolist()):
                    out[i] = packed[at * width:(at + 1) * width]
                go = ~done
                rows, best, lowest, ids, rank = rows[go], best[go], lowest[go], ids[go], rank[go]
                if not len(rows):
                    break
                at, column = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
                ids[at, best] = lowest
                ids = ids.ravel()[(at * ids.shape[1])[:, None] + column + (column > best[:, None])]
                column = column[:-1]
                rank = rank.ravel()[(at * rank.shape[1])[:, None] + column + (column >= best[:, None])]
                if not rank.shape[1]:
                    continue
                right = np.flatnonzero(best < rank.shape[1])
                rank[right, best[right]] = self._of(ids[right, best[right]], ids[right, best[right] + 1])
                left = np.flatnonzero(best > 0)
                rank[left, best[left] - 1] = self._of(ids[left, best[left] - 1], ids[left, best[left]])
        return out


class _Packed(dict):
    """Packed ids of pieces seen lately; emptied when full, so a worker's memory stays bounded."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self._bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_PIECES:
            self.clear()
        packed = self._bpe.pack(piece.encode("utf-8", "surrogatepass"))
        if len(packed) <= 256:
            self[piece] = packed
        return packed


def _space_classes(pattern: str) -> str:
    r"""The pattern with \s spelt out, since engines differ on the control characters U+001C to U+001F."""
    inside, out, i = False, [], 0
    while i < len(pattern):
        c = pattern[i:i + 2] if pattern[i] == "\\" else pattern[i]
        inside = c == "[" or inside and c != "]"
        if c == r"\s":
            c, i = (SPACES if inside else f"[{SPACES}]"), i + 1
        elif c == r"\S" and not inside:
            c, i = f"[^{SPACES}]", i + 1
        elif len(c) == 2:
            i += 1
        out.append(c)
        i += 1
    return "".join(out)


def _latin_pattern(pattern: str):
    for name, letters in LATIN.items():
        pattern = pattern.replace(f"{name}+", f"[{letters}]+").replace(name, letters)
        # Inside a negated class only the members are wanted.
        pattern = re.sub(r"(\[\^[^\[\]]*)\[([^\[\]]*)\]\+", r"\1\2", pattern)
    try:
        return re.compile(pattern) if r"\p" not in pattern else None
    except re.error:
        return None


_LOADED: dict[tuple, ByteBpe] = {}


def _encoder(key: tuple, ranks: bytes, pattern: str) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    if key not in _LOADED:
        _LOADED.clear()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _LOADED[key] = ByteBpe(table, pattern)
        gc.freeze()  # the vocabulary stays: the collector need not walk it again and again
    return _LOADED[key]


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``CHARACTERS_AT_ONCE`` bytes."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.float64))
    run = (np.cumsum(sizes) // CHARACTERS_AT_ONCE).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))[:len(run)]).tolist()
    return zip(starts, [*starts[1:], len(run)], strict=True)


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 decode: bool = True, width: int = 4) -> DataFrame:
    """One row per row of ``df``: the id, ``ids`` and ``decoded``; ids take ``width`` bytes each (4, or 2 if all fit).

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` the bytes they stand for (null with
    ``decode=False``). No shuffle; a worker holds one batch and, until its task ends, a bounded table of pieces. A null text is an empty one.
    Null or repeated ids are carried through. Other columns are not read.
    """
    with open(ranks_path, "rb") as file:
        raw = file.read()
    shared = df.sparkSession.sparkContext.broadcast(raw)  # the size of a vocabulary file
    key = (ranks_path, pattern, len(raw))
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(key, shared.value, pattern)
        try:
            for batch in batches:
                for start, end in _runs(batch.column(1)):
                    texts = [t or "" for t in batch.column(1).slice(start, end - start).to_pylist()]
                    ids = bpe.encode_all(texts)
                    plain = [bpe.decode(np.frombuffer(x, "<u4").tolist()) if decode else None for x in ids]
                    if width == 2:
                        ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, end - start), pa.array(ids, pa.binary()),
                         pa.array(plain, pa.binary())], names=[id_col, "ids", "decoded"])
        finally:
            bpe.forget()

    return df.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, ids binary, decoded binary")
