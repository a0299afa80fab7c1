"""Exact Jaccard self-join of word n-gram sets over prefix trees.

Sets that cannot have a partner leave first: a partner at similarity t holds at least t of a set's n-grams, so of any
part of the set at most (1 - t) of the whole may occur nowhere else. The rest are cut into cells: sets that share one of
their rarest n-grams, in one global order, directly or through others. A cell's sets, stored in one order, form a
trie. A set walks the branches that lead to a set with one of its rarest n-grams, carrying its overlap with the path so
far, which all sets below share, and leaves a branch when even all that remains cannot reach the threshold.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import (
    PACKED,
    Totals,
    connected_components,
    count_hashes,
    documents_of,
    in_blocks,
    lean_group,
    lean_pair,
    mix,
    pack,
)
from zonalis.sources.session import staged

WORDS = 5
NEED = (80, 100)  # similarity as a fraction of whole numbers
EARLY = 0.4  # share of a set, lowest hashes first, that the first filter looks at
CELL_TOKENS = 2_000_000
CHUNK_BYTES = 1 << 20
BLOCKS_PER_BUCKET = 4  # every block sends a row to every bucket of hashes, so their number counts twice

# The white space between words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_RANDOM = np.random.Generator(np.random.PCG64(7))
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_FACTOR = 0x2545F4914F6CDD1D
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES + 2), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _forget_powers() -> None:
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data`` with A-Z in lower case."""
    b = np.frombuffer(data.lower(), np.uint8)
    apart = np.concatenate(([True], SPACE[b], [True]))
    starts = np.flatnonzero(apart[:-1] & ~apart[1:])
    ends = np.flatnonzero(~apart[:-1] & apart[1:])
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    up, down = _powers(len(b) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * up[:-1], dtype=np.uint64)))
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, mix(hashes + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-grams of words; a shorter text is one n-gram."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out: list[np.ndarray] = []
    start = 0
    while start < len(data):
        end, size = start, 0
        while end < len(data) and (end == start or size + len(data[end]) < CHUNK_BYTES):
            size += len(data[end]) + 1
            end += 1
        at, hashes = word_hashes(b"\n".join(data[start:end]))
        edges = np.cumsum([0] + [len(x) + 1 for x in data[start:end]])
        bounds = np.searchsorted(at, edges)
        grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words if len(grams) else 0):
            grams = mix(grams + hashes[k:len(hashes) - words + 1 + k])
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if high - low >= words:
                out.append(np.unique(grams[low:high - words + 1]))
            else:
                short = np.zeros(min(1, high - low), np.uint64)
                for h in hashes[low:high]:
                    short = mix(short + h + np.uint64(high - low))
                out.append(short)
        start = end
    return out


def may_miss(n: int, need: tuple[int, int] = NEED) -> int:
    """How many of n elements a partner may lack at most."""
    return n - -(-n * need[0] // need[1])


def linked(overlap: int, a: int, b: int, need: tuple[int, int] = NEED) -> bool:
    return need[1] * overlap >= need[0] * (a + b - overlap) and overlap > 0


class _Node:
    __slots__ = ("tokens", "depth", "parent", "children", "members", "shortest", "longest", "asked", "picked")

    def __init__(self, tokens: np.ndarray, depth: int):
        self.tokens, self.depth = tokens, depth
        self.parent: _Node | None = None
        self.children: list[_Node] = []
        self.members: list[int] = []
        self.shortest, self.longest = sys.maxsize, 0
        self.asked = 0  # the last walk that had to pass here, and the children it had to enter
        self.picked: list[_Node] = []


def build_trie(sets: list[np.ndarray]) -> _Node:
    """Radix trie of ascending arrays of token numbers."""
    root = _Node(np.empty(0, np.int32), 0)
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
    stack = [root]
    before = np.empty(0, np.int32)
    for i in order:
        now = sets[i]
        m = min(len(before), len(now))
        differ = np.flatnonzero(before[:m] != now[:m])
        common = int(differ[0]) if len(differ) else m
        last = None
        while stack[-1].depth > common:
            last = stack.pop()
        if stack[-1].depth < common:  # the edge to the last node is cut at the common prefix
            top = stack[-1]
            middle = _Node(last.tokens[:common - top.depth], common)
            last.tokens = last.tokens[common - top.depth:]
            top.children[-1] = middle
            middle.children.append(last)
            stack.append(middle)
        if len(now) > common:
            leaf = _Node(now[common:], len(now))
            stack[-1].children.append(leaf)
            stack.append(leaf)
        stack[-1].members.append(i)
        before = now
    walk, seen = [root], []
    while walk:
        node = walk.pop()
        seen.append(node)
        for child in node.children:
            child.parent = node
        walk.extend(node.children)
    for node in reversed(seen):
        sizes = [node.depth] if node.members else []
        node.shortest = min([c.shortest for c in node.children] + sizes, default=0)
        node.longest = max([c.longest for c in node.children] + sizes, default=0)
    return root


def trie_join(sets: list[np.ndarray], need: tuple[int, int] = NEED) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between positions that connect all linked sets, and the component of each.

    Two linked sets share one of the rarest n-grams of either, as many as a partner may miss and one more. A set enters
    only the branches that lead to such a set of another component, so its way does not grow with the number of sets.
    """
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.empty(len(tokens), np.int32)
    number[np.lexsort((tokens, -counts))] = np.arange(len(tokens), dtype=np.int32)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    sets = [np.sort(x) for x in np.split(number[at], cuts)]
    sizes = np.array([len(s) for s in sets], np.int64)
    root = build_trie(sets)
    home: dict[int, _Node] = {}
    walk = [root]
    while walk:
        node = walk.pop()
        home.update((m, node) for m in node.members)
        walk.extend(node.children)

    part = np.arange(len(sets))
    parts: dict[int, list[int]] = {}
    links: list[tuple[int, int]] = []

    def link(a: int, b: int) -> None:
        links.append((a, b))
        small, large = sorted((int(part[a]), int(part[b])), key=lambda x: len(parts.get(x, [x])))
        moved = parts.pop(small, [small])
        part[moved] = large
        parts.setdefault(large, [large]).extend(moved)

    mine = np.zeros(len(tokens), bool)

    def visit(q: int, query: np.ndarray, others: list[int]) -> None:
        """Walk the branches that lead to ``others``."""
        nonlocal turn
        turn += 1
        for m in others:
            node, below = home[m], None
            while node is not None and node.asked != turn:
                node.asked, node.picked = turn, [below] if below else []
                node, below = node.parent, node
            if node is not None and below is not None:
                node.picked.append(below)
        size = len(query)
        path: list[tuple[_Node, int]] = [(root, 0)]
        while path:
            node, overlap = path.pop()
            if len(node.tokens):
                overlap += int(np.count_nonzero(mine[node.tokens]))
                left = size - int(query.searchsorted(node.tokens[-1], "right"))
                best = min(max(node.depth + left, node.shortest), node.longest)
                most = overlap + min(best - node.depth, left)
                if (need[0] + need[1]) * most < need[0] * (size + best):
                    continue
            for m in node.members[:1]:
                if part[m] != part[q] and linked(overlap, size, node.depth, need):
                    link(q, m)
            for child in node.picked:
                path.append((child, overlap))

    turn = 0
    # Sets by their rare tokens, in ascending order for each token.
    rare = [s[len(s) - may_miss(len(s), need) - 1:] if len(s) else s for s in sets]
    lengths = np.array([len(r) for r in rare])
    ends = np.cumsum(lengths)
    flat = np.concatenate(rare)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(sets)), lengths)[order]
    first = np.searchsorted(flat[order], flat)  # of the token's sets
    own = np.empty(len(flat), np.int64)
    own[order] = np.arange(len(flat))
    for q, query in enumerate(sets):
        if home[q].members[0] != q:  # all members of a node are equal sets
            link(home[q].members[0], q)
            continue
        size = len(query)
        spans = slice(ends[q] - lengths[q], ends[q])
        met = [owner[a:b] for a, b in zip(first[spans].tolist(), own[spans].tolist(), strict=True) if a < b]
        if not met:
            continue
        met = np.concatenate(met)
        met = met[part[met] != part[q]]
        met = met[need[1] * np.minimum(sizes[met], size) >= need[0] * np.maximum(sizes[met], size)]
        if not len(met):
            continue
        mine[query] = True
        # Those with most in common first: a link ends the search among all others of that component.
        rest, common = np.unique(met, return_counts=True)
        rest, most_first = rest[np.argsort(-common, kind="stable")], 1
        while len(rest):
            visit(q, query, rest[:most_first].tolist())
            rest = rest[most_first:]
            rest, most_first = rest[part[rest] != part[q]], 4 * most_first
        mine[query] = False
    return links, part


def ngram_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                     need: tuple[int, int] = NEED) -> DataFrame:
    """One row per distinct id: the id, ``n_shingles`` and ``component_id``.

    Documents link at a Jaccard similarity of ``need``; the component is the smallest id that links lead to. Equal
    sets are one class from the start, so copies are never paired. Texts that are null, empty or without words have
    no set and are alone. Rows that repeat an id and its text are one document; an id with several texts is one document
    that has all their links and the largest of their sets. A null id is a component of its own (null), and links
    nothing. Other columns are not read. Ids are whole numbers.

    The text is shuffled once, by block. Then come 32-bit hashes of a part of each set, whole sets of the few
    documents that pass, and their rare n-grams. Cells above ``CELL_TOKENS`` are cut into parts that meet in pairs.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    docs, blocks = in_blocks(rows.filter("id is not null"), "id", "text")
    n = max(1, blocks // BLOCKS_PER_BUCKET)

    def early(s: np.ndarray) -> np.ndarray:
        return s[:max(may_miss(len(s), need) + 1, int(len(s) * EARLY))]

    def hashes(table: pa.Table) -> pa.Table:
        kept = {s.tobytes(): s for s in shingle_sets(documents_of(table)[1], words) if len(s)}
        parts = [early(s) for s in kept.values()]
        distinct, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
        return pa.Table.from_batches([pack(table["block"][0].as_py(), distinct, counts, n)])

    def passing(key, left: pa.Table, right: pa.Table) -> pa.Table:
        totals, seen, rows = Totals(right, n), set(), []
        ids, texts = documents_of(left)
        for i, s in zip(ids, shingle_sets(texts, words), strict=True):
            part, raw = early(s), s.tobytes()
            passes = len(s) and raw not in seen and np.count_nonzero(totals.of(part) < 2) <= may_miss(len(s), need)
            seen.add(raw)
            rows.append((i, len(s), hashlib.blake2b(raw, digest_size=16).digest(), raw if passes else None))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                        names=["id", "n", "sign", "grams"])

    packed = docs.groupBy("block").applyInArrow(lean_group(hashes, _forget_powers), PACKED)
    facts = staged(docs.groupBy("block").cogroup(count_hashes(packed).groupBy("block")).applyInArrow(
        lean_pair(passing, _forget_powers), "id long, n long, sign binary, grams binary"), "trie-facts")

    # One set per class of equal sets, under the smallest id.
    classes = facts.filter("n > 0").groupBy("sign").agg(F.min("id").alias("class"))
    kept = facts.filter("grams is not null").groupBy("sign").agg(F.first("grams").alias("grams")).join(classes, "sign")
    kept = staged(kept.select(F.pmod(F.xxhash64("class"), F.lit(n)).cast("int").alias("block"),
                              F.col("class").alias("id"), "grams"), "trie-sets")

    def own(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(g.as_py(), np.uint64) for g in table["grams"]]
        distinct, counts = np.unique(np.concatenate(sets), return_counts=True)
        return pa.Table.from_batches([pack(table["block"][0].as_py(), distinct, counts, n)])

    def rare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        totals = Totals(right, n)
        ids, grams = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, g in zip(left["id"].to_pylist(), left["grams"], strict=True):
            s = np.frombuffer(g.as_py(), np.uint64)
            count = totals.of(s)
            first = np.lexsort((s, count))[:may_miss(len(s), need) + 1]
            shared = s[first[count[first] > 1]].view(np.int64)
            if np.count_nonzero(count < 2) <= may_miss(len(s), need):
                ids.append(np.full(len(shared), i))
                grams.append(shared)
        return pa.table({"id": pa.array(np.concatenate(ids), pa.int64()),
                         "gram": pa.array(np.concatenate(grams), pa.int64())})

    sets_of = kept.groupBy("block")
    shared = staged(sets_of.cogroup(count_hashes(kept.groupBy("block").applyInArrow(lean_group(own), PACKED)).groupBy("block"))
                    .applyInArrow(lean_pair(rare), "id long, gram long"), "trie-rare")
    hubs = shared.groupBy("gram").agg(F.min("id").alias("hub"))
    cells = connected_components(
        shared.join(hubs, "gram").filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(),
        "trie-cells")
    in_cells = kept.join(cells, kept["id"] == cells["node"]).select(
        "id", "grams", F.col("root").alias("cell"), (F.octet_length("grams") / 8).alias("tokens"))
    sizes = in_cells.groupBy("cell").agg(F.ceil(F.sum("tokens") / CELL_TOKENS).cast("int").alias("parts"))
    placed = in_cells.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "id", "grams")

    def join(table: pa.Table) -> pa.Table:
        ids = table["id"].to_pylist()
        links, _ = trie_join([np.frombuffer(g.as_py(), np.uint64) for g in table["grams"]], need)
        return pa.table({"a": pa.array([ids[i] for i, _ in links], pa.int64()),
                         "b": pa.array([ids[j] for _, j in links], pa.int64())})

    links = placed.groupBy("cell", "low", "high").applyInArrow(join, "a long, b long")
    # Rows of one id with different texts are one document.
    several = (facts.filter("n > 0").join(classes, "sign").select("id", "class")
               .groupBy("id").agg(F.min("class").alias("a"), F.collect_set("class").alias("all"))
               .filter(F.size("all") > 1).select("a", F.explode("all").alias("b")).filter("a <> b"))
    roots = connected_components(links.union(several), "trie-links")
    rows = (facts.select("id", "n", "sign").join(classes, "sign", "left").join(roots, F.col("class") == F.col("node"), "left")
            .groupBy("id").agg(F.max("n").alias("n_shingles"),
                               F.min(F.coalesce("root", "class", "id")).alias("component_id")))
    nothing = df.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id")).distinct()
    return rows.union(nothing).select(F.col("id").alias(id_col), "n_shingles", "component_id")
