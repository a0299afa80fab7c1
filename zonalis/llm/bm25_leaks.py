"""Benchmark decontamination: training passages as queries against a BM25 index of the test items.

An item's term weights are divided by the score the item gives itself, so a passage scores at most 1 with it. Items lie
in blocks; a term has its largest weight in each block. The passage's lightest terms, which stay below the
threshold together, name no block; of the blocks that the others name, those whose largest weights do not add up to the threshold
are never opened. Inside the rest block-max WAND moves from one possible item to the next.
What is found counts if question and answer overlap with the passage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import lean

K1 = 1.2
B = 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
GRAM = 3
BLOCK = 8
STRIDE = 64
INDEX_BYTES = 16 << 20
WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.?!])\s+|\n+")
EPSILON = 1e-9
LIGHT = 0.5
ENTRIES = 1 << 21  # numbers handled at once
WINDOWS = 1 << 11
WORDS = 1 << 16  # of documents searched together


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of a single sentence its last quarter is."""
    parts = [w for w in map(words_of, SENTENCE_END.split(text or "")) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def grams_of(words: list[str], n: int = GRAM) -> set[tuple[str, ...]]:
    """Distinct n-grams; fewer words are one."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def share_found(grams: set[tuple[str, ...]], words: list[str]) -> float:
    """Share of the n-grams that occur among the words; 1 if there are none."""
    if not grams:
        return 1.0
    lengths = {len(g) for g in grams}
    there = set().union(*(zip(*(words[k:] for k in range(n)), strict=False) for n in lengths))
    return len(grams & there) / len(grams)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``lengths[0]`` numbers, then the next run."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class Index:
    """Postings of one slice of the items with weights by block."""

    def __init__(self, items: list[tuple[int | None, str]], frequencies: dict[str, int], n_items: int, mean_words: float):
        items = sorted(items, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        self.ids = [i for i, _ in items]
        split = [question_and_answer(t) for _, t in items]
        self.questions, self.answers = [grams_of(q) for q, _ in split], [grams_of(a) for _, a in split]
        self.longest = max((len(words_of(t)) for _, t in items), default=0)
        postings: dict[str, list[tuple[int, float]]] = {}
        for at, (_, text) in enumerate(items):
            words = words_of(text)
            counts: dict[str, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            norm = K1 * (1 - B + B * len(words) / mean_words) if words else 1.0
            weights = {w: np.log1p((n_items - frequencies[w] + 0.5) / (frequencies[w] + 0.5)) * c * (K1 + 1) / (c + norm)
                       for w, c in counts.items()}
            own = sum(weights.values())
            for w, x in weights.items():
                postings.setdefault(w, []).append((at, x / own))
        self.terms = {w: k for k, w in enumerate(postings)}
        self.items = [[i for i, _ in p] for p in postings.values()]
        self.weights = [[x for _, x in p] for p in postings.values()]
        self.n_blocks = max(1, -(-len(items) // BLOCK))
        # By term: the blocks it occurs in, and its largest weight in each. A term's entries are starts[t]:starts[t + 1].
        blocks, largest, self.starts = [], [], [0]
        for p in postings.values():
            most: dict[int, float] = {}
            for i, x in p:
                most[i // BLOCK] = max(most.get(i // BLOCK, 0.0), x)
            blocks += most
            largest += most.values()
            self.starts.append(len(blocks))
        self.starts = np.array(self.starts, np.int64)
        self.blocks, self.block_max = np.array(blocks, np.int64), np.array(largest, np.float64)
        self.keys = np.repeat(np.arange(len(postings)), np.diff(self.starts)) * self.n_blocks + self.blocks
        self.term_max = np.zeros(len(postings) + 1)  # the last one: no such term
        if len(postings):
            self.term_max[:-1] = np.maximum.reduceat(self.block_max, self.starts[:-1])

    def search(self, terms: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """(place of the item, score) of all items that reach the threshold with these distinct terms."""
        found = self.search_windows(np.zeros(len(terms), np.int64), np.asarray(terms, np.int64), threshold)
        return [(item, score) for _, item, score in found]

    def search_windows(self, windows: np.ndarray, terms: np.ndarray, threshold: float = THRESHOLD
                       ) -> list[tuple[int, int, float]]:
        """(window, place of the item, score) of all items that reach the threshold with the window's distinct terms.

        The lightest terms of a window, up to ``LIGHT`` of the threshold, find nothing alone, so only the blocks of the
        others are looked at: first with the light ones at their largest anywhere, then, in the blocks left, with
        their largest there.
        """
        threshold -= EPSILON
        most = self.term_max[terms]
        order = np.lexsort((most, windows))
        windows, terms, most = windows[order], terms[order], most[order]
        if not len(windows):
            return []
        names, first = np.unique(windows, return_index=True)
        counts = np.diff(np.append(first, len(windows)))
        below = np.cumsum(most)
        below -= np.repeat(below[first] - most[first], counts)
        mine = np.repeat(np.arange(len(names)), counts)
        light = below < LIGHT * threshold
        spare = np.zeros(len(names))
        np.maximum.at(spare, mine[light], below[light])
        heavy = np.flatnonzero(~light)
        lengths = self.starts[terms[heavy] + 1] - self.starts[terms[heavy]]
        if lengths.sum() > ENTRIES and len(names) > 1:
            half = windows < names[len(names) // 2]
            return [x for part in (half, ~half)
                    for x in self.search_windows(windows[part], terms[part], threshold + EPSILON)]
        entries = _runs(self.starts[terms[heavy]], lengths)
        pairs, at = np.unique(np.repeat(mine[heavy], lengths) * self.n_blocks + self.blocks[entries], return_inverse=True)
        sums = np.bincount(at, self.block_max[entries], len(pairs))
        pairs = pairs[sums + spare[pairs // self.n_blocks] >= threshold - EPSILON]
        out: list[tuple[int, int, float]] = []
        step = max(1, ENTRIES // int(counts.max()))
        for start in range(0, len(pairs), step):
            window, block = np.divmod(pairs[start:start + step], self.n_blocks)
            places = _runs(first[window], counts[window])
            wanted = terms[places] * self.n_blocks + np.repeat(block, counts[window])
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            most = np.where(self.keys[at] == wanted, self.block_max[at], 0.0)
            ends = np.cumsum(counts[window])
            bound = np.bincount(np.repeat(np.arange(len(window)), counts[window]), most, len(window))
            for k in np.flatnonzero(bound >= threshold).tolist():
                part = slice(int(ends[k] - counts[window[k]]), int(ends[k]))
                there = most[part] > 0
                out += ((int(names[window[k]]), item, score) for item, score in self._wand(
                    terms[places[part]][there].tolist(), most[part][there].tolist(), int(block[k]), threshold))
        return out

    def _wand(self, terms: list[int], largest: list[float], block: int, threshold: float) -> list[tuple[int, float]]:
        end = (block + 1) * BLOCK
        cursors = []  # [item, place in the postings, term, largest weight in the block]
        for t, most in zip(terms, largest, strict=True):
            at = bisect_left(self.items[t], block * BLOCK)
            cursors.append([self.items[t][at], at, t, most])
        out = []
        while True:
            cursors = sorted(c for c in cursors if c[0] < end)
            bound, pivot = 0.0, None
            for c in cursors:
                bound += c[3]
                if bound >= threshold:
                    pivot = c[0]
                    break
            if pivot is None:
                return out
            if cursors[0][0] < pivot:
                for c in cursors:
                    if c[0] < pivot:
                        self._move(c, pivot)
                continue
            score = sum(self.weights[c[2]][c[1]] for c in cursors if c[0] == pivot)
            if score >= threshold:
                out.append((pivot, score))
            for c in cursors:
                if c[0] == pivot:
                    self._move(c, pivot + 1)

    def _move(self, cursor: list, item: int) -> None:
        postings = self.items[cursor[2]]
        cursor[1] = bisect_left(postings, item, cursor[1])
        cursor[0] = postings[cursor[1]] if cursor[1] < len(postings) else 1 << 60


def build_indexes(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """Indexes of slices of at most about ``INDEX_BYTES`` of item text; term statistics are those of all items.

    Items without words are left out. Repeated and null item ids are items of their own.
    """
    given = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter(
        F.col(text_col).rlike(r"(?U)\w"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // INDEX_BYTES)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words_of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(set(w)) for w in found], pa.list_(pa.string())),
                 pa.array([len(w) for w in found], pa.int64())], names=["words", "n"])

    terms = given.select("text").mapInArrow(counted, "words array<string>, n long")
    n_items, n_words = terms.agg(F.count("*"), F.sum("n")).first()
    frequency = terms.select(F.explode("words").alias("word")).groupBy("word").count()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sorted({w for t in batch.column(0).to_pylist() for w in words_of(t)})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    out = []
    for k in range(slices):
        part = given.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        mine = part.select("text").mapInArrow(words, "word string").distinct()
        known = {r["word"]: r["count"] for r in frequency.join(mine, "word", "left_semi").collect()}
        rows = [(r["item"], r["text"]) for r in part.collect()]  # a slice: bounded by INDEX_BYTES
        out.append(Index(rows, known, n_items, n_words / n_items))
    return out


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per row of ``docs`` and item that leaks into it: both ids, ``score``, ``question_share``, ``answer_share``.

    Passages are windows of twice the stride; the stride is at least 64 words and at least the longest item, so an
    item lies in one passage wherever it is. Every passage is a query, and all items that score at least ``threshold``
    are verified: ``overlap`` of the word trigrams of the question and of the answer must occur. The best passage gives
    the row. Null, empty and very short texts have no match unless an item is as short. Null ids are carried through.
    Other columns are not read. No shuffle; the index is broadcast in slices of bounded size, and every slice reads the
    documents once.
    """
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {id_type}, item_id long, score double, question_share double, answer_share double"
    out = spark.createDataFrame([], schema)
    for index in build_indexes(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)
        found = docs.select(id_col, text_col).mapInArrow(lean(_searcher(shared, threshold, overlap)), schema)
        out = out.union(found)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all columns; ids play no part. No shuffle."""
    spark = docs.sparkSession
    for index in build_indexes(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)
        docs = docs.mapInArrow(lean(_filter(shared, docs.columns.index(text_col), threshold, overlap)), docs.schema)
    return docs


def _filter(shared, text: int, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _leaks_of(shared.value, batch.column(text), threshold, overlap)
            yield batch.filter(pa.array([not x for x in found], pa.bool_()))

    return run


def _searcher(shared, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for k, found in enumerate(_leaks_of(shared.value, batch.column(1), threshold, overlap)):
                rows += found
                at += [k] * len(found)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int64()),
                 *(pa.array(c, pa.float64()) for c in columns[1:])],
                names=[batch.schema.names[0], "item_id", "score", "question_share", "answer_share"])

    return run


def _leaks_of(index: Index, texts: pa.Array, threshold: float, overlap: float) -> Iterator[list[tuple]]:
    """The leaks of each text, searched in groups of about ``WORDS`` words."""
    held: list[list[str]] = []
    size = 0
    for text in texts:
        held.append(words_of(text.as_py()))
        size += len(held[-1])
        if size >= WORDS:
            yield from _documents(index, held, threshold, overlap)
            held, size = [], 0
    if held:
        yield from _documents(index, held, threshold, overlap)


def _documents(index: Index, texts: list[list[str]], threshold: float, overlap: float) -> list[list[tuple]]:
    """The leaks of each of several documents, given as words; windows of all of them are searched together."""
    none = len(index.terms)
    codes = np.concatenate([np.fromiter(map(index.terms.get, w, repeat(none)), np.int64, len(w)) for w in texts])
    sizes = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(sizes)
    stride = max(STRIDE, index.longest)
    counts = np.maximum(1, -(-(sizes - stride) // stride))
    owner = np.repeat(np.arange(len(texts)), counts)
    begins = (ends - sizes)[owner] + stride * _runs(np.zeros(len(texts), np.int64), counts)
    stops = np.minimum(begins + 2 * stride, ends[owner])
    sums = np.concatenate(([0.0], np.cumsum(index.term_max[codes])))
    # A word that occurs twice counts twice here: the bound is only looser for it.
    possible = np.flatnonzero(sums[stops] - sums[begins] >= threshold - 1e-6)
    best: list[dict[int, tuple]] = [{} for _ in texts]
    for start in range(0, len(possible), WINDOWS):
        part = possible[start:start + WINDOWS]
        lengths = stops[part] - begins[part]
        terms, windows = codes[_runs(begins[part], lengths)], np.repeat(part, lengths)
        known = terms < none
        windows, terms = np.divmod(np.unique(windows[known] * max(none, 1) + terms[known]), max(none, 1))
        for window, item, score in index.search_windows(windows, terms, threshold):
            k = int(owner[window])
            base = int(ends[k] - sizes[k])
            words = texts[k][int(begins[window]) - base:int(stops[window]) - base]
            question = share_found(index.questions[item], words)
            answer = share_found(index.answers[item], words)
            if question >= overlap and answer >= overlap:
                row = (round(score, 9), question, answer)
                best[k][item] = max(best[k].get(item, row), row)
    return [[(index.ids[item], *row) for item, row in sorted(found.items())] for found in best]
