"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the elementwise product of its letters' vectors, each
rotated by its place; a text is the sum of its n-grams, a language the sum of its texts. A text gets the language whose
prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import lean

DIMENSIONS = 1024
GRAM = 3
SEED = 1
UNKNOWN = "und"
ROUNDING = 1e-8  # scores of one text in two batches agree within it
CHANCE = 3 / DIMENSIONS ** 0.5  # three standard deviations of the cosine of two unrelated vectors
MAX_LANGUAGES = 5000
TEXTS_AT_ONCE = 128
GRAMS_AT_ONCE = 8192


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point its own number if it is a letter, else 0."""
    table = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


@lru_cache(1 << 12)
def _letter_vector(code: int) -> np.ndarray:
    draws = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS, np.int8)
    return 2 * draws - 1


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text's letters, packed at 21 bits a letter, and their counts.

    A run of other characters is one separator, as are both ends. Without a letter both arrays are empty.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate(([0], _letters()[codes], [0])).astype(np.int64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    if len(codes) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    packed = np.zeros(len(codes) - GRAM + 1, np.int64)
    for k in range(GRAM):
        packed = (packed << 21) | codes[k:len(codes) - GRAM + 1 + k]
    return np.unique(packed, return_counts=True)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of packed n-grams, one row each."""
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for k in range(GRAM):
        letters, at = np.unique((grams >> (21 * (GRAM - 1 - k))) & 0x1FFFFF, return_inverse=True)
        table = np.stack([np.roll(_letter_vector(int(c)), GRAM - 1 - k) for c in letters])
        out *= table[at]
    return out


def bundle(counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of the n-gram vectors of each text; whole numbers, so the order of adding does not matter."""
    out = np.zeros((len(counted), DIMENSIONS))
    if not counted or not sum(len(g) for g, _ in counted):
        return out
    grams = np.concatenate([g for g, _ in counted])
    counts = np.concatenate([c for _, c in counted])
    owner = np.repeat(np.arange(len(counted)), [len(g) for g, _ in counted])
    distinct, at = np.unique(grams, return_inverse=True)
    for start in range(0, len(distinct), GRAMS_AT_ONCE):
        part = distinct[start:start + GRAMS_AT_ONCE]
        inside = (at >= start) & (at < start + len(part))
        weights = np.zeros((len(counted), len(part)), np.float32)
        weights[owner[inside], at[inside] - start] = counts[inside]
        out += weights @ gram_vectors(part).astype(np.float32)
    return out


def fit_prototypes(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototypes by language, from every row with a text and a language."""
    return unit(fit_totals(df, text_col, lang_col))


def unit(totals: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: v / n for k, v in totals.items() if (n := np.linalg.norm(v))}


def fit_totals(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Sums of the texts by language, from every row with a text and a language.

    Tasks return one sum per language. What reaches the driver is languages x dimensions numbers; more than
    ``MAX_LANGUAGES`` labels are refused.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), batch.column(0)
            for lang in sorted(set(langs)):
                mine = [i for i, x in enumerate(langs) if x == lang]
                for start in range(0, len(mine), TEXTS_AT_ONCE):
                    counted = [gram_counts(texts[i].as_py()) for i in mine[start:start + TEXTS_AT_ONCE]]
                    grams = np.concatenate([g for g, _ in counted])
                    counts = np.concatenate([c for _, c in counted])
                    if not len(grams):
                        continue
                    distinct, at = np.unique(grams, return_inverse=True)
                    totals[lang] = totals.get(lang, 0) + bundle(
                        [(distinct, np.bincount(at, counts).astype(np.int64))])[0]
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()),
                 pa.array(total.astype(np.int64))], names=["lang", "at", "total"])

    labelled = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    summed = (labelled.mapInArrow(lean(sums), "lang string, at int, total long")
              .groupBy("lang", "at").agg(F.sum("total").alias("total")))
    rows = summed.limit(MAX_LANGUAGES * DIMENSIONS + 1).collect()
    if len(rows) > MAX_LANGUAGES * DIMENSIONS:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["total"]
    return dict(sorted(out.items()))


def predict_languages(df: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``lang_pred`` and ``score``, the cosine cut to 0 to 1.

    A null text, a text without a letter, or no prototypes at all give ``und`` and 0. Ties go to the language first in
    the alphabet. Null or repeated ids are carried through. No shuffle; only id and text are read.
    """
    predicted = _predictor(prototypes)
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                langs, scores = predicted(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs), pa.array(scores)], names=[id_col, "lang_pred", "score"])

    return df.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, lang_pred string, score double")


def in_learned_languages(df: DataFrame, prototypes: dict[str, np.ndarray], floor: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a letter and scores at least ``floor``, with all columns. No shuffle."""
    predicted, text = _predictor(prototypes), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                langs, scores = predicted(part.column(text))
                yield part.filter(pa.array([x != UNKNOWN and s >= floor for x, s in zip(langs, scores, strict=True)],
                                           pa.bool_()))

    return df.mapInArrow(lean(run), df.schema)


def _predictor(prototypes: dict[str, np.ndarray]):
    """A function from a few texts to their languages and scores."""
    names = list(prototypes)
    table = np.stack(list(prototypes.values())).T if names else np.zeros((DIMENSIONS, 0))

    def predicted(texts: pa.Array) -> tuple[list[str], np.ndarray]:
        sums = bundle([gram_counts(t.as_py()) for t in texts])
        norms = np.linalg.norm(sums, axis=1)
        if not names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosines = np.round((sums @ table) / np.where(norms, norms, 1)[:, None], 9)
        scores = np.where(norms > 0, np.clip(cosines.max(axis=1), 0, 1), 0.0)
        return [names[b] if n > 0 else UNKNOWN for b, n in zip(cosines.argmax(axis=1), norms, strict=True)], scores

    return predicted


def score_floor(df: DataFrame, totals: dict[str, np.ndarray], text_col: str = "text", lang_col: str = "lang") -> float:
    """The lowest score of all rows with a language and a letter, each scored without its own part in ``totals``.

    Scores up to ``CHANCE`` count as it: such a text is like no language more than a random vector is, whatever its label
    says, and falls below the floor. With its own part a text scores no lower, so every other labelled text reaches
    it. The only text of a language has nothing left to be scored with and does not count; ``CHANCE`` if no row counts.
    """
    names = list(totals)
    table = np.stack(list(totals.values())).T if names else np.zeros((DIMENSIONS, 0))
    lengths = np.linalg.norm(table, axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                lowest = []
                for lang, v in zip(part.column(0).to_pylist(), bundle([gram_counts(t.as_py()) for t in part.column(1)]),
                                   strict=True):
                    at = names.index(lang) if lang in totals else -1
                    rest = table[:, at] - v
                    size, left = np.linalg.norm(v), np.linalg.norm(rest)
                    if at < 0 or not size or not left:
                        continue
                    cosines = (v @ table) / np.where(lengths, lengths, 1) / size
                    cosines[at] = v @ rest / left / size
                    lowest.append(float(np.clip(cosines.max(), 0, 1)))
                if lowest:
                    yield pa.RecordBatch.from_arrays([pa.array([min(lowest)])], names=["score"])

    labelled = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    lowest = labelled.mapInArrow(lean(run), "score double").agg(F.min("score")).first()[0]
    return CHANCE if lowest is None else max(lowest - ROUNDING, CHANCE)
