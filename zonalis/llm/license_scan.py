"""Licence scan by patience alignment of texts with templates.

Words that occur once in both are anchors; the longest run of anchors in increasing order is kept, and the gaps between
them are aligned in the same way. Coverage is the share of a template's words that are aligned close together.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

COVERAGE = 0.9
STRETCH = 1.5
ROOM = 4
GAP = 8
WORD = re.compile(r"\w+")

# Notices and short licence texts as their authors ask to state them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.""",
}


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first part, with increasing second parts (piles of patience)."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(last[pile - 1] if pile else -1)
        tops[pile:pile + 1] = [b]
        last[pile:pile + 1] = [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """(place in the template, place in the text) of aligned words, ascending in both."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(template), 0, len(text))]
    while stack:
        a, a_end, b, b_end = stack.pop()
        while a < a_end and b < b_end and template[a] == text[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and template[a_end - 1] == text[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        ours, theirs = Counter(template[a:a_end]), Counter(text[b:b_end])
        where = {w: i for i, w in enumerate(text[b:b_end], b) if theirs[w] == 1}
        anchors = longest_increasing([(i, where[w]) for i, w in enumerate(template[a:a_end], a)
                                      if ours[w] == 1 and w in where])
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
        stack += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)
                  if k > i + 1 and m > j + 1]
    return sorted(out)


def _segments(words: list[str], vocabulary: set[str], room: int) -> Iterator[tuple[int, int]]:
    """Stretches of the text in which words of the template follow each other closely."""
    start = end = None
    for i, w in enumerate(words):
        if w in vocabulary:
            if start is not None and i - end > room:
                yield start, end + 1
                start = None
            start, end = (i if start is None else start), i
    if start is not None:
        yield start, end + 1


def cover(words: list[str], template: list[str]) -> tuple[float, int, int]:
    """(coverage, first word, end) of the best place; places nearer than ``STRETCH`` templates are searched together."""
    best = (0.0, 0, 0)
    widest = int(STRETCH * len(template)) + ROOM
    for start, end in _segments(words, set(template), GAP):
        # Overlapping windows, so that far repetitions of a word do not hide an anchor.
        for low in range(start, max(start + 1, end - widest), max(1, widest // 2)):
            pairs = align(words[low:min(end, low + 2 * widest)], template)
            left = 0
            for right, (_, b) in enumerate(pairs):
                while b - pairs[left][1] >= widest:
                    left += 1
                share = (right - left + 1) / len(template)
                if share > best[0]:
                    best = (share, low + pairs[left][1], low + b + 1)
    return best


def scan_licenses(df: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df`` and licence with a coverage of at least ``least``: the id, ``license``, ``coverage``,
    ``first_word`` and ``end_word`` of the best place.

    A template is aligned only if the text has enough of its words at all, which coverage needs anyway. Null and empty
    texts match nothing; null and repeated ids are carried through. Other columns are not read. No shuffle.
    """
    prepared = {name: words_of(t) for name, t in sorted(templates.items())}
    prepared = {name: t for name, t in prepared.items() if t}
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = {w for t in prepared.values() for w in t}
        for batch in batches:
            at: list[int] = []
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                there = vocabulary.intersection(words)
                for name, template in prepared.items():
                    if sum(w in there for w in template) >= least * len(template):
                        share, first, end = cover(words, template)
                        if share >= least:
                            at.append(i)
                            rows.append((name, share, first, end))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=[id_col, "license", "coverage", "first_word", "end_word"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, license string, coverage double, first_word long, end_word long")
