"""Licence notices and texts in documents: Dice coefficient of word bigrams with templates.

Lines of a document that share a bigram with a template are candidates, alone,
together with the lines next to them, and as windows of a template's length within a longer line or run of lines. A template is compared only
if the sizes allow the coefficient: for threshold t, a stretch has between t / (2 - t) and (2 - t) / t times its bigrams.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts

# Public licence notices and texts, as their authors publish them.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Released under the BSD License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL": ["This work is licensed under the GNU Lesser General Public License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "All-Rights-Reserved": ["All rights reserved."],
}

_TOKEN = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
Bigrams = Counter


def words_of(text: str) -> list[str]:
    """Normalised words: lower case, letters and digits only, version numbers in one piece."""
    return _TOKEN.findall(text.lower())


def bigrams(words: list[str]) -> Bigrams:
    return Counter(zip(words, words[1:]))


def dice(a: Bigrams, b: Bigrams) -> float:
    """Twice the common bigrams, as often as both have them, over all of both."""
    total = a.total() + b.total()
    return 2 * sum(min(n, b[g]) for g, n in a.items() if g in b) / total if total else 0.0


class Templates:
    def __init__(self, templates: Mapping[str, list[str]], threshold: float):
        self.threshold = threshold
        self.all = [(name, len(words_of(t)), bigrams(words_of(t))) for name, forms in templates.items() for t in forms]
        self.holding: dict[tuple[str, str], list[int]] = {}
        for n, (_, _, grams) in enumerate(self.all):
            for g in grams:
                self.holding.setdefault(g, []).append(n)
        self.first_words = {a for a, _ in self.holding}
        self.words = {w for g in self.holding for w in g}

    def compare(self, words: list[str], found: dict[str, tuple[float, int, int]], place: tuple[int, int]) -> None:
        """Compare one stretch with the templates that share a bigram with it and fit in size."""
        grams = bigrams(words)
        size, t = grams.total(), self.threshold
        for n in {n for g in grams for n in self.holding.get(g, ())}:
            name, _, template = self.all[n]
            if t * template.total() <= (2 - t) * size and t * size <= (2 - t) * template.total():
                self._note(found, name, dice(grams, template), place)

    def _note(self, found: dict, name: str, value: float, place: tuple[int, int]) -> None:
        if value >= self.threshold and (name not in found or value > found[name][0]):
            found[name] = (value, *place)

    def windows(self, words: list[str], found: dict[str, tuple[float, int, int]], lines: list[int]) -> None:
        """Stretches of a template's length that begin with one of its bigrams; of those that overlap the best count. ``lines`` has the line of each word."""
        fits: list[tuple[float, int, int, str]] = []
        starts: dict[int, list[int]] = {}
        for i, g in enumerate(zip(words, words[1:])):
            for n in self.holding.get(g, ()):
                starts.setdefault(n, []).append(i)
        for n, places in starts.items():
            name, length, template = self.all[n]
            if len(words) <= length or len(places) < self.threshold * template.total() / 2:
                continue
            for k, i in enumerate(places):
                stretch = min(length, len(words) - i)
                if 2 * (bisect_left(places, i + stretch - 1) - k) < self.threshold * (template.total() + stretch - 1):
                    continue
                value = dice(bigrams(words[i : i + stretch]), template)
                if value >= self.threshold:
                    fits.append((value, i, i + stretch, name))
        # only the best of each licence can drop another, so few are compared
        top: dict[str, tuple[float, int, int, str]] = {}
        for fit in fits:
            if fit[3] not in top or fit[0] > top[fit[3]][0]:
                top[fit[3]] = fit
        for value, i, stop, name in fits:
            if not any(best[0] > value and best[1] < stop and i < best[2] for other, best in top.items() if other != name):
                self._note(found, name, value, (lines[i], lines[stop - 1] + 1))

    def scan(self, text: str) -> dict[str, tuple[float, int, int]]:
        """By licence: best coefficient and the lines where it was found, the last one excluded."""
        found: dict[str, tuple[float, int, int]] = {}
        run: list[str] = []
        lines_of: list[int] = []
        begin = 0
        lines = text.split("\n")
        for i, line in enumerate([*lines, ""]):
            words = words_of(line)
            pairs = zip(words, words[1:])
            near = not self.first_words.isdisjoint(words) and any(g in self.holding for g in pairs)
            if near:
                self.compare(words, found, (i, i + 1))
                self.windows(words, found, [i] * len(words))
                if not run:
                    begin = i
                run += words
                lines_of += [i] * len(words)
            elif run and words and self.words.issuperset(words):  # a short line within a licence
                run += words
                lines_of += [i] * len(words)
            elif run and (words or i == len(lines)):  # blank lines do not end a run
                if i - begin > 1:
                    self.compare(run, found, (begin, i))
                    self.windows(run, found, lines_of)
                run, lines_of = [], []
        best: dict[tuple[int, int], float] = {}
        for value, *place in found.values():
            best[tuple(place)] = max(value, best.get(tuple(place), 0.0))
        return {name: v for name, v in found.items() if v[0] == best[v[1:]]}


@lru_cache(maxsize=2)
def _known(threshold: float) -> Templates:
    return Templates(TEMPLATES, threshold)


_FOUND = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("dice", pa.float64()), ("start_line", pa.int64()), ("end_line", pa.int64())])


def find_licences(docs: DataFrame, threshold: float = 0.8, templates: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Licences named or quoted in documents.

    ``docs`` needs ``doc_id`` and ``text``; null and empty texts give nothing, ids may be null or repeated. Per
    document and licence that fits best at its place: doc_id, licence, dice (the best of all its templates and places), start_line and end_line of that place (counted
    from 0, end excluded; the first one of equals). Whole texts are read; no shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(threshold) if templates is None else Templates(templates, threshold)
        for part in slices(batches):
            out: dict[str, list] = {f.name: [] for f in _FOUND}
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                for name, place in sorted(known.scan(text).items()):
                    for column, value in zip(out.values(), (doc_id, name, *place)):
                        column.append(value)
            yield batch(out, _FOUND)

    return rows.mapInArrow(run, "doc_id long, licence string, dice double, start_line long, end_line long")
