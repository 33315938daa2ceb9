"""License scans: MinHash bands over overlapping windows of text find templates, shingles confirm them.

Words are lower-cased runs of digits, letters and non-ASCII characters, shingles
five of them. A text is cut into blocks of shingles; three neighbouring blocks
are a window, and windows overlap by two blocks. Blocks of 1, 2, 4, ... shingles
give windows for templates of any length: a template of ``m`` shingles uses the
smallest blocks with ``2 * block + 1 >= m``, so wherever it stands one window
holds all of it. Window and template then share at least
``threshold * m / (3 * block + (1 - threshold) * m)`` of their shingles, and with
``BANDS`` bands of one MinHash each they agree in at least one band with the
probability that ``guarantee`` gives. Block minima of one size are taken from
those of the size below, so all sizes together cost about twice the first.

Blocks are counted from the first shingle of each text, so no other text matters.
A window that agrees in a band only names a candidate: the whole text is then
looked through for stretches that really hold the wanted share of the template's
shingles. A stretch may be ``REACH`` times as long as the template, so words that
were put in, left out or changed do no harm while the share is met.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagestrata.llm.words import WordHashes, alnum_words, map_texts, shingles

#: Bands of one MinHash each.
BANDS = 40
SHINGLE, THRESHOLD = 5, 0.8
#: Longest stretch that can be one match, in lengths of the template.
REACH = 4
#: Words searched together.
TOGETHER = 100_000
#: Size of the tables that tell at a glance which MinHashes no template has; a power of two.
BITMAP = 1 << 14

# Notices by which texts state their license.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def guarantee(m: int, block: int, bands: int = BANDS, threshold: float = THRESHOLD) -> float:
    """Least probability that a window with ``threshold`` of a template of ``m`` shingles is a candidate."""
    shared = np.ceil(threshold * m)
    return 1 - (1 - shared / (3 * block + m - shared)) ** bands


def block_of(m: int) -> int:
    block = 1
    while 2 * block + 1 < m:
        block *= 2
    return block


def _factors(bands: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)  # fixed: the same functions in every task
    return rng.integers(1, 2**63, bands, np.uint64) | np.uint64(1), rng.integers(0, 2**63, bands, np.uint64)


def _min_hash(h: np.ndarray, a: np.uint64, b: np.uint64) -> np.ndarray:
    return ((h * a + b) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Template:
    name: str
    shingles: np.ndarray
    block: int
    #: shingles that the template itself repeats
    repeated: set[int]


@dataclass
class Level:
    """Blocks of one size, counted from the start of each text."""

    block: int
    text: np.ndarray
    #: the one or two blocks of half the size that make up each block; None at the lowest level
    pairs: tuple[np.ndarray, np.ndarray] | None
    #: whether the next block, and the one after it, is of the same text
    same: list[np.ndarray]


def _levels(sizes: np.ndarray, most: int) -> list[Level]:
    out, block, pairs = [], 1, None
    while True:
        text = np.repeat(np.arange(len(sizes)), sizes)
        out.append(Level(block, text, pairs, [text[lag:] == text[:-lag] for lag in (1, 2)]))
        if block >= most:
            return out
        halves = -(-sizes // 2)
        starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes)
        within = np.arange(halves.sum()) - np.repeat(np.cumsum(halves) - halves, halves)
        first = np.repeat(starts, halves) + 2 * within
        pairs = (first, np.minimum(first + 1, np.repeat(ends, halves) - 1))
        sizes, block = halves, 2 * block


class Library:
    """Templates with their band tables: for each block size and band, a bitmap and the exact values."""

    def __init__(self, templates: dict[str, str], bands: int = BANDS, threshold: float = THRESHOLD):
        self.threshold, self.bands = threshold, bands
        self.a, self.b = _factors(bands)
        cache, self.templates = WordHashes(), []
        for name, text in templates.items():
            found, times = np.unique(shingles(cache.of(alnum_words(text.encode())), SHINGLE), return_counts=True)
            if len(found):
                self.templates.append(Template(name, found, block_of(len(found)), set(np.flatnonzero(times > 1).tolist())))
        self.sizes = sorted({t.block for t in self.templates})
        self.bits, self.values = {}, {}
        for size in self.sizes:
            for k in range(bands):
                of: dict[int, list[int]] = {}
                for n, t in enumerate(self.templates):
                    if t.block == size:
                        of.setdefault(int(_min_hash(t.shingles, self.a[k], self.b[k]).min()), []).append(n)
                bitmap = np.zeros(BITMAP, bool)
                bitmap[[v % BITMAP for v in of]] = True
                self.bits[size, k], self.values[size, k] = bitmap, of

    def candidates(self, texts: list[np.ndarray]) -> set[tuple[int, int]]:
        """``(text, template)`` where a window of the text's shingles agrees with the template in a band."""
        levels = _levels(np.array([len(t) for t in texts], np.int64), self.sizes[-1])
        h = np.concatenate(texts)
        out = set()
        for k in range(self.bands):
            low = _min_hash(h, self.a[k], self.b[k])
            for level in levels:
                if level.pairs is not None:
                    low = np.minimum(low[level.pairs[0]], low[level.pairs[1]])
                if level.block not in self.sizes:
                    continue
                least = low.copy()  # windows of up to three blocks of a text, from each block on
                for lag, same in enumerate(level.same, 1):
                    at = np.flatnonzero(same)
                    least[at] = np.minimum(least[at], low[at + lag])
                for w in np.flatnonzero(self.bits[level.block, k][least & np.uint32(BITMAP - 1)]):
                    for t in self.values[level.block, k].get(int(least[w]), ()):
                        out.add((int(level.text[w]), t))
        return out

    def matches(self, texts: list[np.ndarray]) -> list[list[tuple[str, int, int, float]]]:
        """``(template, first word, end, containment)`` in each text's words, by place."""
        per_text = [shingles(w, SHINGLE) for w in texts]
        found: list[list] = [[] for _ in texts]
        if self.templates and any(map(len, per_text)):
            for k, t in sorted(self.candidates(per_text)):
                width = min(SHINGLE, len(texts[k]))
                template = self.templates[t]
                found[k] += [(a, b + width, template.name, share) for a, b, share in self.stretches(per_text[k], template)]
        return [[(name, a, b, share) for a, b, name, share in sorted(f)] for f in found]

    def stretches(self, h: np.ndarray, template: Template) -> list[tuple[int, int, float]]:
        """``(first, last, containment)`` of stretches with enough of a template's shingles, none inside another.

        The first stretch that holds enough is made as short as it can be, then it
        goes on as long as more of the template follows. A shingle that returns
        begins another copy, unless the one at the front stands further off.
        """
        m = len(template.shingles)
        number = np.minimum(np.searchsorted(template.shingles, h), m - 1)
        place = np.flatnonzero(template.shingles[number] == h)
        number, place = number[place].tolist(), place.tolist()
        need, reach = int(np.ceil(self.threshold * m - 1e-9)), REACH * m
        out, held = [], {}
        left = right = 0

        def drop():
            nonlocal left
            held[number[left]] -= 1
            if not held[number[left]]:
                del held[number[left]]
            left += 1

        while right < len(place):
            held[number[right]] = held.get(number[right], 0) + 1
            right += 1
            while place[right - 1] - place[left] >= reach:
                drop()
            if len(held) < need:
                continue
            while held[number[left]] > 1:
                drop()
            while right < len(place) and len(held) < m and place[right] - place[left] < reach:
                n = number[right]
                if n in held and n not in template.repeated:
                    if n != number[left] or place[left + 1] - place[left] <= place[right] - place[right - 1]:
                        break
                    drop()
                held[n] = held.get(n, 0) + 1
                right += 1
            out.append((place[left], place[right - 1], len(held) / m))
            left, held = right, {}
        return out


def scan_licenses(
    docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, bands: int = BANDS
) -> DataFrame:
    """``row`` (the document) and ``out``: ``n_words`` and ``matches`` (license, first word, end, containment).

    Templates are a table made by people and go to every task. Null and empty
    texts match nothing. A text or template of fewer than five words is one
    shingle. Repeated rows agree; an empty table gives no rows.
    """
    match = pa.struct([("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("containment", pa.float64())])
    names = [f.name for f in match]

    def make():
        library, cache = Library(templates, bands, threshold), WordHashes()

        def of(texts):
            words = [cache.of(alnum_words(t)) for t in texts]
            found, lo, together = [], 0, 0
            for hi, w in enumerate(words, 1):  # some texts at a time: numpy calls cost more than short texts
                together += len(w)
                if hi == len(words) or together >= TOGETHER:
                    found += [[dict(zip(names, m)) for m in x] for x in library.matches(words[lo:hi])]
                    lo, together = hi, 0
            return [pa.array([len(w) for w in words], pa.int64()), pa.array(found, pa.list_(match))]

        return of

    fields = "n_words long, matches array<struct<license:string,start:long,stop:long,containment:double>>"
    return map_texts(docs, text, make, fields)
