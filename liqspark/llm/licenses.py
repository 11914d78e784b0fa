"""License scan: MinHash bands over overlapping windows, then containment.

Templates are grouped by length. A text is cut into windows half as long again
as the longest template of a group, each starting half such a template after
the last, so every occurrence lies whole in a window. A window that shares a
band with a template is compared with it: the share of the template's word
shingles that the window holds, exactly.

Bands have one row. A window holding 0.8 of a template's shingles has a
Jaccard index of 0.25 at the worst (template half as long as its group's
longest); 48 bands miss that with a chance of 0.75 ** 48, 1 in a million. A
band of a window can equal a template's only if the window holds the shingle
that gave the template its value, so only windows that hold such a shingle get
a signature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
BANDS = 48
WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 200_000

# Names and wordings of public licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                   "or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; "
                "either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
MATCH_TYPE = "array<struct<license:string,first:bigint,end:bigint,containment:double>>"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: list[str], k: int = SHINGLE_WORDS) -> list[str]:
    """Word shingles; of fewer words than ``k``, all of them as one."""
    if len(words) < k:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[i:] for i in range(k)))))


_WORDS: dict[str, int] = {}


def _hash_word(word: str) -> int:
    from xxhash import xxh64_intdigest

    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    got = _WORDS[word] = xxh64_intdigest(word.encode())
    return got


def shingle_hashes(words: list[str], k: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hashes of the shingles, combined from the hashes of their words."""
    known = _WORDS.get
    w = np.array([known(x) or _hash_word(x) for x in words], np.uint64)
    n = max(len(w) - k + 1, min(len(w), 1))
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(w))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + w[i:i + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(
        0, 1 << 63, BANDS, dtype=np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Permuted hashes, a row a band."""
    a, b = _permutations()
    h = hashes[None, :] * a[:, None] + b[:, None]
    return h ^ h >> np.uint64(31)


class Group:
    """Templates of like length, the values of their bands and the shingles that gave them."""

    def __init__(self, templates: list[tuple[str, list[str]]]):
        self.names = [name for name, _ in templates]
        self.sets = [frozenset(shingles(w)) for _, w in templates]
        longest = max(max(len(w) - SHINGLE_WORDS + 1, 1) for _, w in templates)  # shingles
        self.step = -(-longest // 2)
        self.span = longest + self.step
        hashed = [shingle_hashes(w) for _, w in templates]
        signed = [signature(h) for h in hashed]
        self.bands = np.array([x.min(axis=1) for x in signed])
        self.heads = np.unique(np.concatenate([h[x.argmin(axis=1)] for h, x in zip(hashed, signed)]))

    def windows(self, at: int) -> range:
        """Starts of the windows that hold shingle ``at``."""
        first = -(-max(at - self.span + 1, 0) // self.step)
        return range(first * self.step, at + 1, self.step)


def groups(templates: tuple = TEMPLATES) -> list[Group]:
    """Templates by length in shingles, a group up to twice its shortest."""
    parts: dict[int, list[tuple[str, list[str]]]] = {}
    for name, text in templates:
        words = words_of(text)
        parts.setdefault((max(len(words) - SHINGLE_WORDS, 0) + 1).bit_length(), []).append((name, words))
    return [Group(parts[k]) for k in sorted(parts)]


def matches(text: str | None, tree: list[Group], min_containment: float = MIN_CONTAINMENT) -> list[tuple[str, int, int, float]]:
    """(license, first word, word after the last, containment) of every match,
    in order; windows that find the same template at overlapping places give
    the better of the two."""
    words = words_of(text) if text else []
    if not words:
        return []
    hashes = shingle_hashes(words)
    found: set[tuple[int, int, int]] = set()
    for g, group in enumerate(tree):
        starts = {w for at in np.flatnonzero(np.isin(hashes, group.heads)).tolist() for w in group.windows(at)}
        for w in starts:
            bands = signature(hashes[w:w + group.span]).min(axis=1)
            found.update((g, t, w) for t in np.flatnonzero((group.bands == bands).any(axis=1)).tolist())
    out: list[tuple[str, int, int, float]] = []
    parts = shingles(words) if found else []
    for g, t, w in sorted(found):
        group = tree[g]
        here = [i for i in range(w, min(w + group.span, len(parts))) if parts[i] in group.sets[t]]
        share = len({parts[i] for i in here}) / len(group.sets[t])
        if share < min_containment:
            continue
        new = (group.names[t], here[0], min(here[-1] + SHINGLE_WORDS, len(words)), share)
        same = [x for x in out if x[0] == new[0] and x[1] < new[2] and new[1] < x[2]]
        if all((x[3], x[2] - x[1]) < (new[3], new[2] - new[1]) for x in same):
            out = [x for x in out if x not in same] + [new]
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def scan_licenses(docs: DataFrame, templates: tuple = TEMPLATES, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``matches`` (license, first word,
    word after the last, containment).

    One pass without a shuffle over whole texts. Repeated rows and null doc_ids
    keep a row each, null and empty texts have no matches, other columns are
    ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = groups(templates)
        kind = pa.list_(pa.struct([("license", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                                   ("containment", pa.float64())]))
        for b in slices(batches):
            rows = [[{"license": n, "first": a, "end": e, "containment": c} for n, a, e, c in matches(t, tree, min_containment)]
                    for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], ["doc_id", "matches"])

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(scan, f"doc_id bigint, matches {MATCH_TYPE}")


def names(found: Column) -> Column:
    """Distinct licenses, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["license"]))), ",")
